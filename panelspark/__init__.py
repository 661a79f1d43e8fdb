"""panelspark: entity-by-time panel analytics as Spark DataFrame operators.

Every operator takes DataFrames plus caller-chosen column names and returns a
DataFrame; heavy work stays on the executors, only k x k matrices or a handful
of scalars ever reach the driver.
"""

__version__ = "0.1.0"
