"""Training-data operators on text, page and vector tables.

Nothing else in the package imports this one.  ``queries()`` and
``oracle_sql()`` list the ``opN_<name>`` queries (module ``catalog``).
"""
