"""Session helpers: a configured local session for tests/bench, and lineage cuts.

On a cluster the session is created by the platform; ``checkpoint_dir`` reads
``spark.checkpoint.dir`` from it and only falls back to a scratch folder when
the setting is absent (local tests).
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
ROWS_A_TASK = 1 << 15
ROWS_TOGETHER = 1 << 12


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "panelspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEM", "4g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a scratch one only when unset."""
    d = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError(f"set {_CKPT_KEY} to a folder all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="panelspark-ckpt-")
        spark.conf.set(_CKPT_KEY, d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def dealt_by_rows(df: DataFrame, rows_a_task: int = ROWS_A_TASK, rows_together: int = ROWS_TOGETHER) -> DataFrame:
    """A checkpointed ``df`` in as many partitions as its own rows ask for.

    A small aggregate of large tables keeps a partition for every so many megabytes of partial
    sums; an iterative fit would pay for them in each of its thousands of jobs.  Up to ``rows_together``
    rows that came in one partition are marked as such too: their sums and groups then need no exchange.
    More rows keep it there, since it deals the work on them out."""
    n = df.count()
    tasks = max(1, -(-n // rows_a_task))
    together = tasks == 1 and n <= rows_together
    return df.coalesce(tasks) if together or tasks < df.rdd.getNumPartitions() else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``panelspark`` importable in the Python workers (pandas UDFs,
    ``mapInPandas`` and ``applyInPandas`` closures refer to it).

    The package is zipped once per SparkContext into the shared checkpoint
    folder and registered with ``addPyFile``, which is how Spark distributes
    Python code to executors on a cluster.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    target = os.path.join(checkpoint_dir(spark), f"panelspark-{uuid.uuid4().hex}.zip")
    if target.startswith("file:"):
        target = target[len("file:"):]
    if "://" in target:
        jvm = sc._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(path, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
    else:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "wb") as fh:
            fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(key)
