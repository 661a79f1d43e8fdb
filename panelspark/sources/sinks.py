"""Sinks (A6, A7, A10, A12): processed panels, result tables, fitted models,
and wide indicator CSVs in the layout the A1 reader expects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str, split_col: str = "split",
                    sort_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """One dataset partitioned by split (train/test directories, the
    union of both is the full panel, G1); rows range-partitioned by split and
    the sort columns and sorted within partitions, so files keep (entity, time)
    order without one sorted file, and a hot entity is spread over several."""
    w = df
    if sort_cols:
        w = df.repartitionByRange(split_col, *sort_cols).sortWithinPartitions(split_col, *sort_cols)
    (w.write.mode("overwrite").partitionBy(split_col).format(fmt)
       .options(**({"header": "true"} if fmt == "csv" else {})).save(path))


def write_indicator_csv(df: DataFrame, path: str, metadata: Sequence[str]) -> None:
    """Wide indicator table -> CSV part files, each opening with the
    ``metadata`` lines and the header, as published indicator files do.

    Records are formatted on the executors (``to_csv``); a per-partition step
    puts the metadata lines and header in front of the partition's first
    record, so every part file is a complete indicator file of its own and
    the data is never gathered into one task.
    """
    import csv
    import io

    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(df.columns)
    top = list(metadata) + [buf.getvalue()]
    lines = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))

    def prepend(batches):
        import pandas as pd
        pending = True
        for pdf in batches:
            if pending and len(pdf):
                pending = False
                yield pd.DataFrame({"value": top})
            yield pdf

    lines.mapInPandas(prepend, "value string").write.mode("overwrite").text(path)


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Leaderboard / summary tables (small) as CSV with header."""
    (df.repartition(1).write.mode("overwrite").format(fmt)
       .options(**({"header": "true"} if fmt == "csv" else {})).save(path))


def save_model(model, path: str) -> None:
    """A10: persist a fitted Spark ML model/pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """A10: reload a model saved by ``save_model`` (raises when absent)."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_panel_summary(spark, fe, path: str, fmt: str = "csv") -> None:
    """The fitted panel model's coefficient table (J1/J2) and one-row
    summary (J12) written next to each other."""
    write_results(fe.coefficients(spark), path + "/coefficients", fmt)
    write_results(fe.summary(spark), path + "/summary", fmt)
