"""Sources (A1-A5, A8, A9, A11).

Indicator files are read by Spark (CSV/Parquet/JSON); the driver only looks
at file *names* and column *names*, never at rows.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions.scalar import try_double
from panelspark.operators.clean import (
    detect_time_columns, drop_metadata, drop_null_columns, standardize_entity, wide_to_long,
)
from panelspark.session import cut_lineage

# --- fixed values --------------------------------------------------------------
# extension precedence when several files share a base name (A4)
FORMAT_PRECEDENCE = [".parquet", ".csv", ".json"]
# metadata lines above the header of a wide indicator CSV (A1)
DEFAULT_SKIP_LINES = 4
# -------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _header_names(line: str) -> list[str]:
    """Column names from one header line, named the way Spark's CSV reader
    names them: empty -> ``_c<i>``, repeated -> name + position."""
    import csv
    raw = next(csv.reader([line])) if line else []
    names = [n if n != "" else f"_c{i}" for i, n in enumerate(raw)]
    seen = {n: names.count(n) for n in names}
    return [f"{n}{i}" if seen[n] > 1 else n for i, n in enumerate(names)]


def read_csv_skip(spark: SparkSession, path: str, skip: int = DEFAULT_SKIP_LINES,
                  header: bool = True) -> DataFrame:
    """A1: CSV with ``skip`` metadata lines above the header, in every file.

    Spark's CSV reader has no skip-rows option.  The file (or every part file
    of a directory) is scanned as text, split like any text source; the first
    lines of a file are the ones in its split starting at byte 0
    (``_metadata.file_block_start``), and ``monotonically_increasing_id`` numbers
    lines consecutively in scan order within a split.  A one-row-per-file
    aggregate gives each file's first id; lines below ``first + skip`` are
    metadata and the line at ``first + skip`` is that file's header.  The
    header names the columns (driver reads it; part files whose headers differ are
    refused); all lines are parsed on the executors with ``from_csv``.  Every column is text;
    numbers go through the tolerant cast later (B7).  Skipping is explicit,
    never guessed (S11), and counts raw lines, blank ones included.

    A quoted field may hold line breaks, also across splits (``_joined_lines``); the header is one line.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__block"),
        (F.col("_metadata.file_block_start") == 0).alias("__head"),
        F.monotonically_increasing_id().alias("__i"))
    n_top = skip + (1 if header else 0)
    if n_top:
        # one row per file: bounded by the file listing the driver already holds
        first = F.broadcast(raw.where("__head").groupBy("__f").agg(F.min("__i").alias("__i0")))
        raw = raw.join(first, "__f", "left").withColumn(
            "__pos", F.when(F.col("__head"), F.col("__i") - F.col("__i0")))
    if header:
        heads = raw.where(F.col("__pos") == skip).select("value").distinct().take(2)
        if len(heads) > 1:
            raise ValueError(f"part files of {path} have different headers: {[h[0] for h in heads]}")
        names = _header_names(heads[0][0] if heads else "")
    else:
        sample = raw.where(F.col("__pos").isNull() | (F.col("__pos") >= n_top)).select("value").first()
        names = [f"_c{i}" for i in range(len(_header_names(sample[0] if sample else "")))]
    if not names:
        return spark.createDataFrame([], "value string").select()
    body = raw.where(F.col("__pos").isNull() | (F.col("__pos") >= n_top)) if n_top else raw
    body = _joined_lines(body).where(F.length("value") > 0)          # blank lines carry no record (CSV reader rule)
    ddl = ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)
    rec = F.from_csv(F.col("value"), ddl)
    return body.select(*[rec[n].alias(n) for n in names])


def _joined_lines(lines: DataFrame) -> DataFrame:
    """Lines (value, __f, __block, __i) with those of one record joined by a line break.

    A line goes on with a record if an odd number of quotes stands before it in its file.  Quotes are summed per split,
    added up over the splits of a file (one row a split), then along the lines of a split; a record is
    named by its first line.  Files without an odd line, and files whose quotes do not come in pairs, stay as they are."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    splits = lines.groupBy("__f", "__block").agg(F.sum(quotes).alias("__n"), F.max(quotes % 2).alias("__odd"))
    w = Window.partitionBy("__f").orderBy("__block")
    splits = splits.withColumn("__before", F.sum("__n").over(w) - F.col("__n")) \
        .withColumn("__torn", (F.max("__odd").over(Window.partitionBy("__f")) == 1) & (F.sum("__n").over(Window.partitionBy("__f")) % 2 == 0))
    splits = cut_lineage(splits.where("__torn").select("__f", "__block", "__before"))
    if splits.isEmpty():
        return lines.select("value")
    along = Window.partitionBy("__f", "__block").orderBy("__i")
    torn = lines.join(splits, ["__f", "__block"]).withColumn("__q", quotes)
    torn = torn.withColumn("__starts", (F.col("__before") + F.sum("__q").over(along) - F.col("__q")) % 2 == 0)
    own = F.last(F.when(F.col("__starts"), F.col("__i")), ignorenulls=True)
    torn = cut_lineage(torn.withColumn("__rec", own.over(along)))
    # the last record begun in the splits before: for the lines a split starts with
    ends = torn.groupBy("__f", "__block").agg(F.max("__rec").alias("__end"))
    earlier = F.last("__end", ignorenulls=True).over(Window.partitionBy("__f").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    torn = torn.join(ends.select("__f", "__block", earlier.alias("__prior")), ["__f", "__block"])
    whole = torn.groupBy("__f", F.coalesce("__rec", "__prior").alias("__rec")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__block").alias("b"), F.col("__i").alias("i"), F.col("value").alias("v")))).alias("l"))
    whole = whole.select(F.array_join(F.transform("l", lambda x: x["v"]), "\n").alias("value"))
    rest = lines.join(splits.select("__f").distinct(), "__f", "left_anti").select("value")
    return rest.unionByName(whole)


def resolve_source(spark: SparkSession, base: str, precedence: Sequence[str] = FORMAT_PRECEDENCE) -> str | None:
    """A4: first existing ``base + ext`` in precedence order."""
    for ext in precedence:
        if path_exists(spark, base + ext):
            return base + ext
    return None


def read_any(spark: SparkSession, path: str, skip: int = DEFAULT_SKIP_LINES) -> DataFrame:
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".json"):
        return spark.read.json(path)
    if path.endswith(".csv"):
        return read_csv_skip(spark, path, skip)
    raise ValueError(f"unsupported file type: {path}")


def load_indicator(spark: SparkSession, path: str, name: str, entity: str = "entity",
                   skip: int = DEFAULT_SKIP_LINES, code_col: str | None = "Country Code") -> DataFrame:
    """A2: one indicator file -> long (entity[, code], time, <name>).

    Wide files (one column per year) are melted (B4/B5); long files with a
    ``time``/``Year`` column and a column called ``name`` pass through (B6).
    All-empty columns are dropped (B1), metadata columns removed (B3).  Raises
    when the file type is unsupported or the time or value column is missing.
    """
    df = standardize_entity(drop_metadata(read_any(spark, path, skip)), entity)
    years = detect_time_columns(df.columns)
    ids = [entity] + ([code_col] if code_col and code_col in df.columns else [])
    if years:
        df = drop_null_columns(df, years)
        years = [c for c in years if c in df.columns]
        return wide_to_long(df, ids, name, years)
    tcol = next((c for c in ("time", "Year", "year") if c in df.columns), None)
    if tcol is None:
        raise ValueError(f"no time columns in {path}")
    if name not in df.columns:
        raise ValueError(f"no column {name} in {path}")
    return df.select(*ids, F.col(tcol).try_cast("double").cast("int").alias("time"),
                     try_double(name).alias(name)).where(F.col("time").isNotNull())


@dataclass(frozen=True)
class IndicatorSpec:
    """A3: one manifest entry: file base name (no extension) and column name."""
    base: str
    column: str


def load_manifest(spark: SparkSession, folder: str, specs: Sequence[IndicatorSpec],
                  entity: str = "entity") -> list[DataFrame]:
    """A3/A4: resolve and load every manifest entry that exists; the first
    spec is the target and must exist."""
    out = []
    for i, s in enumerate(specs):
        p = resolve_source(spark, os.path.join(folder, s.base))
        if p is None:
            if i == 0:
                raise FileNotFoundError(f"target source {s.base} not found in {folder}")
            continue
        out.append(load_indicator(spark, p, s.column, entity))
    if not out:
        raise FileNotFoundError(f"no data files found in {folder}")
    return out


def long_index_source(df: DataFrame, index_col: str, index_value, entity_col: str, time_col: str,
                      value_col: str, name: str, entity: str = "entity") -> DataFrame:
    """Keep one index of a long (index, entity, time, value) table."""
    return df.where(F.col(index_col) == F.lit(index_value)).select(
        F.col(entity_col).alias(entity), F.col(time_col).try_cast("double").cast("int").alias("time"),
        try_double(value_col).alias(name))


def read_processed(spark: SparkSession, path: str, split: str | None = None,
                   drop: Sequence[str] = ("code",)) -> DataFrame:
    """Processed panel written by ``write_processed``; ``split`` prunes the
    ``split=`` partition directory at planning time."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == F.lit(split))
    return df.drop(*drop)


def full_panel(train: DataFrame, test: DataFrame) -> DataFrame:
    """G1: train + test -> full panel (by name; a missing column is an error)."""
    return train.unionByName(test)


def validated_panel(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail early when required columns are missing or the table is empty."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("panel is empty")
    return df


def source_inventory(spark: SparkSession, folder: str, expected: Sequence[str]) -> DataFrame:
    """Which expected sources exist, their format and size.

    A source is a file or a directory of part files right below ``folder``; of
    several formats with one base name the one that would be read (A4) is
    reported, with its size.  ``binaryFile`` only opens a file when its
    ``content`` column is selected, so this is a metadata listing done by
    the executors.
    """
    fs, p = _fs(spark, folder)
    root = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder) \
        .select(F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "").alias("path"), "length")
    name = F.substring_index(F.substring(F.col("path"), len(root) + 1, 1 << 20), "/", 1)
    files = files.withColumn("name", name) \
                 .withColumn("base", F.regexp_extract("name", r"^(.*?)(\.[^.]*)?$", 1)) \
                 .withColumn("format", F.regexp_extract("name", r"\.([^.]+)$", 1))
    per = files.groupBy("base", "format").agg(F.sum("length").alias("bytes"))
    order = F.array_position(F.array(*[F.lit(x.lstrip(".")) for x in FORMAT_PRECEDENCE]), F.col("format"))
    order = F.when(order > 0, order).otherwise(len(FORMAT_PRECEDENCE) + 1)
    best = per.groupBy("base").agg(F.min(F.struct(order, "format", "bytes")).alias("f"))
    man = spark.createDataFrame([(e,) for e in expected], "base string")
    return man.join(best, "base", "left").select("base", F.col("f").isNotNull().alias("found"),
                                                 F.col("f.format").alias("format"), F.col("f.bytes").alias("bytes"))
