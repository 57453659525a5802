"""Log sources (SRC-1, SRC-2, SRC-5).

Every reader takes an explicit schema: nothing is inferred, so a scan never
runs an extra pass over the data and the column set is stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import GAMELOG, TSV13

GAMELOG_COLUMNS = [f.name for f in GAMELOG.fields]
TSV13_DDL = ", ".join(f"{f.name} STRING" for f in TSV13.fields)
# A tab line is split exactly at its tabs: no quoting, no escapes, an empty field stays "".
TSV_OPTIONS = {"sep": "\t", "quote": "", "escape": "", "header": "false", "mode": "PERMISSIVE",
               "nullValue": "\u0001"}


def scan_gamelog(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Offline game log, whole source, four string fields (SRC-1).

    ``fmt`` is any Spark data source name (parquet, json, csv, or a connector on
    the class path); missing fields come back NULL. Column pruning and filters
    written against the result reach the scan.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("json", "csv"):
        reader = reader.schema(GAMELOG)
    df = reader.load(path)
    present = set(df.columns)
    return df.select(
        [F.col(c).cast("string") if c in present else F.lit(None).cast("string").alias(c) for c in GAMELOG_COLUMNS]
    )


def scan_log_dir(spark: SparkSession, path: str, encoding: str = "GB2312") -> DataFrame:
    """All lines under ``path`` (dir/subdir/file), split into 13 trimmed string fields (SRC-2).

    Every line is a row, blank ones too (all their fields are NULL): the text
    reader keeps the bytes of each line, which are decoded and split at tabs.
    Fields past the end of a short line are NULL. The encoding must leave line
    feeds as single bytes (GB2312, GBK, UTF-8 do).
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines_to_fields(raw.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))).drop("line")


def lines_to_fields(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One string column of raw lines -> the 13 named, trimmed fields; other columns kept (FN-1/2).

    Each line is parsed once, by the same CSV reader ``scan_log_dir`` uses.
    The parse sits in a ``Generate`` on purpose: a filter on the fields (item
    use, validity) cannot be pushed below it, so Catalyst does not inline and
    re-run the split once per predicate. About a third faster than 13
    ``split(...)[i]`` projections followed by the filter.
    """
    keep = [c for c in lines.columns if c != value_col]
    parsed = F.from_csv(F.col(value_col), TSV13_DDL, TSV_OPTIONS)
    g = lines.select(*keep, F.col(value_col).alias("line"), F.inline(F.array(parsed)))
    return g.select(*keep, "line", *[F.trim(F.col(f.name)).alias(f.name) for f in TSV13.fields])


def flagged_snapshot(spark: SparkSession, path: str, with_window: bool = False) -> DataFrame:
    """All flagged players: ``userName`` and ``avgTime`` as DOUBLE (SRC-5), optionally ``window_end``.

    Reads any stored map of that shape: ``avgTime`` may be a number, as the stream
    stores it, or text, as a hash of strings would.
    """
    df = spark.read.parquet(path)
    value = F.trim(F.col("avgTime").cast("string")).try_cast("double")
    cols = [F.col("userName"), value.alias("avgTime")]
    return df.select(*cols, *([F.col("window_end")] if with_window else []))


def write_event_log(df: DataFrame, path: str, ts_col: str, date_col: str = "event_date",
                    mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Store a log partitioned by day, so day-bounded reports prune whole folders.

    No repartition by date: that would send a whole day (terabytes at scale)
    through one task. Each task writes the days it holds; logs arrive roughly
    in time order, so a task holds few days and files stay large.
    """
    (df.withColumn(date_col, F.to_date(F.col(ts_col)))
     .write.mode(mode).partitionBy(date_col)
     .option("maxRecordsPerFile", max_records_per_file)
     .parquet(path))


def write_user_runs(df: DataFrame, path: str, user_col: str, ts_col: str, date_col: str = "event_date", mode: str = "overwrite",
                    max_records_per_file: int = 5_000_000, users_per_file: int = 1_000_000, **options) -> None:
    """Store a log partitioned by day, each day in runs sorted by (user, time), with Bloom filters of users (SRC-1).

    Rows are dealt by ranges of (day, user, time), so a file holds a range of users and a user with many rows spreads over
    files. A scan for some users then skips files and row groups by their smallest and largest user, and by the Bloom
    filter where a user lies within a range but isn't there. ``options`` go to the writer (``parquet.block.size``).
    """
    order = [date_col, user_col, ts_col]
    bloom = {f"parquet.bloom.filter.enabled#{user_col}": "true", f"parquet.bloom.filter.expected.ndv#{user_col}": str(users_per_file)}
    dated = df.withColumn(date_col, F.to_date(F.col(ts_col)))
    (dated.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).partitionBy(date_col).options(**{**bloom, **options}).option("maxRecordsPerFile", max_records_per_file).parquet(path))


def user_history(spark: SparkSession, path: str, users: list, user_col: str = "userName", schema=None) -> DataFrame:
    """All rows of some users from a log of ``write_user_runs``; row groups without them are skipped.

    One equality per user, since Bloom filters are asked for equalities (a long ``IN`` list becomes a range). ``schema`` is
    the log's with its date column, needed where it may hold no row yet (and so no file to take a schema from).
    """
    cond = F.lit(False)
    for u in users:
        cond = cond | (F.col(user_col) == F.lit(u))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(cond)
