"""Inputs of the registered queries: the given tables and files Spark derives from them.

Derived files are written once per application into the shared folder
(``spark.checkpoint.dir``), each under a fresh name, and reused by the queries
of that application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import configure, scratch_path
from tessera.sources.derived import gamelog_from_events, lines_from_events
from tessera.sources.logs import scan_gamelog, scan_log_dir

_written: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    if key not in _written:
        path = scratch_path(spark, kind)
        write(path)
        _written[key] = path
    return _written[key]


def gamelog_json_path(spark: SparkSession, sf_dir: str) -> str:
    """The offline log as JSON documents; a NULL field is simply absent, like a missing key."""

    def write(path: str) -> None:
        gamelog_from_events(events(spark, sf_dir)).drop("event_id").write.mode("overwrite").json(path)

    return _once(spark, sf_dir, "gamelog-json", write)


def gamelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_gamelog(spark, gamelog_json_path(spark, sf_dir), fmt="json")


def log_dir_path(spark: SparkSession, sf_dir: str) -> str:
    """Tab lines as GB2312 text, two levels deep: ``<root>/day=<d>/part-*.csv``."""

    def write(path: str) -> None:
        lines = lines_from_events(events(spark, sf_dir))
        # one string column written verbatim: separator and quote characters that never occur
        (lines.select("day", "value").write.mode("overwrite").partitionBy("day")
         .option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
         .option("encoding", "GB2312").csv(path))

    return _once(spark, sf_dir, "log-dir", write)


def log_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_log_dir(spark, log_dir_path(spark, sf_dir), encoding="GB2312")


def burst_windows(spark: SparkSession, sf_dir: str, find) -> DataFrame:
    """The flagged windows of all item uses (``find(clicks)``), stored once: what keyed tables are made from."""
    path = _once(spark, sf_dir, "burst-windows", lambda p: find(clicks(spark, sf_dir)).write.mode("overwrite").parquet(p))
    return spark.read.parquet(path)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-use events of the driver table (``click``), the burst detector's input."""
    return events(spark, sf_dir).where(F.col("event_type") == "click")
