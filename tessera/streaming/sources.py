"""Stream sources (SRC-3, SRC-4, PRJ-8).

The reference reads a message broker from the latest position. ``stream_lines``
takes the broker connector when it is on the class path (``fmt="kafka"`` plus
its options), a topic in shared storage (``fmt="messages"``, ``messages.py``) or
a folder of files; all give ``value STRING`` and ``ingest_ts``: the message's own
``timestamp`` (broker, topic, or files with columns ``value, timestamp``), or the
micro-batch time for plain text files, which have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.streaming.messages import register


def stream_lines(spark: SparkSession, path: str | None = None, fmt: str = "text",
                 starting_offsets: str | None = None, **options) -> DataFrame:
    """``starting_offsets``: where a first run begins, ``latest`` (the default), ``earliest`` or offsets as JSON, for sources
    with positions. A folder of plain files has none: a stream over it begins with what is there."""
    if fmt == "messages":
        register(spark)
        raw = spark.readStream.format(fmt).option("startingOffsets", starting_offsets or "latest").options(**options).load(path)
        return raw.select("value", F.col("timestamp").alias("ingest_ts"))
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("startingOffsets", starting_offsets or "latest")
            .options(**options)
            .load()
        )
        return raw.selectExpr("CAST(value AS STRING) AS value", "CAST(timestamp AS TIMESTAMP) AS ingest_ts")
    if starting_offsets not in (None, "earliest"):
        raise ValueError("a folder of files has no positions: use fmt='messages'")
    if fmt != "text":  # messages as files: what a broker would have delivered
        raw = spark.readStream.format(fmt).schema("value STRING, timestamp TIMESTAMP_NTZ").options(**options).load(path)
        return raw.select("value", F.col("timestamp").alias("ingest_ts"))
    raw = spark.readStream.format(fmt).options(**options).load(path)
    return raw.select(F.col("value"), F.current_timestamp().alias("ingest_ts"))


def stream_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A folder of files as a stream, new files picked up per micro-batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
