"""Lateness by record: a watermark that every record moves, in order of arrival (STR-7).

A micro-batch engine moves its watermark between batches, so whether a record is
late depends on how the records were cut into batches. Here the watermark that a
record meets is the largest event time of all records that arrived before it, no
more and no less: a prefix maximum over the order of arrival. It is computed in
two passes without a global sort in one task:

1. rows are dealt by ranges of (arrival, tie) and sorted; each segment runs its
   own prefix maximum and says its total;
2. the totals, a row per segment, give what each segment starts from.

The result is the same for any number of segments or micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.bursts import apply_rule, burst_stats
from tessera.session import scratch_path, ship_code
from tessera.streaming.sinks import committed_ids

_NONE = np.iinfo(np.int64).min


def micros(column: str, kind: T.DataType) -> Column:
    """Microseconds since 1970 on the column's own clock."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(column))
    return F.unix_micros(F.col(column))


def from_micros(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", value, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return F.timestamp_micros(value)


def _prefix_maxima(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Adds the largest time of the rows before each row of this partition (null for the first)."""
    so_far = _NONE
    for batch in batches:
        times = np.asarray(batch.column(column).fill_null(_NONE))
        upto = np.maximum.accumulate(np.concatenate([[so_far], times]))
        so_far = int(upto[-1])
        before = pa.array(upto[:-1], mask=upto[:-1] == _NONE)
        yield pa.RecordBatch.from_arrays([*batch.columns, before], [*batch.schema.names, "_before"])


def with_watermark(events: DataFrame, ts_col: str, arrival_col: str, tie_col: str, start: int | None = None) -> DataFrame:
    """``events`` with ``watermark``: the largest ``ts_col`` of the rows that arrived before, null if none did.

    Rows arrive in the order of (``arrival_col``, ``tie_col``). ``start`` is a watermark, in microseconds, that earlier
    records have left. A row without a time moves nothing; one without an arrival comes first.
    """
    spark, kind = events.sparkSession, events.schema[ts_col].dataType
    ship_code(spark)
    rows = events.withColumn("_us", micros(ts_col, kind).cast("long"))
    dealt = rows.repartitionByRange(arrival_col, tie_col).sortWithinPartitions(arrival_col, tie_col).withColumn("_segment", F.spark_partition_id())
    schema = T.StructType([*dealt.schema.fields, T.StructField("_before", T.LongType())])
    path = scratch_path(spark, "prefix-maxima")
    dealt.mapInArrow(partial(_prefix_maxima, column="_us"), schema).write.mode("overwrite").parquet(path)
    dealt = spark.read.schema(schema).parquet(path)
    carried = F.max("_most").over(Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1))
    segments = dealt.groupBy("_segment").agg(F.max("_us").alias("_most")).withColumn("_carried", carried).select("_segment", "_carried")
    # one row per range partition: a proven bound
    most = F.greatest("_before", "_carried", F.lit(start).cast("long"))
    return dealt.join(F.broadcast(segments), "_segment").withColumn("watermark", from_micros(most, kind)).drop("_us", "_segment", "_before", "_carried")


def is_late(ts_col: str, delay: str = "0 seconds") -> Column:
    """A record behind the watermark that it meets by more than ``delay``; false without a time or a watermark."""
    return F.coalesce(F.col(ts_col) < F.col("watermark") - F.expr(f"INTERVAL {delay}"), F.lit(False))


def split_late(events: DataFrame, ts_col: str, arrival_col: str, tie_col: str, delay: str = "0 seconds", start: int | None = None) -> DataFrame:
    """``events`` with ``watermark`` and ``late``: which records a record-wise watermark drops."""
    return with_watermark(events, ts_col, arrival_col, tie_col, start).withColumn("late", is_late(ts_col, delay))


def detect_bursts_on_time(events: DataFrame, user_col: str, ts_col: str, arrival_col: str, tie_col: str, *, window: str, slide: str,
                          min_count: int, max_avg_ms: float) -> DataFrame:
    """The burst rule where a record joins only the windows that were still open when it arrived.

    A window is closed as soon as the watermark has reached its end, so a late record may miss its earlier windows and
    still count in its later ones.
    """
    kind = events.schema[ts_col].dataType
    rows = with_watermark(events.select(user_col, ts_col, arrival_col, tie_col), ts_col, arrival_col, tie_col)
    opened = rows.select(user_col, ts_col, "watermark", F.window(ts_col, window, slide).alias("window")).where(F.col("watermark").isNull() | (F.col("window.end").cast(kind) > F.col("watermark")))
    return apply_rule(opened.groupBy("window", user_col).agg(*burst_stats(ts_col)), user_col, min_count, max_avg_ms)


class LatenessSink:
    """``foreachBatch`` body: each micro-batch with ``watermark`` and ``late``, to ``root/batch=<n>``.

    The watermark goes on from batch to batch: what a batch leaves is kept beside it in ``root/mark=<n>`` (one row), and
    a replayed batch starts again from the mark of the one before. Batches must come in order of arrival.
    """

    def __init__(self, spark: SparkSession, root: str, ts_col: str, arrival_col: str, tie_col: str, delay: str = "0 seconds"):
        self.spark, self.root, self.columns, self.delay = spark, root.rstrip("/"), (ts_col, arrival_col, tie_col), delay

    def _mark(self, before: int) -> int | None:
        ids = [n for n in committed_ids(self.spark, self.root, "mark") if n < before]
        return self.spark.read.schema("most BIGINT").parquet(f"{self.root}/mark={ids[-1]}").first()["most"] if ids else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        start, out = self._mark(batch_id), f"{self.root}/batch={batch_id}"
        split_late(batch, *self.columns, self.delay, start).write.mode("overwrite").parquet(out)
        done, ts = self.spark.read.schema(batch.schema).parquet(out), self.columns[0]
        most = done.agg(F.max(micros(ts, batch.schema[ts].dataType)).cast("long").alias("most"))
        most.select(F.greatest("most", F.lit(start).cast("long")).alias("most")).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/mark={batch_id}")

    def read(self, schema) -> DataFrame:
        paths = [f"{self.root}/batch={n}" for n in committed_ids(self.spark, self.root, "mark")]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)
