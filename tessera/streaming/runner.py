"""Running stream queries to the end (STR-1, STR-9, STR-13).

Production runs ``trigger(processingTime="5 seconds")`` forever; checks and
batch callers use ``availableNow``, which processes what has arrived and stops.
A checkpoint location is always set (SNK-7): it is what lets a query resume
after a lost executor or driver without losing or repeating state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery



def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          processing_time: str | None = "5 seconds", available_now: bool = False,
          name: str | None = None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", timeout_s: int | None = None) -> StreamingQuery:
    """Process everything that has arrived, then stop. Takes as long as that takes, unless ``timeout_s`` is given:
    then a run that is not done by then is stopped and raises."""
    q = start(df, sink, checkpoint, mode, available_now=True)
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination(), True)[1]
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if not finished:
        raise TimeoutError(f"stream did not finish in {timeout_s}s")
    return q


def batches_run(q: StreamingQuery) -> int:
    """Micro-batches that the checkpoint of ``q`` has seen, over all its runs (progress lists keep the latest 100 only)."""
    last = q.lastProgress
    return 0 if last is None else int(last["batchId"]) + 1


def console_sink(truncate: bool = False, rows: int = 20) -> Callable[[DataFrame, int], None]:
    """SNK-5/SNK-6: print the first ``rows`` rows of each result table, as a console shows them."""

    def show(df: DataFrame, batch_id: int) -> None:
        print(f"-------- batch {batch_id} --------")
        df.show(rows, truncate=truncate)

    return show


def start_console(df: DataFrame, checkpoint: str, mode: str = "complete", processing_time: str = "5 seconds") -> StreamingQuery:
    """SNK-5 as the reference wrote it: console sink, untruncated, on a processing-time trigger."""
    w = df.writeStream.outputMode(mode).format("console").option("truncate", "false").option("checkpointLocation", checkpoint)
    return w.trigger(processingTime=processing_time).start()


def time_chunks(df: DataFrame, ts_col: str, days_per_chunk: int) -> list[tuple[dt.datetime, dt.datetime]]:
    """Consecutive ``[start, end)`` ranges of ``days_per_chunk`` days covering ``ts_col``.

    Only the min and max timestamps reach the driver (one row).
    """
    row = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if row is None or row["lo"] is None:
        return []
    day0 = dt.datetime.combine(row["lo"].date(), dt.time())
    out, cur = [], day0
    while cur <= row["hi"]:
        nxt = cur + dt.timedelta(days=days_per_chunk)
        out.append((cur, nxt))
        cur = nxt
    return out


def replay_by_time(spark: SparkSession, source: DataFrame, ts_col: str, folder: str,
                   run_once: Callable[[], StreamingQuery], days_per_chunk: int = 5,
                   fmt: str = "parquet", write_options: dict | None = None,
                   columns: list[str] | None = None) -> list[StreamingQuery]:
    """Deliver ``source`` to a stream in event-time order, one chunk per run.

    The source is read once and staged next to ``folder``, partitioned by
    chunk number. Then, chunk by chunk, the staged partition (a pruned read)
    is written as new files into ``folder`` and ``run_once`` drains it. This
    is how files arrive from upstream; each chunk becomes one micro-batch of
    the same query, resumed from its checkpoint: a file source without
    ``maxFilesPerTrigger`` takes all that is there. With that option a chunk
    becomes several, and rows of its later files meet the watermark that the
    earlier ones have moved. A backlog under ``available_now`` is one batch
    likewise; where it is too large for that, give the option and a watermark
    delay of at least the time that one chunk spans. Two passes
    over the data in total, not one per chunk. Rows without a time come with
    the first chunk: the query sees them and decides.
    """
    chunks = time_chunks(source, ts_col, days_per_chunk)
    if not chunks:
        if source.isEmpty():
            return []
        chunks = [(dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2))]  # no row has a time
    epoch = dt.datetime(1970, 1, 1)
    lo_us = int((chunks[0][0] - epoch).total_seconds()) * 1_000_000
    span_us = days_per_chunk * 86_400 * 1_000_000
    ts_us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    stage = folder.rstrip("/") + "-stage"
    cols = columns if columns is not None else source.columns
    number = F.coalesce(F.floor((ts_us - F.lit(lo_us)) / F.lit(span_us)).cast("int"), F.lit(0))
    (source.select(*cols, number.alias("_chunk"))
     .write.mode("overwrite").partitionBy("_chunk").parquet(stage))
    staged = spark.read.parquet(stage)
    runs = []
    for i in range(len(chunks)):
        part = staged.where(F.col("_chunk") == i).drop("_chunk")
        part.write.mode("append").format(fmt).options(**(write_options or {})).save(folder)
        runs.append(run_once())
    return runs
