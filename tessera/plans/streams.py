"""Burst detection as Structured Streaming jobs (STR-1..13, SNK-4/5/7, PIP-2, PIP-3).

``burst_stream`` builds the streaming plan; the ``run_*`` functions deliver
data derived from the given tables as arriving files, drain the query with
``availableNow`` and read the sink back as a batch DataFrame.

State per (window, user) is three numbers. With a watermark Spark evicts a
window's state once it closes, so state stays bounded by the open windows;
complete mode (the reference's choice) keeps every window forever and should
only serve small dashboards: one key shows it, the others append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.bursts import detect_bursts
from tessera.operators.clean import item_use_filter, parse_log_line
from tessera.operators.lateness import LatenessSink
from tessera.operators.tables import blacklist_merge, flagged_latest
from tessera.schemas import BLACKLIST_DDL, FLAGGED_DDL
from tessera.session import scratch_path
from tessera.sources.logs import lines_to_fields
from tessera.streaming.messages import append, register
from tessera.streaming.runner import replay_by_time, run_available
from tessera.streaming.sinks import DeltaLogTable, batch_folder_writer, expire, read_all_batches, read_last_batch
from tessera.streaming.sources import stream_lines, stream_table


def burst_stream(stream: DataFrame, user_col: str, ts_col: str, window: str, slide: str,
                 min_count: int, max_avg_ms: float, watermark: str | None = None, gap_col: str | None = None) -> DataFrame:
    """The streaming plan: optional watermark, sliding-window aggregate, burst rule.

    Windows and watermark go by ``ts_col``; the gap is measured on ``gap_col`` (default: the same).

    A watermark needs a TIMESTAMP column; a TIMESTAMP_NTZ event time is read in
    the session zone for it, and the window bounds are given back as NTZ.
    """
    ntz = isinstance(stream.schema[ts_col].dataType, T.TimestampNTZType)
    if watermark is not None:
        if ntz:
            stream = stream.withColumn(ts_col, F.col(ts_col).cast(T.TimestampType()))
        stream = stream.withWatermark(ts_col, watermark)
    out = detect_bursts(stream, user_col, ts_col, window, slide, min_count, max_avg_ms, gap_col)
    if watermark is not None and ntz:
        out = out.withColumns({c: F.col(c).cast(T.TimestampNTZType()) for c in ("window_start", "window_end")})
    return out


def detect_from_lines(lines: DataFrame, *, window: str, slide: str, min_count: int, max_avg_ms: float,
                      time_basis: str = "event", watermark: str | None = None,
                      event: int | None = None, item: str | None = None) -> DataFrame:
    """PIP-2 from raw tab lines: parse -> item-use filter -> windows -> rule (M14).

    ``time_basis="event"`` windows on the game time in the line (version 2);
    ``"ingest"`` on the arrival time, which needs an ``ingest_ts`` column
    (``stream_lines`` provides one). The gap between uses is measured on the
    game time in either case.
    """
    if time_basis not in ("event", "ingest"):
        raise ValueError("time_basis must be 'event' or 'ingest'")
    ts = "event_ts" if time_basis == "event" else "ingest_ts"
    kw = {k: v for k, v in (("event", event), ("item", item)) if v is not None}
    keep = ("ingest_ts",) if time_basis == "ingest" else ()
    uses = item_use_filter(parse_log_line(lines_to_fields(lines)), keep=keep, **kw)
    return burst_stream(uses, "userName", ts, window, slide, min_count, max_avg_ms, watermark, "event_ts")


def closing_row(source: DataFrame, ts_col: str, **values: str) -> DataFrame:
    """One row a year after the last, all other columns null but for ``values``: it moves the watermark past every open
    window, and its own window never closes."""
    last = source.agg(F.max(ts_col).alias("t"))
    fields = [F.expr("t + INTERVAL 365 DAYS").cast(f.dataType) if f.name == ts_col else F.lit(values.get(f.name)).cast(f.dataType)
              for f in source.schema.fields]
    return last.where("t IS NOT NULL").select(*[c.alias(f.name) for c, f in zip(fields, source.schema.fields, strict=True)])


def _replay(spark: SparkSession, source: DataFrame, ts_col: str, build, mode: str, days_per_chunk: int,
            late: DataFrame | None = None, closing: DataFrame | None = None, sink=None):
    """Deliver ``source`` in time order as arriving files, then ``late`` and ``closing``; drain ``build(folder)`` after each.

    A chunk is one micro-batch whatever its number of files, so no row of a chunk meets a watermark that another of
    its files has moved.
    """
    src, out, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("src", "out", "ckpt"))
    query_df = build(src)
    write = sink or batch_folder_writer(out)
    runs = replay_by_time(spark, source, ts_col, src, lambda: run_available(query_df, write, ckpt, mode), days_per_chunk)
    for extra in (late, closing):
        if extra is not None:
            extra.select(source.columns).write.mode("append").parquet(src)
            runs.append(run_available(query_df, write, ckpt, mode))
    return out, runs, query_df.schema


def run_bursts(spark: SparkSession, events: DataFrame, user_col: str, ts_col: str, *, window: str,
               slide: str, min_count: int, max_avg_ms: float, mode: str = "complete",
               watermark: str | None = None, days_per_chunk: int = 5,
               late: DataFrame | None = None, sink=None) -> tuple[DataFrame, list]:
    """Run the burst stream over ``events`` delivered in time order; return (result, runs).

    complete: the last batch is the whole result table (equals the batch query).
    append:   every window once; a closing row lets the last windows out too.
    """

    def build(src):
        return burst_stream(stream_table(spark, src, events.schema), user_col, ts_col, window, slide, min_count, max_avg_ms, watermark)

    closing = closing_row(events, ts_col) if mode == "append" and watermark is not None else None
    out, runs, schema = _replay(spark, events, ts_col, build, mode, days_per_chunk, late, closing, sink)
    reader = read_last_batch if mode == "complete" else read_all_batches
    return reader(spark, out, schema), runs


def dropped_by_watermark(runs: list) -> int:
    """Rows the state operators dropped as late, summed over all micro-batches of all runs.

    A run keeps its latest progress updates only (100 by default); one that lost some raises instead of counting short.
    """
    total = 0
    for q in runs:
        kept = q.recentProgress
        if kept and len({p["batchId"] for p in kept}) < kept[-1]["batchId"] - kept[0]["batchId"] + 1 or len(kept) >= 100:
            raise ValueError("progress updates were dropped: raise spark.sql.streaming.numRecentProgressUpdates")
        for p in kept:
            for op in p.stateOperators:
                total += op.numRowsDroppedByWatermark
    return total


def message_stream(spark: SparkSession, src: str) -> DataFrame:
    """Messages ``(value, timestamp)`` arriving as parquet files, as ``(value, ingest_ts)``."""
    return stream_lines(spark, src, fmt="parquet")


def run_ingest_lines(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, list]:
    """SRC-3/4 + PRJ-4: messages arrive; each parsed line keeps its arrival time. Stateless, so one delivery is enough."""
    src, out, ckpt = (scratch_path(spark, f"lines-{x}") for x in ("src", "out", "ckpt"))
    parsed = parse_log_line(lines_to_fields(message_stream(spark, src)))
    lines.select("value", "timestamp").write.mode("append").parquet(src)
    runs = [run_available(parsed, batch_folder_writer(out), ckpt, "append")]
    return read_all_batches(spark, out, parsed.schema), runs


def flagged_messages(bursts: DataFrame) -> DataFrame:
    """Flagged windows as messages: all columns as JSON, the window's end as timestamp."""
    end = F.col("window_end").cast(T.TimestampNTZType())
    return bursts.select(F.to_json(F.struct(*bursts.columns), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("value"), end.alias("timestamp"))


def run_bursts_to_topic(spark: SparkSession, events: DataFrame, user_col: str, ts_col: str, root: str, *, window: str, slide: str,
                        min_count: int, max_avg_ms: float, watermark: str, days_per_chunk: int = 5) -> DataFrame:
    """STR-11, SNK-4: each closed flagged window becomes a message in the topic ``root``, written by the tasks of each
    micro-batch and put in place by one commit; returns what the topic then holds, as the windows."""
    register(spark)
    src, ckpt = (scratch_path(spark, f"topic-{x}") for x in ("src", "ckpt"))
    bursts = burst_stream(stream_table(spark, src, events.schema), user_col, ts_col, window, slide, min_count, max_avg_ms, watermark)

    def run_once():
        query = flagged_messages(bursts).writeStream.format("messages").option("writer", "bursts").option("checkpointLocation", ckpt).trigger(availableNow=True).start(root)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return query

    replay_by_time(spark, events, ts_col, src, run_once, days_per_chunk)
    closing_row(events, ts_col).select(events.columns).write.mode("append").parquet(src)
    run_once()
    held = spark.read.format("messages").load(root)
    return held.select(F.from_json("value", bursts.schema, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("w")).select("w.*")


def run_from_latest(spark: SparkSession, before: DataFrame, after: list[DataFrame], root: str) -> DataFrame:
    """SRC-4: a stream of lines that starts at the latest position of a topic that holds ``before``, and stops and starts
    again between the appends of ``after``; returns what it has seen, (value, ingest_ts)."""
    out, ckpt = (scratch_path(spark, f"latest-{x}") for x in ("out", "ckpt"))
    stream = None
    for part in (before, *after):
        append(part, root)
        stream = stream_lines(spark, root, fmt="messages", starting_offsets="latest")
        run_available(stream, batch_folder_writer(out), ckpt)
    return read_all_batches(spark, out, stream.schema)


def run_lateness(spark: SparkSession, events: DataFrame, ts_col: str, arrival_col: str, tie_col: str, days_per_chunk: int = 5) -> DataFrame:
    """STR-7: a stream of ``events`` in order of arrival, each record with the watermark it met and whether it was late."""
    src, out, ckpt = (scratch_path(spark, f"late-{x}") for x in ("src", "out", "ckpt"))
    sink, stream = LatenessSink(spark, out, ts_col, arrival_col, tie_col), stream_table(spark, src, events.schema)
    replay_by_time(spark, events, arrival_col, src, lambda: run_available(stream, sink, ckpt), days_per_chunk)
    empty = events.where("false").withColumn("watermark", F.col(ts_col)).withColumn("late", F.lit(False))
    return sink.read(empty.schema)


def run_ingest_bursts(spark: SparkSession, lines: DataFrame, *, window: str, slide: str, min_count: int,
                      max_avg_ms: float, days_per_chunk: int = 10, closing_line: str | None = None) -> DataFrame:
    """STR-2, M14 ``ingest``: windows over arrival time, the gap on game time; messages come in order of arrival.

    ``closing_line`` is a valid use of the watched item: it comes last and closes the windows before it.
    """
    messages = lines.select("value", "timestamp")

    def build(src):
        return detect_from_lines(message_stream(spark, src), window=window, slide=slide, min_count=min_count,
                                 max_avg_ms=max_avg_ms, time_basis="ingest", watermark="0 seconds")

    closing = closing_row(messages, "timestamp", value=closing_line) if closing_line else None
    out, _, schema = _replay(spark, messages, "timestamp", build, "append", days_per_chunk, None, closing)
    return read_all_batches(spark, out, schema)


FLAGGED_MAP = FLAGGED_DELTA = FLAGGED_DDL
BLACKLIST_TABLE = BLACKLIST_DDL


def flagged_map_merge(base: DataFrame, deltas: DataFrame) -> DataFrame:
    return flagged_latest(deltas, "userName", base)


def blacklist_table_merge(base: DataFrame, deltas: DataFrame) -> DataFrame:
    return blacklist_merge(base, deltas, "userName")


def flagged_tables(spark: SparkSession, root: str) -> tuple[DeltaLogTable, DeltaLogTable]:
    """The flagged-player map and the blacklist: two views (own bases) of one flagged-window delta log."""
    deltas = f"{root}/flagged-windows"
    return (DeltaLogTable(spark, f"{root}/flagged", FLAGGED_MAP, FLAGGED_DELTA, deltas),
            DeltaLogTable(spark, f"{root}/blacklist", BLACKLIST_TABLE, FLAGGED_DELTA, deltas))


def query_id(df: DataFrame) -> str:
    """The id of the stream query that runs this micro-batch; its checkpoint keeps it."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


def flagged_sink(flagged: DeltaLogTable, blacklist: DeltaLogTable, user_col: str = "userName",
                 compact_every: int = 50, count_per: str = "window"):
    """``foreachBatch`` body of PIP-2 + PIP-3 (SNK-4, STR-10/11/12).

    Each batch of newly closed flagged windows (append mode + watermark, so a
    window arrives once) is written once to the shared delta log: the work per
    trigger is the batch, not the table. Reading the flagged map gives the
    latest window per player; reading the blacklist gives one increment per
    flagged window, or with ``count_per="batch"`` one per player and batch: a
    player's latest window stands for the batch. A replayed batch overwrites
    its own delta, so it never counts twice, and deltas carry the query's id,
    so a new checkpoint adds to the table. Every ``compact_every`` batches,
    empty ones included, the deltas are folded into new bases and those that
    bases have held for long are removed. The batch (a few flagged windows) is
    persisted so the emptiness check and the write do not run it twice.
    """
    if count_per not in ("window", "batch"):
        raise ValueError("count_per must be 'window' or 'batch'")

    def apply(df: DataFrame, batch_id: int) -> None:
        rows = df.select(F.col(user_col).cast("string").alias("userName"), "avgTime", "window_end")
        rows = (flagged_latest(rows) if count_per == "batch" else rows).persist()
        try:
            if not rows.isEmpty():
                flagged.append(rows, batch_id, query_id(df))  # the blacklist reads the same delta folder
        finally:
            rows.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            flagged.compact(flagged_map_merge)
            blacklist.compact(blacklist_table_merge)
            expire(flagged, blacklist)

    return apply


__all__ = [
    "burst_stream", "detect_from_lines", "run_bursts", "dropped_by_watermark", "run_ingest_lines", "run_ingest_bursts",
    "closing_row", "message_stream", "query_id",
    "flagged_sink", "flagged_tables", "flagged_map_merge", "blacklist_table_merge",
]
