"""Registered queries: one Spark callable per operator key, and the DuckDB oracle for it.

Every callable takes ``(spark, sf_dir)`` and reads the given tables (or files
Spark derives from them) in full. Parameters on the driver's ``events`` table
(mapping in SURVEY 7.2):

* register / login / item use = ``signup`` / ``view`` / ``click``; user =
  ``user_id``; time = ``ts``; base date 2024-01-10;
* the reference's 10 s / 5 s burst rule finds nothing on this data (events are
  minutes apart), so the burst keys use 1 day / 12 h, count >= 2,
  mean gap < 6 h. The logic is the same; the numbers are parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import sqlfn
from tessera.functions.text import percent_text
from tessera.functions.time import millis
from tessera.operators import bursts, clean, lateness, panes, polls, retention, tables, users
from tessera.operators.retention_delta import RetentionTable
from tessera.operators.roles import EVENTS_ROLES, GAMELOG_ROLES
from tessera.operators.sanction_history import sanction_history
from tessera.operators.user_sets import UserSets
from tessera.plans import inputs, jobs, streams
from tessera.schemas import BLACKLIST_DDL, HEALING_ITEM, ITEM_USE_EVENT
from tessera.session import scratch_path
from tessera.sources.derived import gamelog_from_events, lines_from_events
from tessera.sources.logs import flagged_snapshot as read_flagged, lines_to_fields, user_history as read_user_history, write_user_runs
from tessera.streaming.keyed import BucketedTable, blacklist_join
from tessera.streaming.sinks import VersionedTable

BASE = "2024-01-10"
FIRST_OPEN = "2024-01-08"  # the first date whose seventh day is not over at SPLIT
REPORT_DATES = [f"2024-01-{d:02d}" for d in range(8, 18)]
SPLIT = "2024-01-15"  # blacklist / flagged-map checks: windows ending before this are "existing"
AS_OF = "2024-01-31"
HISTORY_USERS = [7, 77, 777]
POLL_START, POLL_RUNS = "2024-01-08 00:00:01", ["2024-01-12 03:00:00", "2024-01-12 03:00:01", "2024-01-20 00:00:00"]
BURST = dict(window="1 day", slide="12 hours", min_count=2, max_avg_ms=6 * 3600 * 1000.0)
R = EVENTS_ROLES
DAYS = 7

# --------------------------------------------------------------------------- helpers


def _ev(spark, sf):
    return inputs.events(spark, sf)


def _clicks(spark, sf):
    return inputs.clicks(spark, sf)


def _parsed_lines(spark, sf) -> DataFrame:
    lines = lines_from_events(_ev(spark, sf)).select("value")
    return clean.parse_log_line(lines_to_fields(lines)).drop("line")


def _burst_windows(spark, sf) -> DataFrame:
    return bursts.detect_bursts(_clicks(spark, sf), "user_id", "ts", **BURST)


def _named(df: DataFrame) -> DataFrame:
    """Flagged windows keyed by ``userName`` (text), as the flagged map and blacklist store them."""
    return df.withColumn("userName", F.col("user_id").cast("string")).drop("user_id")


def _stored_windows(spark, sf) -> DataFrame:
    """All flagged windows from their stored table, keyed by ``userName``: the events are scanned once for it."""
    return _named(inputs.burst_windows(spark, sf, lambda c: bursts.detect_bursts(c, "user_id", "ts", **BURST)))


def _report_rows(matrix: DataFrame) -> DataFrame:
    return retention.matrix_report_rows(matrix, DAYS)


def _retained_long(spark, sf) -> DataFrame:
    """AG-4 for all n in one pass: the per-user flags unpivoted to (day_n, retained_users)."""
    c = retention.retention_counts(_ev(spark, sf), R, BASE, DAYS)
    stack = ", ".join(f"{n}, d{n}_retained" for n in range(1, DAYS + 1))
    return c.selectExpr(f"stack({DAYS}, {stack}) AS (day_n, retained_users)").select(
        F.col("day_n").cast("int"), F.col("retained_users").cast("long"))


# --------------------------------------------------------------------------- offline log keys


def q_scan_gamelog(spark, sf):
    return inputs.gamelog(spark, sf)


def q_gamelog_defaults(spark, sf):
    return clean.gamelog_defaults(inputs.gamelog(spark, sf))


def q_ip_filter(spark, sf):
    return clean.ip_filter(clean.gamelog_defaults(inputs.gamelog(spark, sf)))


def q_parse_cn_time(spark, sf):
    g = clean.with_event_time(clean.gamelog_defaults(inputs.gamelog(spark, sf)))
    return g.select("userName", "eventType", "time", "event_ts")


def q_get_time_mills(spark, sf):
    sqlfn.register(spark)
    clean.gamelog_defaults(inputs.gamelog(spark, sf)).createOrReplaceTempView("tb_game")
    return spark.sql("SELECT userName, time, getTimeMills(time) AS time_ms FROM tb_game")


def q_gamelog_quarantine(spark, sf):
    return clean.gamelog_quarantine(inputs.gamelog(spark, sf))


def q_gamelog_report(spark, sf):
    log = clean.clean_gamelog(inputs.gamelog(spark, sf))
    return retention.daily_report(log, GAMELOG_ROLES, BASE, DAYS)


def q_event_decode(spark, sf):
    g = gamelog_from_events(_ev(spark, sf)).select("event_id", "eventType")
    return clean.event_decode(g, "eventType")


# --------------------------------------------------------------------------- log-line keys


def q_parse_log_line(spark, sf):
    return _parsed_lines(spark, sf)


def q_quarantine(spark, sf):
    lines = lines_from_events(_ev(spark, sf)).select("value")
    return clean.quarantine(clean.parse_log_line(lines_to_fields(lines))).select("f0", "line", "reason")


def q_item_use_filter(spark, sf):
    return clean.item_use_filter(_parsed_lines(spark, sf))


def q_parse_iso_time(spark, sf):
    return _parsed_lines(spark, sf).select("f0", "time", millis("event_ts").alias("event_ms"))


def q_scan_log_dir(spark, sf):
    return inputs.log_dir(spark, sf)


def q_burst_lines(spark, sf):
    """PIP-2 end to end from the raw tab lines (game-time basis)."""
    return streams.detect_from_lines(lines_from_events(_ev(spark, sf)).select("value"), **BURST)


# --------------------------------------------------------------------------- events keys


def q_event_in(spark, sf):
    return clean.event_in(_ev(spark, sf), "event_type", R.active).select("event_id", "user_id", "event_type", "ts")


def q_day_slice(spark, sf):
    return clean.day_slice(_ev(spark, sf), R, BASE).select("event_id", "user_id", "event_type", "ts")


def q_day_bounds(spark, sf):
    days = _ev(spark, sf).select(F.to_date("ts").alias("day")).distinct()
    return days.select(
        "day",
        millis(F.col("day").cast("timestamp")).alias("start_ms"),
        millis(F.date_add("day", 1).cast("timestamp")).alias("end_ms"),
        millis(F.date_add("day", DAYS + 1).cast("timestamp")).alias("horizon_ms"),
    )


def q_distinct_users(spark, sf):
    return users.distinct_users(_ev(spark, sf), R)


def q_new_users(spark, sf):
    return users.new_users(_ev(spark, sf), R, BASE)


def q_active_users(spark, sf):
    return users.active_users(_ev(spark, sf), R, BASE)


def q_retained_day1(spark, sf):
    return users.retained_count(_ev(spark, sf), R, BASE, 1)


def q_retained_dayn(spark, sf):
    return _retained_long(spark, sf)


def q_retained_semi(spark, sf):
    return users.retained_semi(_ev(spark, sf), R, BASE, DAYS)


def q_retained_selfjoin(spark, sf):
    return users.retained_selfjoin(_ev(spark, sf), R, BASE, DAYS)


def q_retained_intersect(spark, sf):
    return users.retained_intersect(_ev(spark, sf), R, BASE, DAYS)


def q_retention_counts(spark, sf):
    return retention.retention_counts(_ev(spark, sf), R, BASE, DAYS)


def q_retention_rate(spark, sf):
    return retention.retention_rate(retention.retention_counts(_ev(spark, sf), R, BASE, DAYS), DAYS)


def q_first_row(spark, sf):
    return retention.retention_counts(_ev(spark, sf), R, BASE, DAYS).limit(1)


def q_metrics_union(spark, sf):
    return retention.metrics_union(_ev(spark, sf), R, BASE, DAYS)


def q_retention_report(spark, sf):
    return retention.daily_report(_ev(spark, sf), R, BASE, DAYS)


def q_retention_matrix(spark, sf):
    return retention.retention_matrix(_ev(spark, sf), R, DAYS)


def q_retention_bitmaps(spark, sf):
    """Every date's report from kept user bitmaps: two loads stored once, no scan of events after that."""
    ev, before = _ev(spark, sf), F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")

    def write(path):
        sets = UserSets(spark, path, R)
        for load, part in enumerate((before, ~before)):
            sets.add(ev.where(part), load)

    return UserSets(spark, inputs._once(spark, sf, "user-sets", write), R).matrix(DAYS)


def q_retention_by_loads(spark, sf):
    """The retention table after loads that bring days out of order, the last one late rows of all days."""
    ev, table = _ev(spark, sf), RetentionTable(spark, scratch_path(spark, "retention"), R, DAYS)
    late, third = F.col("event_id") % 10 == 0, F.dayofyear("ts") % 3
    for load, part in enumerate([(third == 2) & ~late, (third == 0) & ~late, (third == 1) & ~late, late]):
        table.arrive(ev.where(part), load)
    return table.read()


def q_percent_text(spark, sf):
    m = retention.retention_matrix(_ev(spark, sf), R, DAYS)
    stack = ", ".join(f"{n}, d{n}_retained" for n in range(1, DAYS + 1))
    long = m.selectExpr("date", "newAddUserCnt", f"stack({DAYS}, {stack}) AS (day_n, retained)")
    return long.select("date", F.col("day_n").cast("int"), percent_text("retained", "newAddUserCnt").alias("rate"))


# --------------------------------------------------------------------------- bursts


def q_burst_stats(spark, sf):
    return _clicks(spark, sf).groupBy("user_id").agg(*bursts.burst_stats("ts")).select(
        "user_id", "cnt", "maxTime", "minTime", bursts.avg_gap().alias("avgTime"))


def q_merge_stats(spark, sf):
    """FN-9: the stats of two slices of the log merged by user."""
    c = _clicks(spark, sf)
    before = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")
    parts = [c.where(x).groupBy("user_id").agg(*bursts.burst_stats("ts")) for x in (before, ~before)]
    return bursts.merge_stats(*parts, ["user_id"])


def q_burst_players(spark, sf):
    return _burst_windows(spark, sf)


def q_burst_stream(spark, sf):
    out, _ = streams.run_bursts(spark, _clicks(spark, sf), "user_id", "ts", mode="append", watermark="1 day", **BURST)
    return out


def q_burst_stream_complete(spark, sf):
    out, _ = streams.run_bursts(spark, _clicks(spark, sf), "user_id", "ts", mode="complete", **BURST)
    return bursts.flagged_players(out, "user_id")


def q_burst_stream_wm(spark, sf):
    out, _ = streams.run_bursts(spark, _clicks(spark, sf), "user_id", "ts", mode="append",
                                watermark="0 seconds", **BURST)
    return out


def q_late_drop(spark, sf):
    """Append + watermark, then the first three days arrive again after everything else.

    Those rows are behind the watermark: the state operator drops them (the
    count is in the query progress) and the result equals ``burst_stream_wm``.
    """
    c = _clicks(spark, sf)
    first = c.agg(F.min("ts")).first()[0]  # one value
    late = c.where(F.lit(False)) if first is None else c.where(F.to_date("ts") < F.date_add(F.lit(first.date()), 3))
    out, _ = streams.run_bursts(spark, c, "user_id", "ts", mode="append", watermark="0 seconds", late=late, **BURST)
    return out


def q_burst_stream_ingest(spark, sf):
    """Windows over arrival, gaps on game time (the arrival lags by up to 44 minutes)."""
    lines = lines_from_events(_ev(spark, sf))
    closing = "\t".join(["0", "0", "0", str(ITEM_USE_EVENT), "0", "0", "0", "", HEALING_ITEM, "0", "0", "0", "2024-01-01 00:00:00"])
    return streams.run_ingest_bursts(spark, lines, closing_line=closing, **BURST)


def q_stream_ingest(spark, sf):
    lines = lines_from_events(_ev(spark, sf))
    out, _ = streams.run_ingest_lines(spark, lines)
    return out.drop("line")  # ingest_ts is the message's timestamp


def q_stream_latest(spark, sf):
    """Lines from a topic's latest position on: none that were there before, each later one once over restarts."""
    lines = lines_from_events(_ev(spark, sf)).select("event_id", "value", "timestamp")
    later = F.col("timestamp") >= F.lit(SPLIT).cast("timestamp_ntz")
    even = F.col("event_id") % 2 == 0
    return streams.run_from_latest(spark, lines.where(~later), [lines.where(later & even), lines.where(later & ~even)], scratch_path(spark, "topic"))


def q_burst_messages(spark, sf):
    """Flagged windows written to a topic by the stream's tasks, and read back."""
    return streams.run_bursts_to_topic(spark, _clicks(spark, sf), "user_id", "ts", scratch_path(spark, "topic"), watermark="0 seconds", **BURST)


def _arrivals(spark, sf) -> DataFrame:
    """Events in the order in which their lines arrive: up to 44 minutes after the event."""
    return lines_from_events(_ev(spark, sf)).select("event_id", F.col("timestamp").alias("arrival"), "ts")


def q_late_records(spark, sf):
    """Each record with the watermark that it met and whether it was late by it."""
    return lateness.split_late(_arrivals(spark, sf), "ts", "arrival", "event_id")


def q_late_records_stream(spark, sf):
    """The same from a stream: the watermark goes on over micro-batches, however the records are cut into them."""
    return streams.run_lateness(spark, _arrivals(spark, sf), "ts", "arrival", "event_id")


def q_burst_on_time(spark, sf):
    """The burst rule with a record-wise watermark: a record joins the windows that were open when it arrived."""
    clicks = _clicks(spark, sf).withColumn("arrival", F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 45).cast("int")))
    return lateness.detect_bursts_on_time(clicks, "user_id", "ts", "arrival", "event_id", **BURST)


def q_burst_panes(spark, sf):
    """Windows of a day every hour, from panes of an hour: no event is copied."""
    return panes.detect_bursts_by_panes(_clicks(spark, sf), "user_id", "ts", **{**BURST, "slide": "1 hour"})


def q_blacklist_stream(spark, sf):
    """PIP-2 + PIP-3 as one stream: closed flagged windows -> delta logs of the flagged map and blacklist."""
    _, blacklist = _flagged_stream(spark, sf)
    return blacklist.read(streams.blacklist_table_merge)


def _flagged_stream(spark, sf, **sink_options):
    flagged, blacklist = streams.flagged_tables(spark, scratch_path(spark, "flagged-tables"))
    sink = streams.flagged_sink(flagged, blacklist, "userName", compact_every=3, **sink_options)
    c = _clicks(spark, sf).withColumn("userName", F.col("user_id").cast("string")).drop("user_id")
    streams.run_bursts(spark, c, "userName", "ts", mode="append", watermark="0 seconds", sink=sink, **BURST)
    return flagged, blacklist


def q_sync_blacklist(spark, sf):
    """PIP-3 end to end: stream -> flagged map as the stream stores it -> two polls of the blacklist sync (+1 each)."""
    flagged, _ = _flagged_stream(spark, sf, count_per="batch")
    table = VersionedTable(spark, scratch_path(spark, "blacklist"), BLACKLIST_DDL)
    for sync_id in (0, 1):
        jobs.sync_blacklist(spark, flagged.read(streams.flagged_map_merge), table, sync_id)
    return table.read()


# --------------------------------------------------------------------------- keyed tables


def q_flagged_latest(spark, sf):
    w = _stored_windows(spark, sf)
    existing = tables.flagged_latest(w.where(F.col("window_end") < F.lit(SPLIT).cast("timestamp_ntz")), "userName")
    return tables.flagged_latest(w.where(F.col("window_end") >= F.lit(SPLIT).cast("timestamp_ntz")),
                                 "userName", existing)


def q_flagged_snapshot(spark, sf):
    latest = tables.flagged_latest(_stored_windows(spark, sf), "userName")
    path = scratch_path(spark, "flagged-map")
    # the map stores avgTime as text, like a hash of strings
    latest.select("userName", F.col("avgTime").cast("string").alias("avgTime"), "window_end") \
        .write.mode("overwrite").parquet(path)
    return read_flagged(spark, path)


def _blacklist_parts(spark, sf):
    w = _stored_windows(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    before = w.where(F.col("window_end") < split)
    existing = before.groupBy("userName").agg(
        F.max_by("avgTime", "window_end").alias("avgTime"), F.count(F.lit(1)).cast("int").alias("cnt"))
    return existing, w.where(F.col("window_end") >= split), w


def q_blacklist_merge(spark, sf):
    existing, batch, _ = _blacklist_parts(spark, sf)
    return tables.blacklist_merge(existing, batch, "userName")


def q_upsert_daily(spark, sf):
    """The stored table as of SPLIT, then all dates whose seven days were not over by then, from the whole log."""
    ev = _ev(spark, sf)

    def write(path):
        before = ev.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
        _report_rows(retention.retention_matrix(before, R, DAYS)).write.mode("overwrite").parquet(path)

    stale = spark.read.parquet(inputs._once(spark, sf, "daily-results", write))
    # bounded below: the scan reads from the first of these dates on (ts range pushed to parquet)
    fresh = _report_rows(retention.retention_matrix(ev, R, DAYS, start=FIRST_OPEN))
    return tables.upsert_daily(stale, fresh)


def q_daily_report_saved(spark, sf):
    """PIP-1 with the save: ingest into typed day partitions, reports of ten dates in one pass, stored by date, read back."""
    typed, results = scratch_path(spark, "typed-log"), scratch_path(spark, "daily-table")
    jobs.ingest_gamelog(spark, inputs.gamelog_json_path(spark, sf), typed, fmt="json")
    for dates in (REPORT_DATES[:6], REPORT_DATES[4:]):  # two runs that share two dates
        jobs.run_daily_report(spark, typed, dates, results, typed=True)
    return jobs.daily_result_table(spark, results).read()


def q_sanctions(spark, sf):
    existing, batch, w = _blacklist_parts(spark, sf)
    bl = tables.blacklist_merge(existing, batch, "userName")
    last_seen = w.groupBy("userName").agg(F.max("window_end").alias("last_seen"))
    return tables.sanctions(bl, last_seen, AS_OF, "userName")


def q_sanction_history(spark, sf):
    """Every change of a player's state: warned, closed, cleared after a clean week."""
    return sanction_history(_stored_windows(spark, sf), "userName", "window_end", AS_OF)


def q_blacklist_bucketed(spark, sf):
    """The blacklist in hash buckets: what was flagged before SPLIT, then a batch of the later windows; each sync twice."""
    w = _stored_windows(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    table = BucketedTable(spark, scratch_path(spark, "blacklist-buckets"), BLACKLIST_DDL, "userName", buckets=8)
    merge = partial(blacklist_join, buckets=8)
    for sync_id, part in ((0, w.where(F.col("window_end") < split)), (1, w.where(F.col("window_end") >= split))):
        for _ in range(2):
            table.merge(part, sync_id, merge)
    return table.read()


def q_user_history(spark, sf):
    """All events of some users, from a log in sorted runs with Bloom filters."""
    path = inputs._once(spark, sf, "user-runs", lambda p: write_user_runs(_ev(spark, sf), p, "user_id", "ts"))
    schema = _ev(spark, sf).withColumn("event_date", F.to_date("ts")).schema
    return read_user_history(spark, path, HISTORY_USERS, "user_id", schema).select("event_id", "user_id", "event_type", "ts", "value")


def q_blacklist_polled(spark, sf):
    """The blacklist after a poll every two seconds from POLL_START to POLL_END, moved on in three runs."""
    flagged, table = _stored_windows(spark, sf), VersionedTable(spark, scratch_path(spark, "polled"), jobs.POLLED_DDL)
    for run, until in enumerate(POLL_RUNS):
        jobs.poll_blacklist(flagged, table, run, POLL_START, until, POLL_RUNS[run - 1] if run else None)
    jobs.poll_blacklist(flagged, table, 2, POLL_START, POLL_RUNS[2], POLL_RUNS[1])  # a run that comes again adds nothing
    return table.read()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
