"""F4/F5 keyed tables: set-based upserts, replays, versions."""

import datetime as dt

from tessera.operators import tables
from tessera.streaming.sinks import VersionedTable

T0 = dt.datetime(2018, 2, 1)


def test_blacklist_golden(spark):
    existing = spark.createDataFrame([("A", 500.0, 2)], "userName STRING, avgTime DOUBLE, cnt INT")
    batch = spark.createDataFrame(
        [("A", 250.0, T0 + dt.timedelta(seconds=10)), ("A", 260.0, T0 + dt.timedelta(seconds=15)),
         ("D", 400.0, T0 + dt.timedelta(seconds=95))],
        "userName STRING, avgTime DOUBLE, window_end TIMESTAMP")
    got = sorted(tuple(r) for r in tables.blacklist_merge(existing, batch).collect())
    assert got == [("A", 260.0, 4), ("D", 400.0, 1)]


def test_upsert_daily_replaces_by_date(spark):
    cols = "date STRING, newAddUserCnt BIGINT, activeUserCnt BIGINT"
    old = spark.createDataFrame([("2018-02-01", 0, 0), ("2018-01-31", 5, 9)], cols)
    new = spark.createDataFrame([("2018-02-01", 3, 4)], cols)
    got = sorted(tuple(r) for r in tables.upsert_daily(old, new).collect())
    assert got == [("2018-01-31", 5, 9), ("2018-02-01", 3, 4)]


def test_flagged_latest_last_window_wins(spark):
    rows = [("A", 500.0, T0 + dt.timedelta(seconds=15)), ("A", 250.0, T0 + dt.timedelta(seconds=20))]
    w = spark.createDataFrame(rows, "userName STRING, avgTime DOUBLE, window_end TIMESTAMP")
    assert tables.flagged_latest(w).first()["avgTime"] == 250.0


def test_versioned_merge_replay_is_idempotent(spark, scratch):
    bl = VersionedTable(spark, scratch("bl"), "userName STRING, avgTime DOUBLE, cnt INT")
    batch = spark.createDataFrame([("A", 250.0, T0)], "userName STRING, avgTime DOUBLE, window_end TIMESTAMP")
    merge = lambda old, new: tables.blacklist_merge(old, new)
    bl.merge(batch, 0, merge)
    bl.merge(batch, 1, merge)
    bl.merge(batch, 1, merge)  # batch 1 replayed after a failure
    assert bl.versions() == [0, 1]
    assert tuple(bl.read().first()) == ("A", 250.0, 2)


def test_sanctions_policy(spark):
    bl = spark.createDataFrame([("A", 1.0, 4), ("B", 1.0, 1), ("C", 1.0, 2)], "userName STRING, avgTime DOUBLE, cnt INT")
    seen = spark.createDataFrame([("A", T0), ("B", T0), ("C", T0 + dt.timedelta(days=9))],
                                 "userName STRING, last_seen TIMESTAMP")
    got = {r.userName: r.action for r in tables.sanctions(bl, seen, "2018-02-12").collect()}
    assert got == {"A": "close", "B": "clear", "C": "warn"}


def test_daily_report_job_upserts_by_date(spark, scratch):
    from tessera.plans import inputs, jobs

    path = inputs.gamelog_json_path(spark, "/root/testdata/sf0.001")
    root = scratch("daily")
    jobs.run_daily_report(spark, path, "2024-01-10", root, fmt="json")
    jobs.run_daily_report(spark, path, "2024-01-11", root, fmt="json")
    jobs.run_daily_report(spark, path, "2024-01-10", root, fmt="json")  # rerun replaces, not duplicates
    t = jobs.daily_result_table(spark, root).read()
    assert sorted(r.date for r in t.collect()) == ["2024-01-10", "2024-01-11"]


def test_new_checkpoint_adds_to_the_tables(spark, scratch):
    """Batch ids start again with a new checkpoint: neither the base nor old deltas may hide or lose what comes."""
    from tessera.plans.streams import blacklist_table_merge, flagged_map_merge, flagged_tables

    flagged, bl = flagged_tables(spark, scratch("nc"))
    schema = "userName STRING, avgTime DOUBLE, window_end TIMESTAMP_NTZ"
    flagged.append(spark.createDataFrame([("A", 500.0, T0)], schema), 0, "first")
    flagged.append(spark.createDataFrame([("A", 400.0, T0 + dt.timedelta(seconds=5))], schema), 1, "first")
    for t, merge in ((flagged, flagged_map_merge), (bl, blacklist_table_merge)):
        t.compact(merge)
    flagged.append(spark.createDataFrame([("Z", 300.0, T0)], schema), 0, "second")
    assert sorted(r.userName for r in flagged.read(flagged_map_merge).collect()) == ["A", "Z"]
    assert sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect()) == [("A", 400.0, 2), ("Z", 300.0, 1)]


def test_empty_batches_still_compact_and_expire(spark, scratch):
    from tessera.plans.streams import blacklist_table_merge, flagged_sink, flagged_tables
    from tessera.streaming.sinks import committed_ids

    flagged, bl = flagged_tables(spark, scratch("ec"))
    sink = flagged_sink(flagged, bl, compact_every=2)
    schema = "userName STRING, avgTime DOUBLE, window_end TIMESTAMP_NTZ"
    some = [spark.createDataFrame([("A", 500.0, T0 + dt.timedelta(seconds=i))], schema) for i in range(3)]
    none = spark.createDataFrame([], schema)
    sink(some[0], 0)
    sink(none, 1)  # nobody flagged, but its turn to compact
    assert bl.bases() == [0]
    sink(some[1], 2)
    sink(none, 3)
    sink(some[2], 4)
    assert bl.bases() == [0, 1] and committed_ids(spark, f"{bl.deltas}/run=0", "batch") == [2, 4]  # 0 is in both bases
    assert [tuple(r) for r in bl.read(blacklist_table_merge).collect()] == [("A", 500.0, 3)]


def test_reports_of_different_dates_do_not_overwrite_each_other(spark, scratch):
    from tessera.plans.jobs import daily_result_table
    from tessera.schemas import DAILY_RESULT_DDL

    table = daily_result_table(spark, scratch("dates"))
    assert table.read().count() == 0
    rows = {d: spark.createDataFrame([(d, n, n, *["0.00%"] * 7)], DAILY_RESULT_DDL) for d, n in (("2024-01-01", 1), ("2024-01-02", 2))}
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:  # two writers that both started from the empty table
        list(pool.map(table.replace, rows.values()))
    assert sorted((r.date, r.newAddUserCnt) for r in table.read().collect()) == [("2024-01-01", 1), ("2024-01-02", 2)]
    table.replace(spark.createDataFrame([("2024-01-02", 5, 5, *["0.00%"] * 7)], DAILY_RESULT_DDL))
    assert sorted((r.date, r.newAddUserCnt) for r in table.read().collect()) == [("2024-01-01", 1), ("2024-01-02", 5)]


def test_sync_blacklist_counts_once_per_sync(spark, scratch):
    from tessera.plans.jobs import sync_blacklist

    path = scratch("flagged")
    spark.createDataFrame([("A", "250.0", T0), ("D", "400", T0 + dt.timedelta(hours=1))],
                          "userName STRING, avgTime STRING, window_end TIMESTAMP_NTZ") \
        .write.mode("overwrite").parquet(path)
    bl = VersionedTable(spark, scratch("bl"), "userName STRING, avgTime DOUBLE, cnt INT")
    for sync in (0, 1, 1):  # the reference's counting: every poll adds one per flagged player
        sync_blacklist(spark, path, bl, sync)
    assert sorted(tuple(r) for r in bl.read().collect()) == [("A", 250.0, 2), ("D", 400.0, 2)]
    # counting new offences only: the next sync after T0 + 30 min sees D's window alone
    sync_blacklist(spark, path, bl, 2, since=T0 + dt.timedelta(minutes=30))
    assert sorted(tuple(r) for r in bl.read().collect()) == [("A", 250.0, 2), ("D", 400.0, 3)]


def test_merge_stats_matches_single_pass(spark):
    from pyspark.sql import functions as F

    from tessera.operators.bursts import burst_stats, merge_stats

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_type = 'click'")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    a = ev.where(F.col("ts") < cut).groupBy("user_id").agg(*burst_stats("ts"))
    b = ev.where(F.col("ts") >= cut).groupBy("user_id").agg(*burst_stats("ts"))
    whole = ev.groupBy("user_id").agg(*burst_stats("ts"))
    merged = merge_stats(a, b, ["user_id"]).select(whole.columns)
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_delta_log_table_replay_and_compaction(spark, scratch):
    from tessera.plans.streams import blacklist_table_merge, flagged_map_merge, flagged_tables

    flagged, bl = flagged_tables(spark, scratch("ft"))
    schema = "userName STRING, avgTime DOUBLE, window_end TIMESTAMP_NTZ"
    d0 = spark.createDataFrame([("A", 500.0, T0), ("A", 450.0, T0 + dt.timedelta(seconds=5))], schema)
    d1 = spark.createDataFrame([("A", 250.0, T0 + dt.timedelta(seconds=30)), ("D", 400.0, T0)], schema)
    bl.append(d0, 0)  # one delta log shared by both tables
    bl.append(d1, 1)
    bl.append(d1, 1)  # replay
    assert sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect()) == [("A", 250.0, 3), ("D", 400.0, 1)]
    bl.compact(blacklist_table_merge)
    bl.append(spark.createDataFrame([("D", 300.0, T0 + dt.timedelta(seconds=60))], schema), 2)
    assert sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect()) == [("A", 250.0, 3), ("D", 300.0, 2)]
    bl.compact(blacklist_table_merge)
    bl.compact(blacklist_table_merge)  # nothing new: no-op
    assert sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect()) == [("A", 250.0, 3), ("D", 300.0, 2)]
    fm = {r.userName: r.avgTime for r in flagged.read(flagged_map_merge).collect()}
    assert fm == {"A": 250.0, "D": 300.0}  # both views see every delta


def test_stream_sink_failure_and_restart_counts_once(spark, scratch):
    """A batch that fails after writing is replayed with the same id on restart: no double count."""
    import pytest

    from tessera.plans.streams import blacklist_table_merge, detect_from_lines, flagged_sink, flagged_tables
    from tessera.streaming.runner import run_available
    from tessera.streaming.sources import stream_lines
    from tests.test_golden_stream import BURST_A, BURST_D, line

    src, ckpt = scratch("ft-src"), scratch("ft-ckpt")
    spark.createDataFrame([(x,) for x in BURST_A + BURST_D + [line("C", 200)]], "value STRING") \
        .coalesce(1).write.mode("append").text(src)
    q = detect_from_lines(stream_lines(spark, src), window="10 seconds", slide="5 seconds", min_count=5,
                          max_avg_ms=1000, watermark="0 seconds")
    fm, bl = flagged_tables(spark, scratch("ft-tables"))
    sink = flagged_sink(fm, bl)
    failed = []

    def flaky(df, batch_id):
        sink(df, batch_id)
        if not df.isEmpty() and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write, before the batch committed")

    from pyspark.errors import StreamingQueryException

    with pytest.raises(StreamingQueryException):
        run_available(q, flaky, ckpt, "append")
    run_available(q, flaky, ckpt, "append")  # restart from the checkpoint: the failed batch runs again
    got = sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect())
    assert failed and got == [("A", 500.0, 2), ("D", 400.0, 2)]
