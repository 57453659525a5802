"""F2 golden bursts: the reference's 10 s / 5 s rule on tab lines, batch and streamed."""

from pyspark.sql import functions as F

from tessera.operators import bursts, clean
from tessera.plans.streams import burst_stream, dropped_by_watermark
from tessera.sources.logs import lines_to_fields
from tessera.streaming.runner import run_available
from tessera.streaming.sinks import batch_folder_writer, committed_ids, read_all_batches, read_last_batch
from tessera.streaming.sources import stream_lines

HEAL = "疗伤药"


def line(user: str, sec: int, item: str = HEAL, code: str = "11") -> str:
    t = f"2018-02-01 00:{sec // 60:02d}:{sec % 60:02d}"
    return "\t".join(["a", "b", "c", code, "d", "e", "f", user, item, "g", "h", "i", t])


BURST_A = [line("A", s) for s in (10, 11, 11, 12, 12, 13)]
BURST_D = [line("D", s) for s in (91, 91, 92, 92, 93)]
OTHER = [line("B", s) for s in (10, 12, 14)] + [line("A", 11, item="other")]
BAD = ["short\tline", line("E", 10, code="x11"), line("E", 10).replace("2018-02-01", "2018-13-01")]


def flagged(df):
    return sorted((r["userName"], str(r["window_start"])[11:19], r["cnt"], r["avgTime"]) for r in df.collect())


def detect(df):
    uses = clean.item_use_filter(clean.parse_log_line(lines_to_fields(df)))
    return bursts.detect_bursts(uses, "userName", "event_ts")


def test_batch_golden(spark):
    df = spark.createDataFrame([(x,) for x in BURST_A + BURST_D + OTHER + BAD], "value STRING")
    assert flagged(detect(df)) == [
        ("A", "00:00:05", 6, 500.0), ("A", "00:00:10", 6, 500.0),
        ("D", "00:01:25", 5, 400.0), ("D", "00:01:30", 5, 400.0),
    ]
    parsed = clean.parse_log_line(lines_to_fields(df))
    reasons = sorted(r.reason for r in clean.quarantine(parsed).collect())
    assert reasons == ["bad event type", "bad time", "short line"]


def _run_sequence(spark, scratch, files, mode, watermark):
    src, out, ckpt = scratch("g-src"), scratch("g-out"), scratch("g-ckpt")
    stream = stream_lines(spark, src, maxFilesPerTrigger=1)
    uses = clean.item_use_filter(clean.parse_log_line(lines_to_fields(stream)))
    q = burst_stream(uses, "userName", "event_ts", "10 seconds", "5 seconds", 5, 1000, watermark)
    runs = []
    for i, lines in enumerate(files):
        spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.mode("append").text(src)
        runs.append(run_available(q, batch_folder_writer(out), ckpt, mode))
    return out, runs


SEQUENCE = [BURST_A, [line("C", 60)], [line("C", 90)], [line("A", 10)] * 6 + BURST_D, [line("C", 200)]]


def test_late_data_append_with_watermark(spark, scratch):
    out, runs = _run_sequence(spark, scratch, SEQUENCE, "append", "0 seconds")
    got = flagged(read_all_batches(spark, out))
    assert got == [
        ("A", "00:00:05", 6, 500.0), ("A", "00:00:10", 6, 500.0),
        ("D", "00:01:25", 5, 400.0), ("D", "00:01:30", 5, 400.0),
    ]
    # the six late A rows are pre-aggregated per window before the state operator drops them
    assert dropped_by_watermark(runs) == 2


def test_complete_mode_without_watermark_revises(spark, scratch):
    out, _ = _run_sequence(spark, scratch, SEQUENCE, "complete", None)
    got = flagged(read_last_batch(spark, out))
    assert ("A", "00:00:05", 12, 250.0) in got and ("A", "00:00:10", 12, 250.0) in got
    assert ("D", "00:01:25", 5, 400.0) in got


def test_gb2312_log_dir(spark, scratch):
    from tessera.sources.logs import scan_log_dir

    root = scratch("gb-dir")
    import os

    os.makedirs(f"{root}/2018/02", exist_ok=True)
    with open(f"{root}/2018/02/log.txt", "wb") as fh:
        fh.write(("\n".join(BURST_A + ["short\tline"]) + "\n").encode("gb2312"))
    df = scan_log_dir(spark, root, "GB2312")
    rows = df.collect()
    assert len(rows) == 7
    assert {r.item for r in rows if r.item} == {HEAL}
    assert sum(r.time is None for r in rows) == 1
    assert detect(df.select(F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in df.columns])
                            .alias("value"))).count() == 2


def test_update_mode_emits_revisions(spark, scratch):
    out, _ = _run_sequence(spark, scratch, SEQUENCE, "update", None)
    ids = committed_ids(spark, out, "batch")
    latest = {}
    for i in ids:  # later batches revise earlier rows of the same window
        for r in spark.read.parquet(f"{out}/batch={i}").collect():
            latest[(r["userName"], str(r["window_start"])[11:19])] = (r["cnt"], r["avgTime"])
    assert latest[("A", "00:00:05")] == (12, 250.0) and latest[("A", "00:00:10")] == (12, 250.0)
    assert latest[("D", "00:01:25")] == (5, 400.0)


def test_detect_from_lines_both_time_bases(spark):
    import pytest

    from tessera.plans.streams import detect_from_lines

    df = spark.createDataFrame([(x,) for x in BURST_A + BURST_D + OTHER + BAD], "value STRING")
    P = dict(window="10 seconds", slide="5 seconds", min_count=5, max_avg_ms=1000)
    assert flagged(detect_from_lines(df, **P)) == flagged(detect(df))
    # arrival-time basis: all lines arrive in one instant, the gap is still that of the game time:
    # A 3 s over 6 uses, D 2 s over 5; H's five uses, one hour apart, are 14400 s over 5: not flagged
    hours = ["\t".join([*line("H", 0).split("\t")[:12], f"2018-02-01 {i:02d}:00:00"]) for i in range(5)]
    both = df.unionByName(spark.createDataFrame([(x,) for x in hours], "value STRING"))
    ingest = both.withColumn("ingest_ts", F.lit("2018-02-01 00:00:00").cast("timestamp"))
    got = sorted((r.userName, r.cnt, r.avgTime) for r in detect_from_lines(ingest, time_basis="ingest", **P).collect())
    assert got == [("A", 6, 500.0), ("A", 6, 500.0), ("D", 5, 400.0), ("D", 5, 400.0)]
    with pytest.raises(ValueError):
        detect_from_lines(df, time_basis="wall", **P)


def test_console_sinks(spark, scratch, capsys):
    from tessera.streaming.runner import console_sink, start_console

    src = scratch("c-src")
    spark.createDataFrame([(x,) for x in BURST_A], "value STRING").coalesce(1).write.mode("append").text(src)
    stream = stream_lines(spark, src)
    q = detect(stream)
    run_available(q, console_sink(), scratch("c-ckpt"), "complete")
    assert "batch 0" in capsys.readouterr().out
    live = start_console(q, scratch("c-ckpt2"), "complete", "1 second")
    try:
        live.processAllAvailable()
        assert live.lastProgress is not None and live.lastProgress["numInputRows"] == len(BURST_A)
    finally:
        live.stop()


def test_stream_run_to_end_equals_batch(spark):
    from tessera.operators.bursts import detect_bursts
    from tessera.plans.streams import run_bursts

    clicks = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_type = 'click'")
    P = dict(window="1 day", slide="12 hours", min_count=2, max_avg_ms=6 * 3600 * 1000.0)
    batch = detect_bursts(clicks, "user_id", "ts", **P)
    streamed, runs = run_bursts(spark, clicks, "user_id", "ts", mode="complete", **P)
    streamed = streamed.select(batch.columns)
    assert len(runs) > 1  # several arrivals, state carried between runs
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0


def test_many_files_in_a_chunk_lose_nothing(spark):
    """A time chunk in many unsorted files is one micro-batch: no row is late, all windows come out."""
    from tessera.operators.bursts import detect_bursts
    from tessera.plans.streams import dropped_by_watermark as dropped
    from tessera.plans.streams import run_bursts

    clicks = spark.read.parquet("/root/testdata/sf0.01/events.parquet").where("event_type = 'click'")
    P = dict(window="1 day", slide="12 hours", min_count=2, max_avg_ms=6 * 3600 * 1000.0)
    batch = detect_bursts(clicks, "user_id", "ts", **P)
    streamed, runs = run_bursts(spark, clicks.repartition(40), "user_id", "ts", mode="append", watermark="0 seconds", **P)
    streamed = streamed.select(batch.columns)
    assert dropped(runs) == 0
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0


def test_lines_without_a_time_reach_the_stream(spark):
    from tessera.plans.streams import run_ingest_lines
    from tessera.sources.derived import lines_from_events

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events = events.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts")))
    out, _ = run_ingest_lines(spark, lines_from_events(events))
    assert out.count() == events.count()
    untimed = out.where("ingest_ts IS NULL")
    assert untimed.count() == events.where("ts IS NULL").count() and untimed.where("is_valid").count() == 0


def test_replay_delivers_rows_without_a_time(spark):
    from tessera.plans.streams import run_bursts

    rows = spark.createDataFrame([(1, None), (2, None)], "user_id BIGINT, ts TIMESTAMP_NTZ")
    out, runs = run_bursts(spark, rows, "user_id", "ts", window="1 day", slide="12 hours", min_count=1, max_avg_ms=1e9)
    assert len(runs) == 1 and sum(p["numInputRows"] for p in runs[0].recentProgress) == 2 and out.count() == 0


def test_count_per_batch_adds_one_for_each_player(spark, scratch):
    import datetime as dt

    from tessera.plans.streams import blacklist_table_merge, flagged_sink, flagged_tables

    t = dt.datetime(2018, 2, 1)
    rows = [("A", 500.0, t), ("A", 400.0, t + dt.timedelta(seconds=5)), ("D", 300.0, t)]
    df = spark.createDataFrame(rows, "userName STRING, avgTime DOUBLE, window_end TIMESTAMP_NTZ")
    for count_per, want in (("window", [("A", 400.0, 2), ("D", 300.0, 1)]), ("batch", [("A", 400.0, 1), ("D", 300.0, 1)])):
        fm, bl = flagged_tables(spark, scratch(f"cp-{count_per}"))
        flagged_sink(fm, bl, count_per=count_per)(df, 0)
        assert sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect()) == want


def test_blank_lines_are_kept(spark, scratch):
    import os

    from tessera.sources.logs import scan_log_dir

    root = scratch("blank-dir")
    os.makedirs(f"{root}/a/b", exist_ok=True)
    with open(f"{root}/a/b/log.txt", "wb") as fh:
        fh.write((BURST_A[0] + "\n\n   \n" + "short\tline\n").encode("gb2312"))
    rows = scan_log_dir(spark, root, "GB2312").collect()
    assert len(rows) == 4 and sum(r.item == HEAL for r in rows) == 1 and sum(r.time is None for r in rows) == 3
