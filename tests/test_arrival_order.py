"""Record-wise lateness, panes, sanctions over time and counted polls against plain Python."""

import datetime as dt
import random

import pytest

from tessera.operators import lateness, panes, polls
from tessera.operators.bursts import detect_bursts
from tessera.operators.sanction_history import sanction_history
from tessera.plans import jobs, streams
from tessera.streaming.sinks import VersionedTable

T0 = dt.datetime(2024, 1, 1)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def disordered(n=400, seed=3):
    """(id, user, ts, arrival): late up to three hours, ties of arrival, no times, one user with a third of the rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        ts = minutes(rng.randrange(5000))
        out.append((i, 7 if i % 3 == 0 else rng.randrange(9), None if i % 41 == 0 else ts, ts + dt.timedelta(minutes=rng.choice([0, 0, 5, 60, 180]))))
    return out


SCHEMA = "id long, user long, ts timestamp_ntz, arrival timestamp_ntz"


def met(rows):
    """The watermark that each record meets."""
    out, most = {}, None
    for i, _, ts, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        out[i] = most
        most = ts if most is None else most if ts is None else max(most, ts)
    return out


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_watermark_of_every_record(spark, partitions):
    rows = disordered()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = lateness.split_late(spark.createDataFrame(rows, SCHEMA).repartition(partitions + 1), "ts", "arrival", "id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want = met(rows)
    assert {r.id: r.watermark for r in got} == want and len(got) == len(rows)
    assert all(r.late == (r.ts is not None and want[r.id] is not None and r.ts < want[r.id]) for r in got) and any(r.late for r in got)


def test_delay_start_and_time_zone_type(spark):
    rows = disordered(60)
    df = spark.createDataFrame(rows, SCHEMA)
    start = minutes(2500)
    got = lateness.split_late(df, "ts", "arrival", "id", "2 hours", (start - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)).collect()
    want = {i: start if w is None else max(w, start) for i, w in met(rows).items()}
    assert {r.id: r.watermark for r in got} == want
    assert all(r.late == (r.ts is not None and r.ts < want[r.id] - dt.timedelta(hours=2)) for r in got)
    zoned = lateness.split_late(df.withColumn("ts", df.ts.cast("timestamp")), "ts", "arrival", "id")
    assert dict(zoned.dtypes)["watermark"] == "timestamp"
    assert rows_of(zoned.selectExpr("id", "CAST(watermark AS timestamp_ntz)")) == sorted(met(rows).items())
    assert lateness.split_late(df.where("false"), "ts", "arrival", "id").collect() == []


@pytest.mark.parametrize("days", [1, 2])
def test_stream_gives_the_same_whatever_the_batches(spark, days):
    rows = disordered(200)
    got = streams.run_lateness(spark, spark.createDataFrame(rows, SCHEMA), "ts", "arrival", "id", days)
    assert {r.id: r.watermark for r in got.collect()} == met(rows)


def test_a_replayed_batch_starts_from_the_same_mark(spark, scratch):
    rows = sorted(disordered(120), key=lambda r: (r[3], r[0]))
    cuts = [spark.createDataFrame(x, SCHEMA) for x in (rows[:40], rows[40:70], rows[70:])]
    sink = lateness.LatenessSink(spark, scratch("late"), "ts", "arrival", "id")
    for n, part in [(0, cuts[0]), (1, cuts[1]), (1, cuts[1]), (2, cuts[2]), (2, cuts[2])]:
        sink(part, n)
    assert {r.id: r.watermark for r in sink.read(SCHEMA).collect()} == met(rows)


def test_records_join_open_windows_only(spark):
    rows = disordered()
    hour = dt.timedelta(hours=1)
    seen = {}
    for i, user, ts, _ in rows:
        for k in range(3) if ts is not None else ():
            begin = T0 + hour * ((ts - T0) // hour - k)
            if met(rows)[i] is None or begin + 3 * hour > met(rows)[i]:
                seen.setdefault((begin, begin + 3 * hour, user), []).append(ts)
    want = sorted((*k, len(v), round((max(v) - min(v)).total_seconds() * 1000 / len(v), 4)) for k, v in seen.items() if len(v) >= 2 and (max(v) - min(v)).total_seconds() * 1000 / len(v) < 3e6)
    got = lateness.detect_bursts_on_time(spark.createDataFrame(rows, SCHEMA), "user", "ts", "arrival", "id", window="3 hours", slide="1 hour", min_count=2, max_avg_ms=3e6)
    assert rows_of(got) == want and want


@pytest.mark.parametrize("window,slide", [("1 day", "1 hour"), ("10 seconds", "5 seconds"), ("90 minutes", "60 minutes"), ("1 hour", "1 hour"), ("7 minutes", "3 minutes")])
def test_panes_equal_copied_windows(spark, window, slide, monkeypatch):
    monkeypatch.setattr(panes, "STRETCH", 2)
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 2, None]), T0 + dt.timedelta(seconds=rng.randrange(-90_000, 90_000) if window != "10 seconds" else rng.randrange(120), microseconds=rng.randrange(10**6))) for _ in range(500)] + [(1, None)]
    events = spark.createDataFrame(rows, "user long, ts timestamp_ntz")
    rule = dict(min_count=2, max_avg_ms=1e9)
    want = rows_of(detect_bursts(events, "user", "ts", window, slide, **rule))
    got = panes.detect_bursts_by_panes(events, "user", "ts", window, slide, **rule)
    assert rows_of(got) == want and want
    stats = panes.pane_stats(events, "user", "ts", panes.duration_us(slide))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in stats and "Expand" not in stats  # an event is one row until it is in its pane


def test_panes_of_zoned_times_and_no_events(spark):
    events = spark.createDataFrame([(1, T0), (1, T0 + dt.timedelta(minutes=5))], "user long, ts timestamp")
    rule = dict(window="1 hour", slide="15 minutes", min_count=2, max_avg_ms=1e9)
    assert rows_of(panes.detect_bursts_by_panes(events, "user", "ts", **rule)) == rows_of(detect_bursts(events, "user", "ts", **rule))
    assert panes.detect_bursts_by_panes(events.where("false"), "user", "ts", **rule).count() == 0


def history(times, as_of, most=3, week=dt.timedelta(days=7)):
    """One player's changes, offence by offence."""
    out, cnt, last = [], 0, None
    for t in sorted(t for t in times if t <= as_of):
        if last is not None and t > last + week:
            out.append((last + week, "clear", 0))
            cnt = 0
        cnt, last = cnt + 1, t
        if cnt == 1:
            out.append((t, "warn", 1))
        if cnt > most:
            return [*out, (t, "close", cnt)]
    return [*out, (last + week, "clear", 0)] if last is not None and last + week < as_of else out


def test_sanction_history(spark):
    rng = random.Random(9)
    day = dt.timedelta(days=1)
    players = {f"p{i}": [T0 + day * rng.randrange(60) for _ in range(rng.randrange(1, 12))] for i in range(40)}
    players |= {"edge": [T0, T0 + 7 * day, T0 + 14 * day + dt.timedelta(seconds=1)], "late": [T0 + 59 * day], "future": [T0 + 90 * day], "same": [T0] * 4}
    rows = [(u, t) for u, ts in players.items() for t in ts] + [(None, T0), ("edge", None)]
    got = sanction_history(spark.createDataFrame(rows, "userName string, end timestamp_ntz"), "userName", "end", "2024-03-01")
    as_of = dt.datetime(2024, 3, 1)
    assert rows_of(got) == sorted((u, *c) for u, ts in players.items() for c in history(ts, as_of))


def test_polls_equal_ticks_run_through(spark, scratch):
    rng = random.Random(4)
    rows = [(f"p{rng.randrange(6)}", float(i), T0 + dt.timedelta(milliseconds=rng.randrange(120_000))) for i in range(30)] + [("late", 1.0, T0 + dt.timedelta(minutes=9)), (None, 1.0, T0)]
    flagged = spark.createDataFrame(rows, "userName string, avgTime double, window_end timestamp_ntz")
    start, ends = T0 + dt.timedelta(seconds=10, microseconds=500), [T0 + dt.timedelta(seconds=s) for s in (10, 31, 32, 33.5, 100)]
    table, tick = {}, start
    got, last = VersionedTable(spark, scratch("polls"), jobs.POLLED_DDL), None
    for run, until in enumerate(ends):
        while tick <= until:  # the reference's timer: every player in the map, plus one
            for u in {u for u, _, t in rows if u and t <= tick}:
                avg = max((t, a) for n, a, t in rows if n == u and t <= tick)[1]
                table[u] = (avg, table.get(u, (0, 0))[1] + 1)
            tick += dt.timedelta(seconds=2)
        for _ in range(2):  # a replay adds nothing
            jobs.poll_blacklist(flagged, got, run, str(start), str(until), last and str(last))
        last = until
        assert rows_of(got.read()) == sorted((u, a, n) for u, (a, n) in table.items())
    whole = polls.polled(flagged, "userName", jobs._us(str(start)), jobs._us(str(ends[-1])))
    assert rows_of(whole) == rows_of(got.read())


def test_periodic_poll_does_not_depend_on_its_period(spark, scratch):
    rows = [("a", 1.0, T0 + dt.timedelta(seconds=3)), ("b", 2.0, T0 + dt.timedelta(seconds=9))]
    flagged = spark.createDataFrame(rows, "userName string, avgTime double, window_end timestamp_ntz")
    got = []
    for steps in ([1, 5, 20], [20], [7, 7, 7, 20]):
        times, waits = iter(T0 + dt.timedelta(seconds=s) for s in steps), []
        table = VersionedTable(spark, scratch("poll"), jobs.POLLED_DDL)
        assert jobs.poll_periodically(lambda: flagged, table, str(T0), 4.0, len(steps), lambda: next(times), waits.append) == 10
        assert waits == [4.0] * (len(steps) - 1)
        got.append(rows_of(table.read()))
    assert got[0] == got[1] == got[2] == [("a", 1.0, 9), ("b", 2.0, 6)]
    assert jobs.poll_once(flagged, table, str(T0), str(T0 - dt.timedelta(seconds=9))) < 0 and rows_of(table.read()) == got[0]
