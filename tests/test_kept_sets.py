"""Kept user sets and the retention table by delta rules: equal to the matrix from events, and independent of history."""

import datetime as dt
import random

import pytest

from tessera.operators import retention
from tessera.operators.retention_delta import RetentionTable
from tessera.operators.roles import EVENTS_ROLES as R
from tessera.operators.user_sets import UserSets
from tests.conftest import SF001

DAY0 = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def partition_filters(df):
    """What each file scan of the plan prunes folders by."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [x.split("PushedFilters")[0] for x in text.split("PartitionFilters: ")[1:]]


def retention_matrix(ev, roles):
    """Rows without a time are of no day."""
    return retention.retention_matrix(ev.where("ts IS NOT NULL"), roles)


def some_events(spark, days=12, n=900, users=60, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, *range(users)]) if i % 50 == 0 else rng.randrange(users), rng.choice(["signup", "view", "view", "click", None]),
             None if i % 97 == 0 else DAY0 + dt.timedelta(minutes=rng.randrange(days * 1440))) for i in range(n)]
    rows += [(n + i, 7, "view", DAY0 + dt.timedelta(days=i % days)) for i in range(n // 2)]  # a third of all rows is one user's
    return spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz")


def test_bitmaps_answer_without_events(spark, scratch):
    ev = some_events(spark)
    sets = UserSets(spark, scratch("sets"), R)
    sets.add(ev.where("ts < '2024-01-07'"), 0)
    sets.add(ev.where("ts >= '2024-01-07' AND event_id % 3 <> 0"), 1)
    sets.add(ev.where("ts >= '2024-01-07' AND event_id % 3 = 0"), 2)  # more rows of days that are there
    want = rows_of(retention_matrix(ev, R))
    assert rows_of(sets.matrix()) == want
    sets.add(ev.where("ts >= '2024-01-07' AND event_id % 3 = 0"), 2)  # again
    assert rows_of(sets.matrix()) == want
    assert rows_of(sets.matrix(start="2024-01-03", end="2024-01-05")) == [w for w in want if dt.date(2024, 1, 3) <= w[0] <= dt.date(2024, 1, 5)]
    scans = partition_filters(sets.sets("2024-01-03", "2024-01-05"))
    assert len(scans) == 3 and all("day" in x and "2024-01-03" in x and "2024-01-05" in x for x in scans)  # other days' folders aren't listed
    assert not any("events" in f for f in sets.matrix().inputFiles())


def test_user_numbers_are_dense(spark, scratch):
    sets = UserSets(spark, scratch("sets"), R)
    ev = some_events(spark)
    sets.add(ev.where("user_id < 20"), 0)
    sets.add(ev, 1)
    numbers = sorted(r.number for r in sets._users(2).collect())
    assert numbers == list(range(len(numbers))) and len(numbers) == len({r.user for r in sets._users(2).collect()})


def test_many_buckets(spark, scratch):
    """More users than one bitmap holds."""
    users = spark.range(70_000).selectExpr("id AS event_id", "id AS user_id", "IF(id % 2 = 0, 'signup', 'view') AS event_type", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts")
    back = spark.range(0, 70_000, 7).selectExpr("id AS event_id", "id AS user_id", "'view' AS event_type", "TIMESTAMP_NTZ '2024-01-03 10:00:00' AS ts")
    sets = UserSets(spark, scratch("sets"), R)
    sets.add(users.unionByName(back), 0)
    got = {r.date.day: r for r in sets.matrix().collect()}
    assert (got[1].newAddUserCnt, got[1].activeUserCnt, got[1].d1_retained, got[1].d2_retained) == (35_000, 70_000, 0, 5000)
    assert got[3].activeUserCnt == 10_000 and sets.sets().select("bucket").distinct().count() == 3


def test_empty_log(spark, scratch):
    ev = some_events(spark).where("false")
    sets, table = UserSets(spark, scratch("sets"), R), RetentionTable(spark, scratch("deltas"), R)
    sets.add(ev, 0)
    table.arrive(ev, 0)
    assert sets.matrix().collect() == table.read().collect() == []
    assert UserSets(spark, scratch("none"), R).matrix().collect() == []


@pytest.mark.parametrize("order", [[3, 0, 5, 1, 4, 2], [5, 4, 3, 2, 1, 0]])
def test_days_one_by_one_and_out_of_order(spark, scratch, order):
    ev = some_events(spark, days=6, n=240, users=25)
    table, so_far = RetentionTable(spark, scratch("deltas"), R), None
    for load, d in enumerate(order):
        day = ev.where(f"to_date(ts) = DATE '2024-01-01' + {d}")
        table.arrive(day, load)
        so_far = day if so_far is None else so_far.unionByName(day)
        assert rows_of(table.read()) == rows_of(retention_matrix(so_far, R))
    again = rows_of(table.read())
    table.arrive(day, len(order) - 1)  # a replay
    table.arrive(ev.where("event_id % 2 = 0"), len(order))  # rows that are there
    assert rows_of(table.read()) == again


def test_late_rows_of_a_day(spark, scratch):
    ev = some_events(spark)
    table = RetentionTable(spark, scratch("deltas"), R)
    for load, part in enumerate(("event_id % 4 = 1", "event_id % 4 = 3", "event_id % 4 = 0", "event_id % 4 = 2")):
        table.arrive(ev.where(part), load)
    assert rows_of(table.read()) == rows_of(retention_matrix(ev, R))


def test_what_a_load_reads_is_independent_of_history(spark, scratch):
    """A day's load reads the days around it: as many files after twenty days of history as after ten."""
    table = RetentionTable(spark, scratch("deltas"), R)
    table.arrive(some_events(spark, days=20, n=800), 0)
    near = [dt.date(2024, 1, 21) + dt.timedelta(days=k) for k in range(-7, 8)]
    scans = partition_filters(table.stored(1, near))
    assert len(scans) == 1 and all(str(d) in scans[0] for d in near)
    read = table.stored(1, near).select("day").distinct().collect()
    assert {r.day for r in read} <= set(near[:7])


def test_on_the_given_table(spark, scratch):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    sets = UserSets(spark, scratch("sets"), R)
    sets.add(ev, 0)
    assert rows_of(sets.matrix()) == rows_of(retention_matrix(ev, R))
