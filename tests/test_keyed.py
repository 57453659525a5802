"""The bucketed keyed table, and scans that skip by user."""

import datetime as dt
import threading

from tessera.operators.tables import blacklist_merge
from tessera.schemas import BLACKLIST_DDL
from tessera.sources.logs import user_history, write_user_runs
from tessera.streaming.keyed import BucketedTable, blacklist_join

T0 = dt.datetime(2024, 1, 1)
BATCH = "userName string, avgTime double, window_end timestamp_ntz"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batch(spark, first, n, users=40):
    return spark.createDataFrame([(f"p{(first + i) * 7 % users}", float(first + i), T0 + dt.timedelta(hours=first + i)) for i in range(n)], BATCH)


def join8(old, new):
    return blacklist_join(old, new, buckets=8)


def test_merges_equal_the_keyed_aggregate(spark, scratch):
    table, want = BucketedTable(spark, scratch("bl"), BLACKLIST_DDL, "userName", 8, keep=2), spark.createDataFrame([], BLACKLIST_DDL)
    assert table.read().collect() == []
    for n, size in enumerate((30, 0, 25, 60)):
        part = batch(spark, 100 * n, size)
        want = spark.createDataFrame(blacklist_merge(want, part).collect(), BLACKLIST_DDL)
        for _ in range(2):  # a sync that comes again adds nothing
            table.merge(part, n, join8)
        assert rows_of(table.read()) == rows_of(want)
    assert table.versions() == [2, 3] and table.applied(3) == [0, 1, 2, 3]
    again = BucketedTable(spark, table.root, BLACKLIST_DDL, "userName", 8)
    assert rows_of(again.read()) == rows_of(want)


def test_the_base_is_not_shuffled(spark, scratch):
    table = BucketedTable(spark, scratch("bl"), BLACKLIST_DDL, "userName", 8)
    table.merge(batch(spark, 0, 300, 200), 0, join8)
    plan = join8(table.read(), batch(spark, 500, 20))._jdf.queryExecution().executedPlan().toString()
    base = plan[: plan.index("Bucketed: true")].split("\n")
    depth = len(base[-1]) - len(base[-1].lstrip(" :+-|*"))
    above = []  # operators on the way from the base's scan to the root
    for line in reversed(base):
        d = len(line) - len(line.lstrip(" :+-|*"))
        if d < depth:
            above.append(line.strip(" :+-|*"))
            depth = d
    assert any("Join" in x for x in above)
    below_join = above[: next(i for i, x in enumerate(above) if "Join" in x)]
    assert not any("Exchange" in x for x in below_join) and "Exchange" in plan  # the batch alone moves
    files = [f.rsplit("_", 1)[1][:5] for f in table.read().inputFiles()]
    assert len(files) == len(set(files)) == 8  # one file a bucket: the next merge reads and writes bucket by bucket


def test_two_syncs_at_once_lose_none(spark, scratch):
    table, failed = BucketedTable(spark, scratch("bl"), BLACKLIST_DDL, "userName", 4), []
    table.merge(batch(spark, 0, 30), 0, join8)
    start = threading.Barrier(3)

    def sync(n):
        try:
            part = batch(spark, 100 * n, 30)
            own = BucketedTable(spark, table.root, BLACKLIST_DDL, "userName", 4)
            start.wait()
            own.merge(part, n, lambda old, new: blacklist_join(old, new, buckets=4))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=sync, args=(n,)) for n in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and table.versions() == [0, 1, 2, 3] and table.applied(3) == [0, 1, 2, 3]
    assert sum(r.cnt for r in table.read().collect()) == 4 * 30


def test_a_version_that_is_there_is_not_replaced(spark, scratch):
    table = BucketedTable(spark, scratch("bl"), BLACKLIST_DDL, "userName", 4)
    table.merge(batch(spark, 0, 5), 0, join8)
    staged = table._write(spark.createDataFrame([("x", 1.0, 1)], BLACKLIST_DDL), [9])
    assert not table._put(staged, 0) and table._put(staged, 1) and rows_of(table.read()) == [("x", 1.0, 1)]


def scanned(df):
    """(rows that the query returns, rows that its scan has read)."""
    n = len(df.collect())
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return n, scan.metrics().get("numOutputRows").get().value()


def test_a_users_history_skips_row_groups(spark, scratch):
    rows = spark.range(200_000).selectExpr("id AS event_id", "pmod(hash(id), 5000) * 2 AS user_id", "timestampadd(MINUTE, id % 2880, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS ts")
    path, plain = scratch("runs"), scratch("plain")
    write_user_runs(rows, path, "user_id", "ts", **{"parquet.block.size": 64 * 1024})
    rows.repartition(8).write.mode("overwrite").parquet(plain)
    want = rows_of(rows.where("user_id IN (84, 4242)"))
    got = user_history(spark, path, [84, 4242], "user_id")
    assert rows_of(got.select("event_id", "user_id", "ts")) == want and got.columns[-1] == "event_date"
    found, read = scanned(user_history(spark, path, [84, 4242], "user_id"))
    _, all_ = scanned(user_history(spark, plain, [84, 4242], "user_id"))
    assert found == len(want) and all_ == 200_000 and read < all_ / 4
    assert scanned(user_history(spark, path, [4243], "user_id")) == (0, 0)  # within the ranges, but in no Bloom filter
