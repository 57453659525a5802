"""Kept user sets: one bitmap per role, day and stretch of user numbers (CCH-1, AG-1..5).

Reports over the same log ask the same questions again: who registered, who
logged in, on which day. Here each day's users are stored once as bitmaps over
dense user numbers, and every later report is set algebra on them: new and
active users are bit counts, day-n retention is the count of an intersection.
Events are not read again.

A bitmap covers 32768 user numbers (4 KB; Parquet compresses its empty runs), so
a day of a billion users is some 30,000 rows a role, however many events it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.time import as_date
from tessera.operators.roles import Roles
from tessera.schemas import RETENTION_DAYS
from tessera.session import scratch_path
from tessera.streaming.sinks import committed_ids

REGISTER, LOGIN = "register", "login"
_SETS_DDL = "role STRING, bucket BIGINT, bits BINARY, day DATE"


def numbered(spark: SparkSession, keys: DataFrame, start: int, path: str) -> int:
    """Write ``keys`` to ``path`` with dense numbers from ``start`` on (column ``number``); returns how many there are.

    A distributed rank: rows are written with their partition and place, the partitions' sizes (a row each) give each
    one's first number. The numbers are fixed by what was written, so a task that runs again changes none.
    """
    staged = scratch_path(spark, "user-numbers")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    keys.withColumn("_part", F.spark_partition_id()).withColumn("_place", place).write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")).withColumn("_base", before + F.lit(start)).select("_part", "_base")
    # one row per partition of the write: a proven bound
    out = rows.join(F.broadcast(sizes), "_part").withColumn("number", F.col("_base") + F.col("_place")).drop("_part", "_place", "_base")
    out.write.mode("overwrite").parquet(path)
    return rows.count()


class UserSets:
    """The stored sets under ``root``: ``users/load=<n>`` (user, number) and ``sets/load=<n>/day=<d>``.

    ``add`` takes loads of the log one after the other, each with a number of its own; adding the same load again, after
    a failure, replaces its sets and keeps the numbers that its users have. A load may bring any days, also more rows
    of days that are there: sets of one day and role are united when read.
    """

    def __init__(self, spark: SparkSession, root: str, roles: Roles):
        self.spark, self.root, self.roles = spark, root.rstrip("/"), roles

    def _path(self, kind: str, load: int) -> str:
        return f"{self.root}/{kind}/load={load}"

    def _users(self, before: int) -> DataFrame | None:
        paths = [self._path("users", n) for n in committed_ids(self.spark, f"{self.root}/users", "load") if n < before]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, log: DataFrame, load: int) -> None:
        """Store the sets of the days in ``log``. Rows without a user or a time belong to no set."""
        r = self.roles
        ev = F.col(r.event)
        seen = (log.where(F.col(r.user).isNotNull() & F.col(r.ts).isNotNull() & ev.isin(list(r.active)))
                .groupBy(F.col(r.user).alias("user"), F.to_date(r.ts).alias("day"))
                .agg(F.bool_or(ev.isin(list(r.register))).alias(REGISTER), F.bool_or(ev.isin(list(r.login))).alias(LOGIN)))
        staged = scratch_path(self.spark, "user-days")
        seen.write.mode("overwrite").parquet(staged)  # the log is scanned once; a row per user and day from here on
        seen = self.spark.read.parquet(staged)
        if load not in committed_ids(self.spark, f"{self.root}/users", "load"):  # else later loads refer to these numbers
            known, fresh, start = self._users(load), seen.select("user").distinct(), 0
            if known is not None:
                start, fresh = known.count(), fresh.join(known, "user", "left_anti")
            numbered(self.spark, fresh, start, self._path("users", load))
        of_user = self._users(load + 1)
        bits = (seen.join(of_user, "user")
                .select("day", F.explode(F.filter(F.array(F.when(F.col(REGISTER), F.lit(REGISTER)), F.when(F.col(LOGIN), F.lit(LOGIN))), lambda x: x.isNotNull())).alias("role"), (F.col("number") + 1).alias("number"))
                .groupBy("day", "role", F.bitmap_bucket_number("number").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
        # all days of the load in few files: dealt by day and a stretch of buckets, so that a large day has several writers
        dealt = bits.repartition("day", F.floor(F.col("bucket") / 4096))
        dealt.select("role", "bucket", "bits", "day").write.mode("overwrite").partitionBy("day").parquet(self._path("sets", load))

    def sets(self, first=None, last=None) -> DataFrame:
        """(day, role, bucket, bits) of the days ``first`` to ``last``; other days' folders are not read."""
        loads = committed_ids(self.spark, f"{self.root}/sets", "load")
        out = self.spark.createDataFrame([], _SETS_DDL)
        for n in loads:
            part = self.spark.read.schema(_SETS_DDL).parquet(self._path("sets", n))
            out = part if n == loads[0] else out.unionByName(part)
        if first is not None:
            out = out.where(F.col("day") >= F.lit(as_date(first)))
        if last is not None:
            out = out.where(F.col("day") <= F.lit(as_date(last)))
        return out.groupBy("day", "role", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def matrix(self, days: int = RETENTION_DAYS, start=None, end=None) -> DataFrame:
        """New, active and day-1..``days`` retained users of every date, as ``retention_matrix`` gives them from events.

        An intersection is taken bucket by bucket: the cohort's bitmap and the login bitmap of each later day meet under
        (date, n, bucket), two rows a group, and ``bitmap_and_agg`` leaves the users in both.
        """
        last = None if end is None else F.date_add(F.lit(as_date(end)), days)
        sets = self.sets(start)
        if last is not None:
            sets = sets.where(F.col("day") <= last)
        active = sets.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.max(F.when(F.col("role") == REGISTER, F.bitmap_count("bits"))).alias("new"))
        counts = active.groupBy(F.col("day").alias("date")).agg(F.sum(F.coalesce("new", F.lit(0))).alias("newAddUserCnt"), F.sum(F.bitmap_count("bits")).alias("activeUserCnt"))
        n = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("n")
        cohorts = sets.where(F.col("role") == REGISTER).select(F.col("day").alias("date"), n, "bucket", "bits")
        returns = sets.where(F.col("role") == LOGIN).select("day", n, "bucket", "bits").select(F.date_sub("day", F.col("n")).alias("date"), "n", "bucket", "bits")
        both = cohorts.unionByName(returns).groupBy("date", "n", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("users"), F.count(F.lit(1)).alias("sides"))
        retained = both.where("sides = 2").groupBy("date").agg(*[_of_day(k) for k in range(1, days + 1)])
        # a row per date on both sides
        out = counts.join(retained, "date", "left").select("date", *[F.col(c).cast("long").alias(c) for c in ("newAddUserCnt", "activeUserCnt")],
                                                           *[F.coalesce(f"d{k}_retained", F.lit(0)).cast("long").alias(f"d{k}_retained") for k in range(1, days + 1)])
        if start is not None:
            out = out.where(F.col("date") >= F.lit(as_date(start)))
        if end is not None:
            out = out.where(F.col("date") <= F.lit(as_date(end)))
        return out


def _of_day(k: int) -> Column:
    return F.sum(F.when(F.col("n") == k, F.col("users"))).alias(f"d{k}_retained")
