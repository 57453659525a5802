"""The retention table kept up to date as days arrive (JN-4, AG-5).

Delta rules instead of a new pass. With R(d) and L(d) the users who registered
and logged in on day d, ``retained(d, n) = |R(d) n L(d + n)|``. What a load adds,
dR and dL, changes it by

    |dR(d) n (L + dL)(d + n)|  +  |R(d) n dL(d + n)|

so a load of day D touches its own cohort and the ``days`` cohorts before, and
reads the stored user-days from D - days to D + days, whatever the history.
Days may come in any order, in parts, and late: rows that are already counted
add nothing, since a load keeps only user-days that are new.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.roles import Roles
from tessera.schemas import RETENTION_DAYS
from tessera.session import scratch_path
from tessera.streaming.sinks import committed_ids

_USER_DAYS = "user STRING, reg BOOLEAN, login BOOLEAN, day DATE"
_COUNTS = "date DATE, n INT, users BIGINT"
NEW, ACTIVE = 0, -1  # n of the counts that aren't a return


class RetentionTable:
    """``user-days/load=<k>/day=<d>``: the user-days a load added; ``counts/load=<k>``: what it changed, (date, n, users).

    ``arrive`` takes loads in the order of their numbers; taking one again replaces both folders with the same
    contents, so a replay counts nothing twice. The counts of a load are at most ``days`` + 2 rows for each of its days.
    """

    def __init__(self, spark: SparkSession, root: str, roles: Roles, days: int = RETENTION_DAYS):
        self.spark, self.root, self.roles, self.days = spark, root.rstrip("/"), roles, days

    def stored(self, before: int, dates: list[dt.date]) -> DataFrame:
        """User-days of ``dates`` from loads below ``before``; folders of other days are pruned."""
        out = self.spark.createDataFrame([], _USER_DAYS)
        for k in committed_ids(self.spark, f"{self.root}/user-days", "load"):
            if k < before:
                out = out.unionByName(self.spark.read.schema(_USER_DAYS).parquet(f"{self.root}/user-days/load={k}").where(F.col("day").isin(dates)))
        return out.groupBy("user", "day").agg(F.bool_or("reg").alias("reg"), F.bool_or("login").alias("login"))

    def arrive(self, log: DataFrame, load: int) -> None:
        """Take a load: rows of any days, once or again. Rows without a user or a time are left out."""
        r = self.roles
        ev = F.col(r.event)
        came = (log.where(F.col(r.user).isNotNull() & F.col(r.ts).isNotNull() & ev.isin(list(r.active)))
                .groupBy(F.col(r.user).cast("string").alias("user"), F.to_date(r.ts).alias("day"))
                .agg(F.bool_or(ev.isin(list(r.register))).alias("reg"), F.bool_or(ev.isin(list(r.login))).alias("login")))
        staged = scratch_path(self.spark, "arrived")
        came.write.mode("overwrite").parquet(staged)  # a row per user and day of the load
        came = self.spark.read.schema(came.schema).parquet(staged)
        dates = [x.day for x in came.select("day").distinct().collect()]  # the load's days: a handful
        near = sorted({d + dt.timedelta(days=k) for d in dates for k in range(-self.days, self.days + 1)})
        old = self.stored(load, near)
        had = old.select("user", "day", F.col("reg").alias("had_reg"), F.col("login").alias("had_login"))
        # what the load adds: a flag that the stored user-day lacks
        fresh = (came.join(had, ["user", "day"], "left")
                 .select("user", "day", (F.col("reg") & ~F.coalesce("had_reg", F.lit(False))).alias("reg"), (F.col("login") & ~F.coalesce("had_login", F.lit(False))).alias("login"),
                         F.col("had_reg").isNull().alias("first")).where("reg or login"))
        path = f"{self.root}/user-days/load={load}"
        staged = scratch_path(self.spark, "added")
        fresh.write.mode("overwrite").parquet(staged)
        fresh = self.spark.read.schema(fresh.schema).parquet(staged)
        fresh.select("user", "reg", "login", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        self._deltas(fresh, old).write.mode("overwrite").parquet(f"{self.root}/counts/load={load}")

    def _deltas(self, fresh: DataFrame, old: DataFrame) -> DataFrame:
        """(date, n, users): the rules above, each as a join on (user, day) of what is new with what is there."""
        n = F.explode(F.sequence(F.lit(1), F.lit(self.days))).alias("n")
        both = old.where("login").select("user", F.col("day").alias("back")).unionByName(fresh.where("login").select("user", F.col("day").alias("back")))
        cohorts = fresh.where("reg").select("user", F.col("day").alias("date"), n).withColumn("back", F.date_add("date", F.col("n")))
        returns = fresh.where("login").select("user", "day", n).select("user", F.date_sub("day", F.col("n")).alias("date"), "n")
        old_cohorts = old.where("reg").select("user", F.col("day").alias("date"))
        own = fresh.select(F.col("day").alias("date"), F.explode(F.filter(F.array(F.when(F.col("reg"), F.lit(NEW)), F.when(F.col("first"), F.lit(ACTIVE))), lambda x: x.isNotNull())).alias("n"))
        parts = (own.unionByName(cohorts.join(both, ["user", "back"], "left_semi").select("date", "n"))
                 .unionByName(returns.join(old_cohorts, ["user", "date"], "left_semi").select("date", "n")))
        return parts.groupBy("date", F.col("n").cast("int").alias("n")).agg(F.count(F.lit(1)).alias("users"))

    def read(self) -> DataFrame:
        """The table: new, active and day-1..``days`` retained users of every date that has a user."""
        paths = [f"{self.root}/counts/load={k}" for k in committed_ids(self.spark, f"{self.root}/counts", "load")]
        counts = self.spark.read.schema(_COUNTS).parquet(*paths) if paths else self.spark.createDataFrame([], _COUNTS)
        names = {NEW: "newAddUserCnt", ACTIVE: "activeUserCnt", **{k: f"d{k}_retained" for k in range(1, self.days + 1)}}
        out = counts.groupBy("date").agg(*[F.coalesce(F.sum(F.when(F.col("n") == k, F.col("users"))), F.lit(0)).cast("long").alias(c) for k, c in names.items()])
        return out.where("activeUserCnt > 0")
