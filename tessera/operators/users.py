"""User sets of one base date and the retained-user forms (AG-1..4, AG-7, JN-1..4, SET-2).

``retained_semi``, ``retained_selfjoin`` and ``retained_intersect`` compute the
same numbers as the single-pass ``retention_counts`` in three relational
shapes; they exist as equivalence checks and for callers who want user lists.
Each side is de-duplicated *before* it meets the other, so a join emits at most
``days`` rows per user no matter how many events a hot user has: no
all-pairs product inside a user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import as_date, day_offset, day_range
from tessera.operators.roles import Roles
from tessera.schemas import RETENTION_DAYS


def _bounded(log: DataFrame, roles: Roles, base, first: int, last: int, codes) -> DataFrame:
    return log.where(
        F.col(roles.user).isNotNull()
        & F.col(roles.event).isin(list(codes))
        & day_range(log, roles.ts, base, first, last, roles.date)
    )


def day_users(log: DataFrame, roles: Roles, day, codes) -> DataFrame:
    """Distinct users with one of ``codes`` on ``day``."""
    return _bounded(log, roles, day, 0, 0, codes).select(roles.user).distinct()


def new_users(log: DataFrame, roles: Roles, base) -> DataFrame:
    """Users who registered on the base date (M1)."""
    return day_users(log, roles, base, roles.register)


def active_users(log: DataFrame, roles: Roles, base) -> DataFrame:
    """Users who registered or logged in on the base date (M2)."""
    return day_users(log, roles, base, roles.active)


def distinct_users(log: DataFrame, roles: Roles) -> DataFrame:
    return log.where(F.col(roles.user).isNotNull()).select(roles.user).distinct()


def login_offsets(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """Distinct ``(user, day_n)`` logins on days 1..``days`` after the base date."""
    b = _bounded(log, roles, base, 1, days, roles.login)
    return b.select(roles.user, day_offset(F.col(roles.ts), base).cast("int").alias("day_n")).distinct()


def retained(log: DataFrame, roles: Roles, base, n: int) -> DataFrame:
    """New users of the base date who logged in on day ``n`` (JN-1 as a semi-join)."""
    logins = day_users(log, roles, _plus(base, n), roles.login)
    return new_users(log, roles, base).join(logins, roles.user, "left_semi")


def _plus(base, n: int) -> dt.date:
    return as_date(base) + dt.timedelta(days=n)


def retained_count(log: DataFrame, roles: Roles, base, n: int) -> DataFrame:
    """One row: ``retained_users`` on day ``n`` (AG-3 for n = 1)."""
    return retained(log, roles, base, n).agg(F.count(F.lit(1)).alias("retained_users"))


def _per_day(df: DataFrame, days: int) -> DataFrame:
    return _fill(df.groupBy("day_n").agg(F.count(F.lit(1)).alias("retained_users")), days)


def _fill(counts: DataFrame, days: int) -> DataFrame:
    """Every day 1..days appears, 0 when nobody came back.

    ``counts`` has at most ``days`` rows, a proven bound, so it is broadcast.
    """
    all_days = counts.sparkSession.range(1, days + 1).select(F.col("id").cast("int").alias("day_n"))
    return all_days.join(F.broadcast(counts), "day_n", "left").select(
        "day_n", F.coalesce(F.col("retained_users"), F.lit(0)).cast("long").alias("retained_users")
    )


def retained_semi(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """``(day_n, retained_users)`` via one left-semi join of day-n logins against new users (JN-1)."""
    hits = login_offsets(log, roles, base, days).join(new_users(log, roles, base), roles.user, "left_semi")
    return _per_day(hits, days)


def retained_selfjoin(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """Same numbers as an inner self-join on user, counted per day (JN-2/3)."""
    new = new_users(log, roles, base).alias("t1")
    logins = login_offsets(log, roles, base, days).alias("t2")
    pairs = new.join(logins, F.col(f"t1.{roles.user}") == F.col(f"t2.{roles.user}"), "inner")
    counts = pairs.groupBy(F.col("t2.day_n").alias("day_n")).agg(
        F.count(F.lit(1)).alias("retained_users")  # both sides are distinct: a pair occurs once
    )
    return _fill(counts, days)


def retained_intersect(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """Same numbers via ``INTERSECT`` of (new user x day) with (login user, day) (SET-2)."""
    # INTERSECT removes repeats itself, so neither side is made distinct before it
    offsets = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day_n")
    new_by_day = _bounded(log, roles, base, 0, 0, roles.register).select(roles.user, offsets)
    logins = _bounded(log, roles, base, 1, days, roles.login).select(roles.user, day_offset(F.col(roles.ts), base).cast("int").alias("day_n"))
    return _per_day(new_by_day.intersect(logins), days)
