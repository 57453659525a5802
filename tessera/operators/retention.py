"""The daily report: new users, active users, day-1..7 retention (AG-5/6, FN-6/7, PIP-1, EXT-1).

Plan of ``retention_counts`` (one scan, no join):

1. scan the log bounded to ``[base, base + days + 1)`` and to the register and
   login codes: both predicates reach the parquet scan;
2. ``groupBy(user)`` ORing one bit per question (new, active, came back on
   day n) into an INT. ``bit_or`` is pre-aggregated map side, so each user is
   one two-field row per task before the shuffle; a user holding a third of
   the rows costs one row per task, not a skewed reducer;
3. one global ``count_if`` per flag: partial counts per task, a single-row
   final exchange.

The reference ran nine queries, or a union of three with a seven-way
``count(distinct CASE ...)`` (Catalyst expands that into 7 copies of every row).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import percent_text, ratio
from tessera.functions.time import as_date, day_offset, day_range
from tessera.operators.roles import Roles
from tessera.operators.users import active_users, login_offsets, new_users
from tessera.schemas import RATE_COLUMNS, RETENTION_DAYS


NEW_BIT, ACTIVE_BIT = 1, 2  # bit n + 1 (n = 1..days): logged in on day n


def user_flags(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """One row per user seen in ``[base, base + days]``: ``(user, flags INT)``.

    ``flags`` ORs one bit per question: registered on the base day (bit 0),
    active on it (bit 1), logged in on day n (bit n + 1). ``bit_or`` is
    pre-aggregated map side, and the shuffled row is two fields instead of
    one boolean column per question.
    """
    ts, ev = F.col(roles.ts), F.col(roles.event)
    bounded = log.where(
        F.col(roles.user).isNotNull() & ev.isin(list(roles.active)) & day_range(log, roles.ts, base, 0, days, roles.date)
    )
    off = day_offset(ts, base)
    is_reg, is_login = ev.isin(list(roles.register)), ev.isin(list(roles.login))
    bits = F.when(off == 0, F.when(is_reg, F.lit(NEW_BIT | ACTIVE_BIT)).otherwise(F.lit(ACTIVE_BIT)))
    for n in range(1, days + 1):
        bits = bits.when(is_login & (off == n), F.lit(1 << (n + 1)))
    return bounded.groupBy(roles.user).agg(F.bit_or(bits.otherwise(F.lit(0))).alias("flags"))


def _has(bit: int):
    return F.col("flags").bitwiseAND(F.lit(bit)) != 0


def retention_counts(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """One row: ``newAddUserCnt``, ``activeUserCnt``, ``d1_retained``..``d{days}_retained``."""
    f = user_flags(log, roles, base, days)
    return f.agg(
        F.count_if(_has(NEW_BIT)).alias("newAddUserCnt"),
        F.count_if(_has(ACTIVE_BIT)).alias("activeUserCnt"),
        *[F.count_if(_has(NEW_BIT) & _has(1 << (n + 1))).alias(f"d{n}_retained") for n in range(1, days + 1)],
    )


def retention_rate(counts: DataFrame, days: int = RETENTION_DAYS, percent: bool = True) -> DataFrame:
    """Counts -> DOUBLE rates rounded to 4 places; NULL when nobody is new (FN-7, M10).

    ``percent=False`` gives the fraction ``a * 1.0 / b`` of the earlier SQL versions.
    """
    scale = 100.0 if percent else 1.0
    return counts.select(
        "newAddUserCnt",
        "activeUserCnt",
        *[F.round(ratio(f"d{n}_retained", "newAddUserCnt", scale), 4).alias(f"d{n}_rate")
          for n in range(1, days + 1)],
    )


def report_row(counts: DataFrame, base, days: int = RETENTION_DAYS) -> DataFrame:
    """Counts -> the result-table row: date, two counts, seven percent texts (FN-6, F5)."""
    if days != len(RATE_COLUMNS):
        raise ValueError(f"the result table has {len(RATE_COLUMNS)} rate columns")
    return counts.select(
        F.lit(as_date(base).isoformat()).alias("date"),
        F.col("newAddUserCnt").cast("long").alias("newAddUserCnt"),
        F.col("activeUserCnt").cast("long").alias("activeUserCnt"),
        *[percent_text(f"d{n}_retained", "newAddUserCnt").alias(name)
          for n, name in enumerate(RATE_COLUMNS, start=1)],
    )


def daily_report(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """PIP-1 without the sink: one lazy DataFrame, one row."""
    return report_row(retention_counts(log, roles, base, days), base, days)


def retention_counts_distinct(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """The reference's merged form of the day-n counts: a join of new users with login days,
    then ``count(DISTINCT CASE WHEN day = n THEN user END)`` per n (AG-5, PRJ-12, JN-3).

    Both sides are distinct before the join (at most ``days`` rows per user),
    so a pair is already unique and a plain conditional count is the distinct
    one; the login side is bounded to ``[base + 1, base + days]``.
    """
    new = new_users(log, roles, base)
    pairs = new.join(login_offsets(log, roles, base, days), roles.user, "inner")
    return pairs.agg(
        *[F.count_if(F.col("day_n") == n).alias(f"d{n}_retained") for n in range(1, days + 1)]
    )


def metrics_union(log: DataFrame, roles: Roles, base, days: int = RETENTION_DAYS) -> DataFrame:
    """The merged-SQL shape: padded metric rows, UNION ALL, max per column (SET-1, AG-6, FN-10).

    Two set counts and a join of new users with their login days, all of them over ``user_flags``: the questions are
    asked of the flags, after the shuffle by user, so the branches share one scan and one exchange of it (Spark reuses
    the exchange), and both sides of the join are dealt by user already.
    """
    flags = user_flags(log, roles, base, days)
    new_cnt = flags.where(_has(NEW_BIT)).agg(F.count(F.lit(1)).alias("newAddUserCnt"))
    act_cnt = flags.where(_has(ACTIVE_BIT)).agg(F.count(F.lit(1)).alias("activeUserCnt"))
    came_back = F.filter(F.array(*[F.when(_has(1 << (n + 1)), F.lit(n)) for n in range(1, days + 1)]), lambda x: x.isNotNull())
    pairs = flags.where(_has(NEW_BIT)).select(roles.user).join(flags.select(roles.user, F.explode(came_back).alias("day_n")), roles.user)
    wide = pairs.agg(*[F.count_if(F.col("day_n") == n).alias(f"d{n}_retained") for n in range(1, days + 1)])
    cols = ["newAddUserCnt", "activeUserCnt"] + [f"d{n}_retained" for n in range(1, days + 1)]
    padded = [
        df.select(*[F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in cols])
        for df in (new_cnt, act_cnt, wide)
    ]
    union = padded[0].unionByName(padded[1]).unionByName(padded[2])
    return union.agg(*[F.max(c).cast("long").alias(c) for c in cols])


def retention_matrix(log: DataFrame, roles: Roles, days: int = RETENTION_DAYS,
                     start=None, end=None) -> DataFrame:
    """Every base date at once (EXT-1): one row per cohort day.

    1. ``groupBy(user, day)``: a user's activity of one day collapses to two
       flags (registered, logged in), pre-aggregated map side. Keyed by user
       *and* day, so a user with a third of all rows is spread over days.
    2. After step 1 a user has at most one row per calendar day, so a window
       partitioned by user is never skewed: a ``[+1, +days]`` day range frame
       collects the login days that follow each day (at most ``days`` values).
       This shuffles each user-day once, where re-keying every login day to
       its ``days`` cohorts would shuffle it up to ``days + 1`` times.
    3. ``groupBy(cohort)`` counts, pre-aggregated map side; the last exchange
       is tiny.

    ``start``/``end`` bound the scan to ``[start, end + days]`` and the output
    to cohorts in ``[start, end]``.
    """
    ts, ev = F.col(roles.ts), F.col(roles.event)
    cond = F.col(roles.user).isNotNull() & ev.isin(list(roles.active))
    if start is not None or end is not None:
        lo, hi = as_date(start) if start is not None else dt.date(1, 1, 1), as_date(end) if end is not None else dt.date(9990, 1, 1)
        cond = cond & day_range(log, roles.ts, lo, 0, (hi - lo).days + days, roles.date)
    user_day = (
        log.where(cond)
        .groupBy(F.col(roles.user).alias("u"), F.to_date(ts).alias("day"))
        .agg(F.bool_or(ev.isin(list(roles.register))).alias("reg"),
             F.bool_or(ev.isin(list(roles.login))).alias("login"))
    )
    day_no = F.datediff(F.col("day"), F.lit("1970-01-01"))
    following = Window.partitionBy("u").orderBy(day_no).rangeBetween(1, days)
    returns = user_day.select(
        "day", "reg", day_no.alias("day_no"),
        F.collect_set(F.when(F.col("login"), day_no)).over(following).alias("returns"),
    )
    out = returns.groupBy(F.col("day").alias("date")).agg(
        F.count_if(F.col("reg")).alias("newAddUserCnt"),
        F.count(F.lit(1)).alias("activeUserCnt"),
        *[F.count_if(F.col("reg") & F.array_contains("returns", F.col("day_no") + n)).alias(f"d{n}_retained")
          for n in range(1, days + 1)],
    )
    if start is not None:
        out = out.where(F.col("date") >= F.lit(as_date(start)))
    if end is not None:
        out = out.where(F.col("date") <= F.lit(as_date(end)))
    return out


def matrix_report_rows(matrix: DataFrame, days: int = RETENTION_DAYS) -> DataFrame:
    """Retention-matrix rows -> result-table rows: date text, two counts, percent texts (F5)."""
    if days != len(RATE_COLUMNS):
        raise ValueError(f"the result table has {len(RATE_COLUMNS)} rate columns")
    return matrix.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("newAddUserCnt").cast("long").alias("newAddUserCnt"),
        F.col("activeUserCnt").cast("long").alias("activeUserCnt"),
        *[percent_text(f"d{n}_retained", "newAddUserCnt").alias(c) for n, c in enumerate(RATE_COLUMNS, 1)],
    )


def daily_reports(log: DataFrame, roles: Roles, dates, days: int = RETENTION_DAYS) -> DataFrame:
    """Result-table rows for several base dates in one pass (replaces caching the log, CCH-1).

    The scan is bounded to ``[min(dates), max(dates) + days]``; a date without
    any activity still gets its row (counts 0, rates NULL), like ``daily_report``.
    """
    ds = sorted({as_date(d) for d in dates})
    m = retention_matrix(log, roles, days, start=ds[0], end=ds[-1])
    rows = matrix_report_rows(m, days)
    wanted = log.sparkSession.createDataFrame([(d.isoformat(),) for d in ds], "date STRING")
    # ``rows`` has at most one row per requested date: a bound the caller fixed, so broadcasting it is safe
    joined = wanted.join(F.broadcast(rows), "date", "left")
    return joined.select(
        "date",
        F.coalesce("newAddUserCnt", F.lit(0)).cast("long").alias("newAddUserCnt"),
        F.coalesce("activeUserCnt", F.lit(0)).cast("long").alias("activeUserCnt"),
        *RATE_COLUMNS,
    )
