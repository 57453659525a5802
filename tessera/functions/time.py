"""Date and time column functions (TIM-1..6).

All are built-in expressions, so they stay inside whole-stage codegen and
predicates built from them push down to the parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import CN_TIME_PATTERN, ISO_TIME_PATTERN

DateLike = str | dt.date

# the part of a time text that is parsed; anything after the seconds is left
CN_TIME_HEAD = r"^\s*(\d{4}年\d{1,2}月\d{1,2}日 +\d{1,2}:\d{1,2}:\d{1,2})"
ISO_TIME_HEAD = r"^\s*(\d{4}-\d{1,2}-\d{1,2} +\d{1,2}:\d{1,2}:\d{1,2})"


def as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def parse_cn_time(col: Column | str) -> Column:
    """``2018年2月1日,星期一,10:02:01`` -> TIMESTAMP, NULL on garbage.

    The weekday between the commas carries no information and pattern letter
    ``E`` cannot be parsed on Spark 3+, so it is cut out before parsing. Fields
    may have one digit and text after the seconds is ignored.
    """
    text = F.regexp_replace(F.col(col) if isinstance(col, str) else col, ",[^,]*,", " ")
    return F.try_to_timestamp(F.regexp_extract(text, CN_TIME_HEAD, 1), F.lit(CN_TIME_PATTERN))


def parse_iso_time(col: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> TIMESTAMP, NULL on garbage; one-digit fields and trailing text as above."""
    text = F.regexp_extract(F.col(col) if isinstance(col, str) else col, ISO_TIME_HEAD, 1)
    return F.try_to_timestamp(text, F.lit(ISO_TIME_PATTERN))


def millis(col: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column (NTZ read in the session zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c.cast(T.TimestampType()))


def ts_literal(value: DateLike | dt.datetime, dtype: T.DataType) -> Column:
    """A literal of the same timestamp flavour as the column it is compared to.

    Comparing a TIMESTAMP_NTZ column with a TIMESTAMP literal would cast the
    column and lose parquet pushdown; a literal of the column's own type keeps
    ``PushedFilters``.
    """
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    else:
        text = f"{as_date(value).isoformat()} 00:00:00"
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(dtype, T.DateType):
        return F.expr(f"DATE '{text[:10]}'")
    return F.expr(f"TIMESTAMP '{text}'")


def day_bounds(base: DateLike, n: int = 0, dtype: T.DataType = T.TimestampType()) -> tuple[Column, Column]:
    """Half-open bounds ``[base + n days, base + n + 1 days)`` as literals (TIM-3..5)."""
    start = as_date(base) + dt.timedelta(days=n)
    return ts_literal(start, dtype), ts_literal(start + dt.timedelta(days=1), dtype)


def in_days(ts: Column, base: DateLike, first: int, last: int, dtype: T.DataType) -> Column:
    """``ts`` in ``[base + first, base + last + 1)`` days (PRJ-11), pushable."""
    lo, _ = day_bounds(base, first, dtype)
    _, hi = day_bounds(base, last, dtype)
    return (ts >= lo) & (ts < hi)


def day_offset(ts: Column, base: DateLike) -> Column:
    """Whole days between the base date and the day of ``ts`` (TIM-6)."""
    return F.datediff(F.to_date(ts), F.lit(as_date(base)))


def day_range(df, ts_col: str, base: DateLike, first: int, last: int, date_col: str | None = None) -> Column:
    """``in_days`` on ``ts_col``, plus the same range on a DATE partition column when the log has one.

    The timestamp bound reaches the parquet row groups (``PushedFilters``); the
    partition bound lets Spark skip whole ``event_date=...`` folders
    (``PartitionFilters``), so a daily report over years of logs lists and
    reads only its 8 days.
    """
    cond = in_days(F.col(ts_col), base, first, last, df.schema[ts_col].dataType)
    if date_col and date_col in df.columns and isinstance(df.schema[date_col].dataType, T.DateType):
        lo = as_date(base) + dt.timedelta(days=first)
        hi = as_date(base) + dt.timedelta(days=last)
        cond = cond & (F.col(date_col) >= F.lit(lo)) & (F.col(date_col) <= F.lit(hi))
    return cond
