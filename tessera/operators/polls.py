"""The blacklist as a poll every two seconds leaves it, by the closed count of ticks (STR-12, PIP-3).

The reference's timer reads the flagged map every two seconds and adds one to each
player in it: a player's counter is the number of ticks since the flag. That
number has a closed form, so any run time is one pass over the flagged windows,
and a table is moved on by the ticks since it was last written, not tick by tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.lateness import micros

PERIOD_US = 2_000_000


def tick_at(at: Column, start_us: int, period_us: int) -> Column:
    """Number of the first tick at or after a time in microseconds; ticks are numbered from 0 at ``start_us``."""
    since = at - F.lit(start_us)
    whole = since - F.pmod(since, F.lit(period_us))
    return F.greatest((whole / F.lit(period_us)).cast("long") + (since > whole).cast("long"), F.lit(0).cast("long"))


def polled(flagged: DataFrame, user_col: str, start_us: int, until_us: int, after_us: int | None = None, period_us: int = PERIOD_US) -> DataFrame:
    """(user, avgTime, cnt): what the ticks in (``after_us``, ``until_us``] add; from the first tick on without ``after_us``.

    ``flagged`` has user, avgTime and window_end, a window being in the map from its end on. A player counts once a tick
    from the first window on; avgTime is that of the latest window the last tick has seen. Nothing is read from the
    table itself, so the same span always adds the same.
    """
    last = (until_us - start_us) // period_us
    done = -1 if after_us is None else (after_us - start_us) // period_us
    at = micros("window_end", flagged.schema["window_end"].dataType)
    seen = flagged.where(F.col(user_col).isNotNull()).withColumn("_tick", tick_at(at, start_us, period_us)).where(F.col("_tick") <= last)
    per = seen.groupBy(user_col).agg(F.min("_tick").alias("_from"), F.max_by("avgTime", "window_end").alias("avgTime"))
    return per.select(user_col, "avgTime", (F.lit(last) - F.greatest(F.col("_from"), F.lit(done + 1)) + 1).cast("long").alias("cnt")).where("cnt > 0")


def advanced(table: DataFrame, ticks: DataFrame, user_col: str) -> DataFrame:
    """``table`` (user, avgTime, cnt) moved on by what ``polled`` gives for a span: counts add, the newer avgTime stays."""
    both = table.select(user_col, "avgTime", "cnt", F.lit(0).alias("_new")).unionByName(ticks.select(user_col, "avgTime", "cnt", F.lit(1).alias("_new")))
    return both.groupBy(user_col).agg(F.max_by("avgTime", "_new").alias("avgTime"), F.sum("cnt").alias("cnt"))
