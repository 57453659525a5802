"""Item-burst detection (AG-8, SRT-1, STR-3/5, UDAF-1, PIP-2).

One function serves batch and streaming DataFrames: ``groupBy(window, user)``
with count / max / min. Those three are associative, so Spark keeps O(1) state
per (window, user) and pre-aggregates map side; nothing ever holds a player's
list of event times (the reference grouped the raw values and sorted them).
A sliding window copies each row into ``window / slide`` windows (2 for the
reference's 10 s / 5 s) before the partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import millis
from tessera.schemas import BURST_MAX_AVG_MS, BURST_MIN_COUNT, BURST_SLIDE, BURST_WINDOW


def burst_stats(ts_col: str) -> list[Column]:
    """Aggregate expressions: ``cnt``, ``maxTime``, ``minTime`` (epoch ms) (UDAF-1).

    Merging two partial results adds counts and takes max / min, which is what
    Spark's partial aggregation does; ``avg_gap`` derives the mean gap.
    """
    ms = millis(ts_col)
    return [F.count(ms).alias("cnt"), F.max(ms).alias("maxTime"), F.min(ms).alias("minTime")]


def merge_stats(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Combine two burst-stat tables keyed by ``keys`` (the UDAF's merge step, FN-9).

    Counts add, ``maxTime`` / ``minTime`` take ``greatest`` / ``least``; a key
    present on one side only keeps its stats. Lets a stored rollup absorb a
    new slice without rescanning the old events.
    """
    l = left.select(*keys, *[F.col(c).alias(f"l_{c}") for c in ("cnt", "maxTime", "minTime")])
    r = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in ("cnt", "maxTime", "minTime")])
    j = l.join(r, keys, "full_outer")
    return j.select(
        *keys,
        (F.coalesce(F.col("l_cnt"), F.lit(0)) + F.coalesce(F.col("r_cnt"), F.lit(0))).alias("cnt"),
        F.greatest("l_maxTime", "r_maxTime").alias("maxTime"),
        F.least("l_minTime", "r_minTime").alias("minTime"),
    )


def avg_gap(cnt: str = "cnt", max_t: str = "maxTime", min_t: str = "minTime") -> Column:
    """(last - first) / count in ms, rounded to DECIMAL(18,4) HALF_UP, exposed as DOUBLE (M12/M13).

    Divides by the count, not count - 1, as the reference does.
    """
    span = (F.col(max_t) - F.col(min_t)).cast("decimal(20,0)")
    return F.try_divide(span, F.col(cnt).cast("decimal(20,0)")).cast("decimal(18,4)").cast("double")


def burst_windows(events: DataFrame, user_col: str, window_col: str, window: str = BURST_WINDOW,
                  slide: str = BURST_SLIDE, gap_col: str | None = None) -> DataFrame:
    """Per (sliding window, user): ``cnt``, ``maxTime``, ``minTime``.

    Rows fall into windows by ``window_col``; the times that the gap is
    measured between come from ``gap_col`` (default: the same column). A stream
    windowed on arrival measures the gap on the game's own time.
    """
    return events.groupBy(F.window(window_col, window, slide).alias("window"), F.col(user_col)).agg(
        *burst_stats(gap_col or window_col)
    )


def apply_rule(windows: DataFrame, user_col: str, min_count: int = BURST_MIN_COUNT,
               max_avg_ms: float = BURST_MAX_AVG_MS) -> DataFrame:
    """Keep windows with ``cnt >= min_count`` and mean gap ``< max_avg_ms`` (STR-5, PRJ-13)."""
    out = windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(user_col),
        F.col("cnt"),
        avg_gap().alias("avgTime"),
    )
    return out.where((F.col("cnt") >= min_count) & (F.col("avgTime") < max_avg_ms))


def detect_bursts(events: DataFrame, user_col: str, ts_col: str, window: str = BURST_WINDOW,
                  slide: str = BURST_SLIDE, min_count: int = BURST_MIN_COUNT,
                  max_avg_ms: float = BURST_MAX_AVG_MS, gap_col: str | None = None) -> DataFrame:
    """Flagged (window, user) rows: ``window_start, window_end, user, cnt, avgTime`` (PIP-2)."""
    return apply_rule(burst_windows(events, user_col, ts_col, window, slide, gap_col), user_col, min_count, max_avg_ms)


def flagged_players(bursts: DataFrame, user_col: str) -> DataFrame:
    """The reference's projected form: ``(user, avgTime)`` per flagged window, window dropped (M15)."""
    return bursts.select(user_col, "avgTime")
