"""Sliding windows from panes, without copying events into every window (STR-3, STR-4, STR-5).

A sliding window of W over slides of S copies each event W / S times before it is
aggregated. Here an event falls into one pane, the common divisor of W and S, and
panes are aggregated by (user, pane). A pane belongs to the windows whose last
pane lies in an interval; between the interval ends of a user's panes, the change
points, all windows hold the same panes. So a running merge over change points
gives each state once:

    count  sum of what has entered less what has left
    max    largest time that has entered (the latest pane is the last to leave)
    min    time of the next pane to leave

Only states that satisfy the rule are turned into windows, so the output's own
size is all that W / S can multiply.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.bursts import avg_gap, burst_stats
from tessera.operators.lateness import from_micros, micros

#: Windows' lengths in a stretch: a user's change points are merged stretch by stretch, so that a user with a long
#: history is not one group. A pane at a stretch's end goes to both.
STRETCH = 256
_UNITS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def duration_us(text: str) -> int:
    """``10 seconds``, ``12 hours``, ``1 day`` in microseconds."""
    number, unit = text.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def pane_stats(events: DataFrame, user_col: str, ts_col: str, pane_us: int) -> DataFrame:
    """(user, pane, cnt, maxTime, minTime): one row for each user's pane that has events."""
    us = micros(ts_col, events.schema[ts_col].dataType)
    pane = ((us - F.pmod(us, F.lit(pane_us))) / F.lit(pane_us)).cast("long")
    return events.where(F.col(ts_col).isNotNull()).groupBy(F.col(user_col), pane.alias("pane")).agg(*burst_stats(ts_col))


def merged_states(panes: DataFrame, user_col: str, width: int) -> DataFrame:
    """(user, first, until, cnt, maxTime, minTime): what windows whose last pane is in [first, until) hold; ``width`` panes a window."""
    size = STRETCH * width
    start, end = F.col("pane"), F.col("pane") + width
    stretch = F.floor(start / F.lit(size)).cast("long")
    edge = (stretch + 1) * size
    parts = F.when(end <= edge, F.array(F.struct(stretch.alias("stretch"), start.alias("from"), end.alias("to")))).otherwise(
        F.array(F.struct(stretch.alias("stretch"), start.alias("from"), edge.alias("to")), F.struct((stretch + 1).alias("stretch"), edge.alias("from"), end.alias("to"))))
    held = panes.select(user_col, "cnt", "maxTime", "minTime", F.explode(parts).alias("p"))
    changes = held.select(user_col, F.col("p.stretch").alias("stretch"), F.explode(F.array(
        F.struct(F.col("p.from").alias("at"), F.col("cnt").alias("change"), F.col("maxTime").alias("entered"), F.lit(None).cast("long").alias("left")),
        F.struct(F.col("p.to").alias("at"), (-F.col("cnt")).alias("change"), F.lit(None).cast("long").alias("entered"), F.col("minTime").alias("left")))).alias("c")).select(user_col, "stretch", "c.*")
    points = changes.groupBy(user_col, "stretch", "at").agg(F.sum("change").alias("change"), F.max("entered").alias("entered"), F.min("left").alias("left"))
    forward = Window.partitionBy(user_col, "stretch").orderBy("at")
    running = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = Window.partitionBy(user_col, "stretch").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    states = points.select(user_col, F.col("at").alias("first"), F.lead("at").over(forward).alias("until"), F.sum("change").over(running).alias("cnt"),
                           F.max("entered").over(running).alias("maxTime"), F.last("left", ignorenulls=True).over(following).alias("minTime"))
    return states.where("cnt > 0")


def detect_bursts_by_panes(events: DataFrame, user_col: str, ts_col: str, window: str, slide: str, min_count: int, max_avg_ms: float) -> DataFrame:
    """Flagged windows as ``detect_bursts`` gives them; windows start at multiples of ``slide`` since 1970."""
    kind = events.schema[ts_col].dataType
    w, s = duration_us(window), duration_us(slide)
    pane = math.gcd(w, s)
    width, step = w // pane, s // pane
    states = merged_states(pane_stats(events, user_col, ts_col, pane), user_col, width).withColumn("avgTime", avg_gap())
    flagged = states.where((F.col("cnt") >= min_count) & (F.col("avgTime") < max_avg_ms))
    # a window with last pane e begins with pane e - width + 1, a multiple of step
    low = F.ceil((F.col("first") - (width - 1)) / F.lit(step)).cast("long")
    high = F.floor((F.col("until") - width) / F.lit(step)).cast("long")
    each = flagged.withColumn("low", low).withColumn("high", high).where("low <= high").withColumn("q", F.explode(F.sequence("low", "high")))
    return each.select(from_micros(F.col("q") * s, kind).alias("window_start"), from_micros(F.col("q") * s + w, kind).alias("window_end"), user_col, "cnt", "avgTime")
