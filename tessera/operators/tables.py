"""Keyed result tables as set-based merges (SNK-1..4, STR-12, PIP-3, EXT-2).

Plain parquet has no MERGE, so every upsert is a pure function
``(existing, incoming) -> new version``; ``tessera.streaming.sinks`` writes the
version. Each merge is a union of the table and the incoming rows followed by
one ``groupBy(key)``: a single shuffle, pre-aggregated map side, no join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import as_date


def upsert_daily(existing: DataFrame, new: DataFrame, key: str = "date") -> DataFrame:
    """Replace the rows of ``existing`` whose key occurs in ``new``; insert the rest (SNK-1).

    One union and one ``groupBy(key)`` keeping the newer row: each input is
    computed once (an anti-join would evaluate ``new`` twice), and the map
    side pre-aggregates, so even a table with few distinct keys shuffles one
    row per key per task.
    """
    cols = existing.columns
    rest = [c for c in cols if c != key]
    both = existing.select(*cols, F.lit(0).alias("_newer")).unionByName(new.select(*cols, F.lit(1).alias("_newer")))
    latest = both.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("_newer")).alias("_row"))
    return latest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*cols)


def blacklist_merge(existing: DataFrame, batch: DataFrame, user_col: str = "userName",
                    order_col: str = "window_end", initial_cnt: int = 1) -> DataFrame:
    """Apply a batch of flagged rows to the blacklist ``(user, avgTime, cnt)`` (SNK-2/3, M17).

    Row by row the reference inserts ``(user, avgTime, initial_cnt)`` for a new
    key and otherwise sets ``avgTime`` and adds 1. For ``k`` batch rows of one
    key that is ``cnt + k`` (existing) or ``initial_cnt + k - 1`` (new), with
    the avgTime of the latest row by ``order_col``.

    One union and one ``groupBy(user)``, pre-aggregated map side: a single
    shuffle and no join. ``max_by`` over ``(is_batch, order)`` lets the latest
    batch row win and keeps the old value when the batch has none.
    """
    order_type = batch.schema[order_col].dataType
    old = existing.select(
        F.col(user_col).alias("_u"), F.col("avgTime").cast("double").alias("_avg"),
        F.col("cnt").cast("long").alias("_cnt"), F.lit(0).cast("long").alias("_k"),
        F.struct(F.lit(0).alias("b"), F.lit(None).cast(order_type).alias("o")).alias("_rank"))
    new = batch.select(
        F.col(user_col).alias("_u"), F.col("avgTime").cast("double").alias("_avg"),
        F.lit(None).cast("long").alias("_cnt"), F.lit(1).cast("long").alias("_k"),
        F.struct(F.lit(1).alias("b"), F.col(order_col).alias("o")).alias("_rank"))
    per_user = old.unionByName(new).groupBy("_u").agg(
        F.sum("_cnt").alias("_cnt"),  # NULL: not in the table yet
        F.sum("_k").alias("_k"),
        F.max_by("_avg", "_rank").alias("_avg"),
    )
    cnt = F.when(F.col("_cnt").isNull(), F.lit(initial_cnt) + F.col("_k") - 1).otherwise(F.col("_cnt") + F.col("_k"))
    return per_user.select(
        F.col("_u").alias(user_col), F.col("_avg").alias("avgTime"), cnt.cast("int").alias("cnt"))


def flagged_latest(windows: DataFrame, user_col: str = "userName", existing: DataFrame | None = None) -> DataFrame:
    """Keyed map user -> avgTime of the latest flagged window (SNK-4, M16).

    ``existing`` is the current map with the same columns; a key keeps the
    value whose ``window_end`` is latest, so replaying a batch changes nothing.
    """
    rows = windows.select(user_col, "avgTime", "window_end")
    if existing is not None:
        rows = existing.select(user_col, "avgTime", "window_end").unionByName(rows)
    return rows.groupBy(user_col).agg(
        F.max_by(F.col("avgTime"), F.col("window_end")).alias("avgTime"),
        F.max("window_end").alias("window_end"),
    )


def sanctions(blacklist: DataFrame, last_seen: DataFrame, as_of, user_col: str = "userName",
              max_warnings: int = 3, clean_days: int = 7) -> DataFrame:
    """Policy from the blacklist comment (EXT-2): ``close`` above ``max_warnings``;
    ``clear`` after ``clean_days`` clean days; else ``warn``.

    ``last_seen`` is ``(user, last_seen)`` with the end of the user's latest flagged window.
    """
    cutoff = dt.datetime.combine(as_date(as_of) - dt.timedelta(days=clean_days), dt.time())
    seen_type = last_seen.schema["last_seen"].dataType
    # blacklist rows and last-seen rows side by side, one keyed aggregate: one shuffle, no join
    both = blacklist.select(
        F.col(user_col), F.col("avgTime").cast("double").alias("avgTime"), F.col("cnt").cast("int").alias("cnt"),
        F.lit(None).cast(seen_type).alias("last_seen"), F.lit(True).alias("_listed"),
    ).unionByName(last_seen.select(
        F.col(user_col), F.lit(None).cast("double").alias("avgTime"), F.lit(None).cast("int").alias("cnt"),
        F.col("last_seen"), F.lit(False).alias("_listed"),
    ))
    j = both.groupBy(user_col).agg(
        F.max("avgTime").alias("avgTime"), F.max("cnt").alias("cnt"), F.max("last_seen").alias("last_seen"),
        F.bool_or("_listed").alias("_listed"),
    ).where(F.col("_listed"))
    action = (
        F.when(F.col("cnt") > max_warnings, F.lit("close"))
        .when(F.col("last_seen") < F.lit(cutoff).cast(seen_type), F.lit("clear"))
        .otherwise(F.lit("warn"))
    )
    return j.select(user_col, "avgTime", "cnt", "last_seen", action.alias("action"))
