"""Sanctions over time: every change of a player's state (EXT-2).

A player is warned at the first offence, closed at the offence that exceeds the
allowed number, and cleared after a week without one, which sets the count back.
The rule runs over each player's offences in order, as gaps and islands: an
island is a run of offences with no clean week between them, so counts restart
with it; the first island that is long enough closes the account, and nothing
after that counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WARN, CLOSE, CLEAR = "warn", "close", "clear"


def sanction_history(offences: DataFrame, user_col: str, at_col: str, as_of, max_warnings: int = 3, clean: str = "7 days") -> DataFrame:
    """(user, at, action, cnt): one row for each change of state up to ``as_of``.

    ``warn`` at an island's first offence; ``close`` at offence number ``max_warnings`` + 1 of an island, after which the
    player has no more changes; ``clear`` when ``clean`` has passed since an island's last offence and is over by
    ``as_of``. cnt is the number of warnings at that moment. Offences at the same time count one each; those without a
    user or a time, or after ``as_of``, play no part. An offence just when the clean week ends belongs to the island.
    """
    kind = offences.schema[at_col].dataType.simpleString()
    week, end = F.expr(f"INTERVAL {clean}"), F.lit(as_of).cast(kind)
    rows = offences.select(F.col(user_col), F.col(at_col).alias("at")).where(F.col(user_col).isNotNull() & (F.col("at") <= end))
    in_order = Window.partitionBy(user_col).orderBy("at")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.coalesce(F.lag("at").over(in_order) + week < F.col("at"), F.lit(True))
    rows = rows.withColumn("_first", first).withColumn("_next", F.lead("at").over(in_order))
    rows = rows.withColumn("_number", F.row_number().over(in_order)).withColumn("_begin", F.max(F.when(F.col("_first"), F.col("_number"))).over(upto))
    rows = rows.withColumn("cnt", F.col("_number") - F.col("_begin") + 1)
    closed = F.sum((F.col("cnt") > max_warnings).cast("int")).over(upto)  # 1 at the offence that closes, more after it
    rows = rows.withColumn("_closed", closed).where((F.col("_closed") == 0) | ((F.col("_closed") == 1) & (F.col("cnt") > max_warnings)))
    last = (F.col("_closed") == 0) & F.coalesce(F.col("_next") > F.col("at") + week, F.lit(True)) & (F.col("at") + week < end)
    change = F.array(F.when(F.col("_first"), F.struct("at", F.lit(WARN).alias("action"), F.col("cnt").cast("long").alias("cnt"))),
                     F.when(F.col("_closed") == 1, F.struct("at", F.lit(CLOSE).alias("action"), F.col("cnt").cast("long").alias("cnt"))),
                     F.when(last, F.struct((F.col("at") + week).alias("at"), F.lit(CLEAR).alias("action"), F.lit(0).cast("long").alias("cnt"))))
    return rows.select(user_col, F.explode(F.filter(change, lambda x: x.isNotNull())).alias("c")).select(user_col, "c.*")
