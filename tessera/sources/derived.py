"""Game-log shaped data derived from the ``events`` table.

The reference reads a search index of offline logs and a message stream of
tab-separated lines; neither ships with data. These functions re-express every
``events`` row in those two formats (plus a few deliberately broken rows, chosen
from the row's own content), so that the parsers, cleaners and reports run over
the whole table and their work grows with it. All of it is plain column
expressions: one narrow map stage, no shuffle.

Role mapping: ``signup`` -> code 1 (register), ``view`` -> 2 (login),
``error`` -> 3, ``purchase`` -> 12, ``click`` -> 11 (item use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import CN_WEEKDAYS, HEALING_ITEM

EVENT_CODE = {"signup": "1", "view": "2", "error": "3", "purchase": "12", "click": "11"}


def props_k(events: DataFrame) -> Column:
    return F.regexp_extract(F.col("props"), r"(\d+)", 1).cast("int")


def event_code(col: Column) -> Column:
    expr = None
    for name, code in EVENT_CODE.items():
        expr = F.when(col == name, F.lit(code)) if expr is None else expr.when(col == name, F.lit(code))
    return expr


def cn_time_text(ts: Column, short: Column) -> Column:
    """``2024年1月10日,星期三,08:05:09``; ``8:5:9.5`` where ``short`` (one-digit fields, a fraction)."""
    weekday = F.element_at(F.array(*[F.lit(w) for w in CN_WEEKDAYS]), F.dayofweek(ts))
    clock = F.when(short, F.concat(F.date_format(ts, "H:m:s"), F.lit(".5"))).otherwise(F.date_format(ts, "HH:mm:ss"))
    return F.concat_ws(",", F.date_format(ts, "yyyy年M月d日"), weekday, clock)


def gamelog_from_events(events: DataFrame) -> DataFrame:
    """``(event_id, userName, eventType, time, ip)``; NULL means "field missing".

    Broken on purpose: userName missing when value < 1; time garbage when
    value > 480; ip missing when k >= 90, three octets when 85 <= k < 90. A
    quarter of the times (k % 4 = 1) has one-digit clock fields and a fraction.
    """
    k = props_k(events)
    v = F.col("value")
    uid = F.col("user_id")
    good_ip = F.concat_ws(".", (k + 100).cast("string"), (uid % 256).cast("string"),
                          (F.col("event_id") % 250).cast("string"), F.lit("1"))
    short_ip = F.concat_ws(".", (k + 100).cast("string"), (uid % 256).cast("string"), F.lit("1"))
    return events.select(
        F.col("event_id"),
        F.when(v >= 1.0, uid.cast("string")).alias("userName"),
        event_code(F.col("event_type")).alias("eventType"),
        F.when(v > 480.0, F.lit("not a time")).otherwise(cn_time_text(F.col("ts"), k % 4 == 1)).alias("time"),
        F.when(k >= 90, F.lit(None).cast("string")).when(k >= 85, short_ip).otherwise(good_ip).alias("ip"),
    )


def lines_from_events(events: DataFrame) -> DataFrame:
    """``(event_id, ts, day, timestamp, value)`` where value is a 13-field tab line.

    idx 3 = 11 for clicks else 10, idx 7 = user, idx 8 = healing item when
    k < 50, idx 12 = ISO time (one-digit fields and a fraction when k % 4 = 1).
    Unread fields hold the event number modulo idx + 2. ``timestamp`` is the
    arrival: up to 44 minutes after the event. Broken on purpose: value < 2 -> 11 fields only;
    2 <= value < 4 -> non-numeric idx 3; 4 <= value < 6 -> impossible time.
    User field padded with a space when k % 3 = 0 (trim must remove it).
    """
    k = props_k(events)
    v = F.col("value")
    code = F.when(F.col("event_type") == "click", F.lit("11")).otherwise(F.lit("10"))
    code = F.when((v >= 2.0) & (v < 4.0), F.concat(F.lit("x"), code)).otherwise(code)
    user = F.col("user_id").cast("string")
    user = F.when(k % 3 == 0, F.concat(user, F.lit(" "))).otherwise(user)
    item = F.when(k < 50, F.lit(HEALING_ITEM)).otherwise(F.concat(F.lit("item"), k.cast("string")))
    time = F.when((v >= 4.0) & (v < 6.0), F.lit("2024-13-45 99:99:99")).otherwise(
        F.when(k % 4 == 1, F.concat(F.date_format(F.col("ts"), "yyyy-M-d H:m:s"), F.lit(".5")))
        .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")))
    fixed = {i: (F.col("event_id") % (i + 2)).cast("string") for i in range(13)}
    by_index = {**fixed, 0: F.col("event_id").cast("string"), 3: code, 7: user, 8: item, 12: time}
    head = [by_index[i] for i in range(11)]
    full = [by_index[i] for i in range(13)]
    line = F.when(v < 2.0, F.concat_ws("\t", *head)).otherwise(F.concat_ws("\t", *full))
    arrival = F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 45).cast("int"))
    return events.select(F.col("event_id"), F.col("ts"), F.to_date("ts").alias("day"), arrival.alias("timestamp"), line.alias("value"))
