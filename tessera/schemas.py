"""Schemas of the logs and result tables, and the fixed values they carry."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's --------------------------
# Event-type dictionary (code -> label, labels translated to English).
EVENT_TYPES = [
    (0, "admin login"),
    (1, "register or first login"),
    (2, "login"),
    (3, "logout"),
    (4, "upgrade"),
    (5, "reserved"),
    (6, "equipment recycled for gold"),
    (7, "gold to cash"),
    (8, "duel"),
    (9, "growth task"),
    (10, "claim reward"),
    (11, "divine protection"),
    (12, "buy item"),
]
# Codes the daily report uses (offline codes are strings).
REGISTER_CODES = ("1",)
LOGIN_CODES = ("2",)
# The burst job watches event 11 with the healing item.
ITEM_USE_EVENT = 11
HEALING_ITEM = "疗伤药"
# Burst rule: window 10 s sliding by 5 s; at least 5 uses; mean gap below 1000 ms.
BURST_WINDOW = "10 seconds"
BURST_SLIDE = "5 seconds"
BURST_MIN_COUNT = 5
BURST_MAX_AVG_MS = 1000
# Offline time text: 2018年2月1日,星期一,10:02:01 (weekday is ignored).
# Month, day and clock fields may have one digit; what follows the seconds is ignored.
CN_TIME_PATTERN = "yyyy年M月d日 H:m:s"
ISO_TIME_PATTERN = "yyyy-M-d H:m:s"
# Dotted quad, octets not range-checked, whole-string match.
IP_REGEX = r"\A(\d{1,3}\.){3}\d{1,3}\z"
# Weekday names, Sunday first (Spark's dayofweek: 1 = Sunday).
CN_WEEKDAYS = ["星期日", "星期一", "星期二", "星期三", "星期四", "星期五", "星期六"]
# Retention horizon of the daily report.
RETENTION_DAYS = 7
# ---------------------------------------------------------------------------

GAMELOG = T.StructType(
    [
        T.StructField("userName", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("ip", T.StringType()),
    ]
)

# Real-time log line: 13 tab-separated fields; 3, 7, 8 and 12 have a meaning.
LINE_FIELDS = ["f0", "f1", "f2", "eventType", "f4", "f5", "f6", "userName", "item", "f9", "f10", "f11", "time"]
TSV13 = T.StructType([T.StructField(name, T.StringType()) for name in LINE_FIELDS])

FLAGGED = T.StructType(
    [
        T.StructField("userName", T.StringType()),
        T.StructField("avgTime", T.DoubleType()),
        T.StructField("window_end", T.TimestampNTZType()),
    ]
)

BLACKLIST = T.StructType(
    [
        T.StructField("userName", T.StringType()),
        T.StructField("avgTime", T.DoubleType()),
        T.StructField("cnt", T.IntegerType()),
    ]
)

RATE_COLUMNS = [
    "nextDayRate",
    "twoDayRate",
    "threeDayRate",
    "fourDayRate",
    "fiveDayRate",
    "sixDayRate",
    "sevenDayRate",
]

DAILY_RESULT = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("newAddUserCnt", T.LongType()),
     T.StructField("activeUserCnt", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in RATE_COLUMNS]
)

DAILY_RESULT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in DAILY_RESULT.fields)
FLAGGED_DDL = "userName STRING, avgTime DOUBLE, window_end TIMESTAMP_NTZ"
BLACKLIST_DDL = "userName STRING, avgTime DOUBLE, cnt INT"


def event_type_frame(spark):
    """The 13-row event dictionary as a DataFrame (fixed size: safe to broadcast)."""
    return spark.createDataFrame(EVENT_TYPES, "code INT, label STRING")
