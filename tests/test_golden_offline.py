"""F1 golden rows: the daily report on the offline game log, by hand."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean, retention, users
from tessera.operators.roles import GAMELOG_ROLES as G

WEEKDAY = {1: "星期四", 2: "星期五", 3: "星期六", 4: "星期日", 8: "星期四", 9: "星期五"}


def cn(day: int, hms: str) -> str:
    return f"2018年2月{day}日,{WEEKDAY[day]},{hms}"


F1 = [
    ("u1", "1", cn(1, "00:00:00"), "1.1.1.1"),
    ("u1", "1", cn(1, "00:00:05"), "1.1.1.1"),
    ("u2", "1", cn(1, "12:00:00"), "1.1.1.2"),
    ("u3", "1", cn(1, "23:59:59"), "1.1.1.3"),
    ("u4", "2", cn(1, "08:00:00"), "1.1.1.4"),
    ("u5", "1", cn(2, "00:00:00"), "1.1.1.5"),
    ("u6", "1", cn(1, "09:00:00"), ""),
    ("u7", "3", cn(1, "09:00:00"), "1.1.1.7"),
    ("u1", "2", cn(2, "00:00:00"), "1.1.1.1"),
    ("u2", "2", cn(2, "23:59:59"), "1.1.1.2"),
    ("u4", "2", cn(2, "10:00:00"), "1.1.1.4"),
    ("u6", "2", cn(2, "10:00:00"), "1.1.1.6"),
    ("u1", "2", cn(3, "10:00:00"), "1.1.1.1"),
    ("u3", "1", cn(4, "10:00:00"), "1.1.1.3"),
    ("u3", "2", cn(8, "23:59:59"), "1.1.1.3"),
    ("u2", "2", cn(9, "00:00:00"), "1.1.1.2"),
]
SCHEMA = "userName STRING, eventType STRING, time STRING, ip STRING"


@pytest.fixture()
def log(spark):
    return clean.clean_gamelog(spark.createDataFrame(F1, SCHEMA))


def test_report_by_hand(log):
    row = retention.daily_report(log, G, "2018-02-01").first()
    assert row["date"] == "2018-02-01"
    assert (row["newAddUserCnt"], row["activeUserCnt"]) == (3, 4)
    rates = [row[c] for c in ("nextDayRate", "twoDayRate", "threeDayRate", "fourDayRate", "fiveDayRate",
                              "sixDayRate", "sevenDayRate")]
    assert rates == ["66.67%", "33.33%", "0.00%", "0.00%", "0.00%", "0.00%", "33.33%"]


def test_all_shapes_agree(log):
    base = "2018-02-01"
    flags = retention.retention_counts(log, G, base).first()
    expect = [flags[f"d{n}_retained"] for n in range(1, 8)]
    assert expect == [2, 1, 0, 0, 0, 0, 1]
    for fn in (users.retained_semi, users.retained_selfjoin, users.retained_intersect):
        got = [r["retained_users"] for r in fn(log, G, base).orderBy("day_n").collect()]
        assert got == expect, fn.__name__
    assert retention.metrics_union(log, G, base).first().asDict() == flags.asDict()
    m = retention.retention_matrix(log, G).where(F.col("date") == F.lit("2018-02-01")).first()
    assert [m[f"d{n}_retained"] for n in range(1, 8)] == expect


def test_no_registrations_gives_null_rates(log):
    row = retention.daily_report(log, G, "2018-03-01").first()
    assert (row["newAddUserCnt"], row["activeUserCnt"]) == (0, 0)
    assert row["nextDayRate"] is None and row["sevenDayRate"] is None


def test_garbage_time_is_quarantined(spark):
    rows = F1 + [("u9", "1", "not a time", "1.1.1.9"), ("u8", "1", cn(1, "10:00:00"), "999.999.999.999\n")]
    raw = spark.createDataFrame(rows, SCHEMA)
    q = {r["userName"]: r["reason"] for r in clean.gamelog_quarantine(raw).collect()}
    assert q == {"u6": "bad ip", "u9": "bad time", "u8": "bad ip"}
    assert clean.clean_gamelog(raw).count() == len(F1) - 1


def test_missing_user_counts_as_empty_string(spark):
    raw = spark.createDataFrame([(None, "1", cn(1, "10:00:00"), "1.1.1.1")], SCHEMA)
    row = retention.retention_counts(clean.clean_gamelog(raw), G, "2018-02-01").first()
    assert row["newAddUserCnt"] == 1


def test_octets_not_range_checked(spark):
    df = spark.createDataFrame([("999.999.999.999",), ("1.2.3",), ("1.2.3.4.5",), ("a.b.c.d",)], "ip STRING")
    assert [r.ip for r in clean.ip_filter(df).collect()] == ["999.999.999.999"]


def test_get_time_mills_sql_function(spark):
    from tessera.functions import sqlfn

    sqlfn.register(spark)
    r = spark.sql("SELECT getTimeMills('2018年2月1日,星期一,10:02:01') AS a, getTimeMills('garbage') AS b").first()
    assert r.a == 1517479321000 and r.b is None


def test_partitioned_log_prunes_days(spark, scratch):
    from tessera.sources.logs import write_event_log

    path = scratch("plog")
    write_event_log(clean.clean_gamelog(spark.createDataFrame(F1, SCHEMA)), path, "event_ts")
    log = spark.read.parquet(path)
    df = retention.daily_report(log, G, "2018-02-01")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    import re

    part = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert re.search(r"event_date#\d+ >= 2018-02-01", part) and re.search(r"event_date#\d+ <= 2018-02-08", part)
    assert df.first()["nextDayRate"] == "66.67%"


def test_drop_blank_user_option(spark):
    raw = spark.createDataFrame(F1 + [(None, "1", cn(1, "10:00:00"), "1.1.1.1")], SCHEMA)
    keep = retention.retention_counts(clean.clean_gamelog(raw), G, "2018-02-01").first()
    drop = retention.retention_counts(clean.clean_gamelog(raw, drop_blank_user=True), G, "2018-02-01").first()
    assert (keep["newAddUserCnt"], drop["newAddUserCnt"]) == (4, 3)


def test_fraction_and_percent_rates(log):
    counts = retention.retention_counts(log, G, "2018-02-01")
    pct = retention.retention_rate(counts).first()
    frac = retention.retention_rate(counts, percent=False).first()
    assert pct["d1_rate"] == 66.6667 and frac["d1_rate"] == 0.6667 and frac["d3_rate"] == 0.0


def test_daily_reports_many_dates_one_pass(log, spark):
    rows = {r.date: r for r in retention.daily_reports(log, G, ["2018-02-01", "2018-02-02", "2018-03-01"]).collect()}
    one = retention.daily_report(log, G, "2018-02-01").first()
    assert rows["2018-02-01"].asDict() == one.asDict()
    assert rows["2018-02-02"]["activeUserCnt"] == 5  # u1, u2, u4, u6 log in and u5 registers on the 2nd
    assert rows["2018-03-01"]["newAddUserCnt"] == 0 and rows["2018-03-01"]["nextDayRate"] is None


def test_scan_gamelog_formats_agree(spark, scratch):
    from tessera.sources.logs import scan_gamelog

    raw = spark.createDataFrame(F1 + [(None, "2", cn(2, "01:00:00"), None)], SCHEMA)
    paths = {}
    for fmt in ("json", "parquet", "csv"):
        paths[fmt] = scratch(f"glog-{fmt}")
        w = raw.write.mode("overwrite")
        (w.option("header", "false") if fmt == "csv" else w).format(fmt).save(paths[fmt])
    # CSV cannot tell "" from a missing field; after the "" defaults all formats agree
    rows = {fmt: sorted(map(tuple, clean.gamelog_defaults(scan_gamelog(spark, p, fmt)).collect()))
            for fmt, p in paths.items()}
    assert rows["json"] == rows["parquet"] == rows["csv"] and len(rows["json"]) == len(F1) + 1
    # a parquet log without an ip column: the field comes back NULL, then "" after defaults
    no_ip = scratch("glog-noip")
    raw.drop("ip").write.mode("overwrite").parquet(no_ip)
    assert {r.ip for r in clean.gamelog_defaults(scan_gamelog(spark, no_ip)).collect()} == {""}


def test_time_text_forms_and_time_zone(spark):
    """One-digit fields and text after the seconds are fine; the caller's time zone stays and counts."""
    from tessera.functions import sqlfn
    from tessera.functions.time import parse_cn_time, parse_iso_time
    from tessera.session import configure

    cn_rows = ["2018年2月1日,星期四,09:02:01", "2018年2月1日 9:02:01", "2018年02月01日,x,9:2:1.5", "2018年2月1日", "not a time"]
    df = spark.createDataFrame([(x,) for x in cn_rows], "t STRING")
    got = [r[0] for r in df.select(parse_cn_time("t").cast("string")).collect()]
    assert got == ["2018-02-01 09:02:01"] * 3 + [None] * 2
    iso = spark.createDataFrame([(x,) for x in ("2018-2-1 9:05:03", "2018-02-01 11:08:07.5", " 2018-02-01 11:08:07 x", "2018-13-01 11:08:07", "")], "t STRING")
    got = [r[0] for r in iso.select(parse_iso_time("t").cast("string")).collect()]
    assert got == ["2018-02-01 09:05:03", "2018-02-01 11:08:07", "2018-02-01 11:08:07", None, None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
        sqlfn.register(spark)
        ms = spark.sql("SELECT getTimeMills('2018年2月1日,星期四,8:00:00')").first()[0]
        assert ms == 1517443200000  # 2018-02-01 00:00 UTC
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        sqlfn.register(spark)
