"""The command-line jobs, run in-process on the test session."""

import datetime as dt

from tessera import cli
from tests.test_golden_stream import BURST_A, BURST_D, OTHER, line


def test_daily_report_cli(spark, scratch):
    from tessera.plans import inputs
    from tessera.plans.jobs import daily_result_table

    log = inputs.gamelog_json_path(spark, "/root/testdata/sf0.01")
    table = scratch("cli-daily")
    out = cli.main(["daily-report", "--log", log, "--format", "json", "--date", "2024-01-10",
                    "--date", "2024-01-11", "--table", table], spark)
    assert out["dates"] == ["2024-01-10", "2024-01-11"]
    rows = {r.date: r for r in daily_result_table(spark, table).read().collect()}
    assert set(rows) == {"2024-01-10", "2024-01-11"}


def test_bursts_cli_available_now(spark, scratch):
    from tessera.plans.streams import blacklist_table_merge, flagged_tables

    src, tables = scratch("cli-src"), scratch("cli-tables")
    closer = [line("C", 200)]  # moves the watermark past every burst window
    spark.createDataFrame([(x,) for x in BURST_A + BURST_D + OTHER + closer], "value STRING") \
        .coalesce(1).write.mode("append").text(src)
    out = cli.main(["bursts", "--source", src, "--checkpoint", scratch("cli-ckpt"), "--tables", tables,
                    "--watermark", "0 seconds", "--available-now"], spark)
    assert out["batches"] >= 1
    _, bl = flagged_tables(spark, tables)
    got = sorted(tuple(r) for r in bl.read(blacklist_table_merge).collect())
    assert got == [("A", 500.0, 2), ("D", 400.0, 2)]  # two flagged windows each
    # the map as the stream stored it feeds the sync: one for each player and poll
    from tessera.schemas import BLACKLIST_DDL
    from tessera.streaming.sinks import VersionedTable

    synced = scratch("cli-synced")
    for sync_id in ("0", "1"):
        cli.main(["sync-blacklist", "--tables", tables, "--table", synced, "--sync-id", sync_id], spark)
    rows = VersionedTable(spark, synced, BLACKLIST_DDL).read().collect()
    assert sorted(tuple(r) for r in rows) == [("A", 500.0, 2), ("D", 400.0, 2)]


    polled = scratch("cli-polled")
    end = spark.sql("SELECT CAST(now() AS timestamp_ntz) AS t").first().t  # the flags are long ago: each tick counts
    start = end.replace(microsecond=0) - dt.timedelta(seconds=60)
    out = cli.main(["poll-blacklist", "--tables", tables, "--table", polled, "--start", str(start), "--every", "0", "--runs", "2"], spark)
    from tessera.plans.jobs import POLLED_DDL

    rows = VersionedTable(spark, polled, POLLED_DDL).read().collect()
    assert out["tick"] >= 30 and {r.userName for r in rows} == {"A", "D"} and {r.cnt for r in rows} == {out["tick"] + 1}


def test_bursts_cli_from_a_topics_latest_position(spark, scratch):
    from tessera.plans.streams import blacklist_table_merge, flagged_tables
    from tessera.streaming.messages import append

    topic, tables, ckpt = scratch("cli-topic"), scratch("cli-tables"), scratch("cli-ckpt")
    args = ["bursts", "--source", topic, "--format", "messages", "--starting-offsets", "latest", "--checkpoint", ckpt, "--tables", tables, "--watermark", "0 seconds", "--available-now"]

    def send(lines):
        append(spark.createDataFrame([(x,) for x in lines], "value STRING").selectExpr("value", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS timestamp").coalesce(1), topic)

    send(BURST_A)  # before the stream first runs: never seen
    cli.main(args, spark)
    send([*BURST_D, *OTHER])
    cli.main(args, spark)
    for at in (200, 201):  # a run is one batch: windows that it closes come with the next
        send([line("C", at)])
        cli.main(args, spark)
    got = sorted(tuple(r) for r in flagged_tables(spark, tables)[1].read(blacklist_table_merge).collect())
    assert got == [("D", 400.0, 2)]


def test_ingest_then_typed_report_matches_raw(spark, scratch):
    from tessera.plans import inputs
    from tessera.plans.jobs import daily_result_table

    raw = inputs.gamelog_json_path(spark, "/root/testdata/sf0.01")
    typed, bad = scratch("cli-typed"), scratch("cli-bad")
    cli.main(["ingest-gamelog", "--log", raw, "--format", "json", "--out", typed, "--quarantine", bad], spark)
    t_raw, t_typed = scratch("cli-r1"), scratch("cli-r2")
    cli.main(["daily-report", "--log", raw, "--format", "json", "--date", "2024-01-10", "--table", t_raw], spark)
    cli.main(["daily-report", "--typed", "--log", typed, "--date", "2024-01-10", "--table", t_typed], spark)
    a = daily_result_table(spark, t_raw).read().collect()
    b = daily_result_table(spark, t_typed).read().collect()
    assert a == b and a[0]["newAddUserCnt"] > 0
    assert spark.read.parquet(bad).count() > 0  # bad ip / time rows kept aside with a reason
    assert "event_date" in spark.read.parquet(typed).columns
    before = spark.read.parquet(typed).count(), spark.read.parquet(bad).count()
    cli.main(["ingest-gamelog", "--log", raw, "--format", "json", "--out", typed, "--quarantine", bad], spark)
    assert (spark.read.parquet(typed).count(), spark.read.parquet(bad).count()) == before  # a rerun replaces its load
    assert sum(before) == spark.read.json(raw).count()


def test_cluster_conf_names_settings_that_exist(spark):
    """Every line is a setting this Spark knows and takes (static ones belong to the submit command)."""
    from tessera.session import CLUSTER_CONF

    text = cli.main(["cluster-conf"])["text"]
    pairs = dict(line.split(" ", 1) for line in text.splitlines())
    assert pairs == CLUSTER_CONF
    session = spark.newSession()
    for key, value in pairs.items():
        session.conf.set(key, value)
        assert session.conf.get(key) == value
