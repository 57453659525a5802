"""Physical-plan properties that matter at scale."""

import pytest

from tests.conftest import SF01

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_flagship_pushes_filters_and_shuffles_once(spark):
    from tessera.plans.catalog import QUERIES

    p = plan(QUERIES["retention_report"](spark, SF01))
    scan = p[p.index("Scan parquet"):]
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    assert "In(event_type, [signup,view])" in pushed
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in pushed and "LessThan(ts,2024-01-18T00:00)" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert p.count("Exchange hashpartitioning") + p.count("hashpartitioning(") >= 1
    assert "Join" not in p
    assert sum(1 for ln in p.splitlines() if ln.startswith("(") and "Scan parquet" in ln) == 1


@pytest.mark.parametrize("key", ["retention_matrix", "burst_players", "retained_semi", "retained_selfjoin",
                                 "retained_intersect", "blacklist_merge", "upsert_daily", "event_decode",
                                 "gamelog_report", "burst_lines", "sanctions", "flagged_latest", "metrics_union"])
def test_no_quadratic_or_python_operators(spark, key):
    from tessera.plans.catalog import QUERIES

    p = plan(QUERIES[key](spark, SF01))
    for op in FORBIDDEN:
        assert op not in p, (key, op)


def test_burst_window_state_is_partial_aggregate(spark):
    from tessera.plans.catalog import QUERIES

    p = plan(QUERIES["burst_players"](spark, SF01))
    assert "partial_count" in p and "partial_max" in p and "partial_min" in p
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)" in p


def test_dictionary_broadcast_is_the_fixed_13_rows(spark):
    from tessera.plans.catalog import QUERIES

    p = plan(QUERIES["event_decode"](spark, SF01))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


@pytest.mark.parametrize("key,scans", [("blacklist_merge", 2), ("flagged_latest", 2), ("sanctions", 3), ("upsert_daily", 2), ("retained_selfjoin", 2)])
def test_keyed_tables_read_their_stored_input(spark, key, scans):
    """The events are scanned once, for the stored windows or results; the merge reads those."""
    from tessera.plans.catalog import QUERIES

    p = plan(QUERIES[key](spark, SF01))
    assert sum(1 for ln in p.splitlines() if ln.startswith("(") and "Scan parquet" in ln) <= scans
    events = sum("events.parquet" in ln for ln in p.splitlines() if "Location" in ln)
    assert events <= {"upsert_daily": 1, "retained_selfjoin": 2}.get(key, 0)


def test_saved_report_prunes_day_partitions(spark, scratch):
    from tessera.operators import retention
    from tessera.operators.roles import GAMELOG_ROLES
    from tessera.plans import inputs, jobs

    typed = scratch("typed-plan")
    jobs.ingest_gamelog(spark, inputs.gamelog_json_path(spark, SF01), typed, fmt="json")
    p = plan(retention.daily_reports(spark.read.parquet(typed), GAMELOG_ROLES, ["2024-01-10", "2024-01-11"]))
    filters = next(ln for ln in p.splitlines() if "PartitionFilters" in ln)
    assert "event_date" in filters


def test_bounds_on_one_side_reach_the_scan(spark):
    from tessera.operators import retention
    from tessera.operators.roles import EVENTS_ROLES

    events = spark.read.parquet(f"{SF01}/events.parquet")
    p = plan(retention.retention_matrix(events, EVENTS_ROLES, start="2024-01-20"))
    assert "GreaterThanOrEqual(ts,2024-01-20T00:00)" in p
    p = plan(retention.retention_matrix(events, EVENTS_ROLES, end="2024-01-05"))
    assert "LessThan(ts,2024-01-13T00:00)" in p


def test_metrics_union_scans_once(spark):
    from tessera.plans.catalog import QUERIES

    df = QUERIES["metrics_union"](spark, SF01)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reads = [x for x in final.split("\n") if "FileScan" in x or "Scan parquet" in x]
    assert final.count("ReusedExchange") >= 2 and len(reads) - final.count("ReusedExchange") <= 1 or len(reads) == 1, final
