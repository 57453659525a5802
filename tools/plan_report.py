"""Summarise the physical plan of every batch query: shuffles, joins, pushdown, pruning.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

STREAM_KEYS = {"burst_stream", "burst_stream_complete", "burst_stream_wm", "late_drop", "burst_stream_ingest",
               "stream_ingest", "blacklist_stream", "sync_blacklist", "late_records_stream", "stream_latest", "burst_messages"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def summarise(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    exchanges = re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)
    joins = sorted(set(re.findall(r"(\w+Join \w+|\w+Join)\b", tree)))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    parts = re.findall(r"PartitionFilters: \[(.*)\]", plan)
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    return {
        "scans": len(schemas),
        "read_columns": sorted({c.split(":")[0] for s in schemas for c in s.split(",")}),
        "shuffles": len([e for e in exchanges if e != "SinglePartition"]),
        "single_partition": sum(1 for e in exchanges if e == "SinglePartition"),
        "broadcast": "BroadcastExchange" in plan,
        "joins": joins,
        "expand": "Expand" in tree,
        "pushed": [p for p in pushed if p],
        "partition_filters": [p for p in parts if p],
        "python": [n for n in PYTHON_NODES if n in plan],
        "cartesian": "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan,
    }


NOTES = """
## At 100 TB

Rough volumes assume a 100 TB event log, ~1e12 events, 1e9 users, a few years of days. "Hot key" means one user or
day holding a third of the rows.

- **`retention_report`**: with `write_event_log` partitions, the scan reads 8 days. Without them it reads row groups
  whose `ts` statistics overlap those days, and only 3 columns. One shuffle carries at most one partial row per
  (user, map task), i.e. about active users x tasks touching them, not events. A hot user is one partial row per task.
  The last exchange carries 9 counters per task.
- **`retention_matrix`**: a full scan of 3 columns. Shuffle 1 carries partial (user, day) rows, keyed by user and day,
  so a hot user or hot day spreads over all reducers. Shuffle 2 carries the distinct user-days once, keyed by user.
  Each user has at most one row per calendar day, so the window's largest partition holds a few thousand rows per
  user. Shuffle 3 carries partial counters per (task, day).
- **`burst_players` / stream**: each click is copied into `window / slide` windows (2 here) before the partial
  aggregate. The shuffle carries one row per (window, user, task). The state is 3 longs per open (window, user) and is
  evicted when the watermark passes. RocksDB keeps it off the heap.
- **Keyed tables**: a micro-batch writes only its flagged windows. Reads merge a compacted base with the newer deltas
  through a union and one pre-aggregated `groupBy(user)` (`flagged_latest`, `blacklist_merge`, `upsert_daily` by
  date): a single shuffle and no join. Nothing is ever keyed on a constant.
- **`retention_bitmaps`**: reads the stored bitmaps alone, 4 KB per 32,768 user numbers, role and day: some 30,000 rows a
  role and day for 1e9 users, however many events. Each register and login bitmap is copied to `days` cohorts for the
  intersections; a range of dates reads its own folders only.
- **`retention_by_loads`**: a load shuffles its own user-days and reads the stored ones of the days around it.
- **`burst_panes`**: one row per click until its pane, then two to four change points a pane; windows are made from states
  that satisfy the rule only. Groups are (user, stretch of 256 windows), so a long history is many groups.
- **`late_records`**: one range shuffle of the records; the carried maxima are a row per range partition, broadcast.
- **`blacklist_bucketed`**: a merge shuffles the batch; the base is read and written bucket by bucket.
- **Parsing**: tab lines are parsed once per line (`from_csv` inside a `Generate`). Game-log time is parsed with
  built-in expressions. No Python runs per row anywhere; `late_records` and `burst_on_time` run a prefix maximum over Arrow
  batches, when the key is called, and the plan listed is what remains to be done.
"""


def main():
    from tessera.plans.catalog import QUERIES
    from tessera.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# Physical plans of the registered batch queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (local[*], AQE on; the initial plan, before AQE "
          "re-optimises at run time). Shuffles = hash exchanges; single = exchanges to one partition "
          "(after map-side partial aggregation, so they carry one row per task).\n")
    print("| key | scans | shuffles | single | joins | broadcast | expand | python / cartesian | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key in sorted(QUERIES):
        if key in STREAM_KEYS:
            continue
        df = QUERIES[key](spark, sf)
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(plan)
        pushed = "; ".join(sorted(set(s["pushed"])))[:160]
        print(f"| `{key}` | {s['scans']} | {s['shuffles']} | {s['single_partition']} | {', '.join(s['joins']) or '-'} "
              f"| {'yes' if s['broadcast'] else '-'} | {'yes' if s['expand'] else '-'} "
              f"| {', '.join(s['python']) or ('CARTESIAN' if s['cartesian'] else 'none')} | {pushed} |")
    print(NOTES)
    print("\nStream keys (" + ", ".join(f"`{k}`" for k in sorted(STREAM_KEYS)) + ") run the same aggregate as "
          "`burst_players` (partial aggregate -> exchange by (window, user) -> state store); see "
          "`tessera/plans/streams.py`.")


if __name__ == "__main__":
    main()
