"""Headline-query timings: one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed with the ``noop`` sink (full execution, nothing sent
to the driver), once to warm the JVM and file cache, then ``BENCH_REPEATS``
times; the best time counts. ``value`` is the sum over the headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ["retention_report", "retention_matrix", "burst_players"]
EXTRA = ["gamelog_report", "burst_lines", "retained_semi", "metrics_union", "blacklist_merge", "parse_log_line",
         "daily_report_saved", "retention_bitmaps", "burst_panes", "late_records", "user_history"]


def main() -> None:
    from tessera.plans.catalog import QUERIES
    from tessera.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    t0 = time.time()
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    session_s = time.time() - t0

    timings = {}
    for name in HEADLINE + EXTRA:
        best = None
        for i in range(repeats + 1):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t
            if i > 0:
                best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    # streaming: the burst detector (append + watermark) over all clicks, delivered as 6 arriving chunks
    from tessera.plans import catalog, streams
    from tessera.streaming.runner import batches_run

    clicks = catalog._clicks(spark, sf_dir)
    n_clicks = clicks.count()
    t = time.time()
    out, runs = streams.run_bursts(spark, clicks, "user_id", "ts", mode="append", watermark="0 seconds",
                                   **catalog.BURST)
    out.write.format("noop").mode("overwrite").save()
    stream_s = time.time() - t
    batches = batches_run(runs[-1])

    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "headline_query_seconds",
        "value": round(sum(timings[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "session_start_sec": round(session_s, 2),
        "stream": {"query": "burst_stream_wm", "events": n_clicks, "sec": round(stream_s, 2),
                   "micro_batches": batches, "events_per_sec": round(n_clicks / stream_s, 1)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
