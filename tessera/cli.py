"""Command-line jobs, for ``spark-submit`` (the session comes from the submit configuration).

    spark-submit --py-files tessera.zip tessera/cli.py ingest-gamelog --log hdfs:///logs/game \\
        --format json --out hdfs:///warehouse/gamelog --quarantine hdfs:///warehouse/gamelog_bad
    spark-submit --py-files tessera.zip tessera/cli.py daily-report --typed --log hdfs:///warehouse/gamelog \\
        --date 2018-02-01 --table hdfs:///shared/results/daily
    spark-submit --py-files tessera.zip tessera/cli.py bursts --source hdfs:///landing/lines \\
        --checkpoint hdfs:///shared/ckpt/bursts --tables hdfs:///shared/results/cheats
    spark-submit --py-files tessera.zip tessera/cli.py sync-blacklist --tables hdfs:///shared/results/cheats \\
        --table hdfs:///shared/bl --sync-id 7

Each subcommand is one of the reference's entry points: the offline report
for a base date, the real-time burst detector, and the blacklist sync.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tessera import schemas
from tessera.session import CLUSTER_CONF, configure


def _options(pairs: list[str] | None) -> dict:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)

    d = sub.add_parser("daily-report", help="new / active users and day-1..7 retention, upserted by date")
    d.add_argument("--log", required=True)
    d.add_argument("--format", default="parquet")
    d.add_argument("--date", required=True, action="append", help="base date; repeat for several (one pass)")
    d.add_argument("--table", required=True, help="result table folder (versioned)")
    d.add_argument("--option", action="append", help="reader option key=value")
    d.add_argument("--typed", action="store_true", help="--log is a table written by ingest-gamelog")

    g = sub.add_parser("ingest-gamelog", help="parse the raw offline log once into a day-partitioned table")
    g.add_argument("--log", required=True)
    g.add_argument("--format", default="parquet")
    g.add_argument("--out", required=True)
    g.add_argument("--quarantine", help="folder for rows with a bad ip or time")
    g.add_argument("--load-id", help="name of this load; a rerun replaces it (default: a digest of --log)")
    g.add_argument("--option", action="append", help="reader option key=value")

    b = sub.add_parser("bursts", help="item-burst detector on a stream of tab lines")
    b.add_argument("--source", help="folder of text files (or omit with --format kafka)")
    b.add_argument("--format", default="text")
    b.add_argument("--starting-offsets", help="where a first run begins, for --format kafka or messages: latest, earliest or offsets as JSON")
    b.add_argument("--option", action="append", help="source option key=value (kafka.bootstrap.servers=...)")
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--tables", required=True, help="folder of the flagged-map and blacklist delta logs")
    b.add_argument("--window", default=schemas.BURST_WINDOW)
    b.add_argument("--slide", default=schemas.BURST_SLIDE)
    b.add_argument("--min-count", type=int, default=schemas.BURST_MIN_COUNT)
    b.add_argument("--max-avg-ms", type=float, default=schemas.BURST_MAX_AVG_MS)
    b.add_argument("--watermark", default="10 seconds")
    b.add_argument("--time-basis", choices=["event", "ingest"], default="event")
    b.add_argument("--trigger", default="5 seconds")
    b.add_argument("--available-now", action="store_true", help="process what has arrived, then stop")
    b.add_argument("--compact-every", type=int, default=50)
    b.add_argument("--count-per", choices=["window", "batch"], default="window", help="what adds one to a player's counter")

    sub.add_parser("cluster-conf", help="settings for a large cluster, as a spark-submit properties file")

    s = sub.add_parser("sync-blacklist", help="apply the flagged-player map to the blacklist once")
    s.add_argument("--flagged", help="folder of a stored flagged map")
    s.add_argument("--tables", help="the --tables folder of the bursts job: read its flagged map")
    s.add_argument("--table", required=True)
    s.add_argument("--sync-id", type=int, required=True)
    s.add_argument("--since", help="count only windows ending after this time (default: every flagged player)")

    w = sub.add_parser("poll-blacklist", help="the two-second poll of the flagged-player map, counted at each run")
    w.add_argument("--tables", required=True, help="the --tables folder of the bursts job")
    w.add_argument("--table", required=True, help="the polled blacklist")
    w.add_argument("--start", required=True, help="time of the first tick, yyyy-mm-dd hh:mm:ss")
    w.add_argument("--every", type=float, default=60.0, help="seconds between runs")
    w.add_argument("--runs", type=int, help="stop after so many runs (default: go on)")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    if args.cmd == "cluster-conf":
        return {"cmd": args.cmd, "text": "\n".join(f"{k} {v}" for k, v in CLUSTER_CONF.items())}
    spark = spark or SparkSession.builder.appName(f"tessera-{args.cmd}").getOrCreate()
    configure(spark)

    if args.cmd == "daily-report":
        from tessera.plans.jobs import run_daily_report

        base = args.date if len(args.date) > 1 else args.date[0]
        run_daily_report(spark, args.log, base, args.table, fmt=args.format, typed=args.typed,
                         **_options(args.option))
        return {"cmd": args.cmd, "dates": args.date}

    if args.cmd == "ingest-gamelog":
        from tessera.plans.jobs import ingest_gamelog

        ingest_gamelog(spark, args.log, args.out, fmt=args.format, quarantine_path=args.quarantine,
                       load_id=args.load_id, **_options(args.option))
        return {"cmd": args.cmd, "out": args.out}

    if args.cmd == "bursts":
        from tessera.plans.streams import detect_from_lines, flagged_sink, flagged_tables
        from tessera.streaming.runner import batches_run, run_available, start
        from tessera.streaming.sources import stream_lines

        lines = stream_lines(spark, args.source, fmt=args.format, starting_offsets=args.starting_offsets, **_options(args.option))
        flagged = detect_from_lines(lines, window=args.window, slide=args.slide, min_count=args.min_count,
                                    max_avg_ms=args.max_avg_ms, time_basis=args.time_basis,
                                    watermark=args.watermark)
        fm, bl = flagged_tables(spark, args.tables)
        sink = flagged_sink(fm, bl, compact_every=args.compact_every, count_per=args.count_per)
        if args.available_now:
            q = run_available(flagged, sink, args.checkpoint, "append")
            return {"cmd": args.cmd, "batches": batches_run(q)}
        q = start(flagged, sink, args.checkpoint, "append", processing_time=args.trigger)
        q.awaitTermination()
        return {"cmd": args.cmd}

    if args.cmd == "sync-blacklist":
        from tessera.plans.jobs import sync_blacklist
        from tessera.streaming.sinks import VersionedTable

        bl = VersionedTable(spark, args.table, schemas.BLACKLIST_DDL)
        if bool(args.flagged) == bool(args.tables):
            raise SystemExit("give --flagged or --tables")
        if args.tables:
            from tessera.plans.streams import flagged_map_merge, flagged_tables

            flagged = flagged_tables(spark, args.tables)[0].read(flagged_map_merge)
        sync_blacklist(spark, args.flagged or flagged, bl, args.sync_id, since=args.since)
        return {"cmd": args.cmd, "versions": bl.versions()[-1]}

    if args.cmd == "poll-blacklist":
        from tessera.plans.jobs import POLLED_DDL, poll_periodically
        from tessera.plans.streams import flagged_map_merge, flagged_tables
        from tessera.streaming.sinks import VersionedTable

        flagged = flagged_tables(spark, args.tables)[0]
        tick = poll_periodically(lambda: flagged.read(flagged_map_merge), VersionedTable(spark, args.table, POLLED_DDL), args.start, args.every, args.runs)
        return {"cmd": args.cmd, "tick": tick}

    raise SystemExit(f"unknown command {args.cmd}")


if __name__ == "__main__":
    out = main()
    print(out["text"] if "text" in out else json.dumps(out))
