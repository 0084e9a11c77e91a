"""Command line: ``python -m headway publish | trip-updates | vehicle-positions | marts | compact | static`` (or spark-submit)."""

from __future__ import annotations

import argparse
import time

from headway.config import JobConfig
from headway.plans.marts import refresh_marts
from headway.session import build_session
from headway.sinks.closed import close_hours
from headway.sources.feeds import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.sources.static import load_published_tables
from headway.streaming.jobs import start_feed, start_trip_updates, start_vehicle_positions


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="headway")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("trip-updates", help="run the trip-update stream")
    jobs.add_parser("vehicle-positions", help="run the vehicle-position stream")
    publish = jobs.add_parser("publish", help="send landed feed snapshots to their topics")
    publish.add_argument("--landed", required=True, help="folder of the landed snapshots, {mode}/{topic} below it")
    publish.add_argument("--checkpoint", required=True)
    publish.add_argument("--recording", help="write topic files below this folder, not to the servers")
    publish.add_argument("--once", action="store_true", help="stop when everything landed has been sent")
    marts = jobs.add_parser("marts", help="refresh the deduplicated table and the marts")
    marts.add_argument("--static", required=True, help="folder of the versioned dimensions")
    marts.add_argument("--target", required=True)
    marts.add_argument("--late-seconds", type=int, default=0, help="take in rows that are so much older than the newest one")
    compact = jobs.add_parser("compact", help="rewrite the silver hours that can no longer change into few files")
    compact.add_argument("--older-than", type=int, default=7200, help="seconds since the end of an hour")
    compact.add_argument("--retain", type=int, default=3600, help="seconds that the replaced files are kept for readers")
    static = jobs.add_parser("static", help="append extracted schedule tables as a dated snapshot")
    static.add_argument("--source", required=True)
    static.add_argument("--target", required=True)
    static.add_argument("--valid-from", required=True, help="YYYY-MM-DD")
    args = parser.parse_args(argv)

    config = JobConfig.from_env()
    spark = build_session(f"headway-{args.job}")
    if args.job == "static":
        load_published_tables(spark, args.source, args.target, args.valid_from, table_format=config.table_format)
    elif args.job == "publish":
        trigger = {"availableNow": True} if args.once else None
        for topic in (TRIP_UPDATES, VEHICLE_POSITIONS):
            recording = f"{args.recording}/{topic}" if args.recording else None
            checkpoint, servers = f"{args.checkpoint}/{topic}", config.kafka_bootstrap_servers
            started = start_feed(spark, topic, args.landed, checkpoint, servers, recording, trigger)
            if args.once:
                started.awaitTermination()
        if not args.once:
            spark.streams.awaitAnyTermination()
    elif args.job == "marts":
        silver = config.silver_table(TRIP_UPDATES)
        refresh_marts(spark, silver, args.static, args.target, config.table_format, args.late_seconds)
    elif args.job == "compact":
        for topic in (TRIP_UPDATES, VEHICLE_POSITIONS):
            close_hours(spark, config.silver_table(topic), int(time.time()) - args.older_than, args.retain)
    else:
        start = start_trip_updates if args.job == "trip-updates" else start_vehicle_positions
        if start(spark, config):
            spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
