"""Commands to run on a cluster: ``spark-submit tidelake/jobs.py <command> --root <folder> ...``."""

from __future__ import annotations

import argparse
import os
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import SparkSession

from tidelake.plans.pipeline import EPOCH, Lakehouse, load_snapshot, merge_new_events, rebuild, refresh_reports
from tidelake.schemas import ENTITIES, GOLD
from tidelake.session import build_session
from tidelake.sources.catalog import create_event_tables, create_state_tables, name_log
from tidelake.sources.event_log import close_days
from tidelake.sources.files import load_csv
from tidelake.sources.jdbc import read_table
from tidelake.sources.kafka import read_topics, topics
from tidelake.streaming import start_ingest, start_state


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder of the three layers")
        sub.add_argument("--buckets", type=int, default=8, help="buckets of every table; the first number given for a root stays")
        return sub

    init = command("init-tables", "declare the tables of the log and of the current state")
    init.add_argument("--recreate", action="store_true", help="drop declared current-state tables first")

    ingest = command("ingest", "stream change topics into the event log")
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--topic-prefix", default="shop.public")
    ingest.add_argument("--max-records", type=int, help="records per trigger at most; all there are if not given")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--every", default="30 seconds")

    load = command("load", "load whole source tables into the event log")
    load.add_argument("--url", required=True)
    load.add_argument("--user", required=True)
    load.add_argument("--password-file", help="file with the password; else PGPASSWORD is read")
    load.add_argument("--blocks", type=int, help="blocks of each table; asked from the database if not given")
    load.add_argument("--parts", type=int, default=4, help="tasks per table")
    load.add_argument("--topic-prefix", default="shop.public")

    files = command("load-files", "load delimited exports into the event log")
    files.add_argument("--folder", required=True)
    files.add_argument("--topic-prefix", default="shop.public")

    merge = command("merge", "merge events ingested after a watermark")
    merge.add_argument("--watermark", type=datetime.fromisoformat, default=EPOCH)
    merge.add_argument("--no-late-guard", action="store_true", help="let a staged row win whatever its age")
    merge.add_argument("--delete-keeps-target", action="store_true", help="leave the business columns as they were on a delete")
    merge.add_argument("--refresh", action="store_true", help="refresh the reports afterwards")

    command("rebuild", "replace current state by what the whole log gives")
    command("refresh", "refresh all reports")

    close = command("close-days", "move past days of the log into few sorted files")
    close.add_argument("--before", type=date.fromisoformat, required=True, help="the first day that stays open")
    close.add_argument("--checkpoint", action="append", default=[], help="of a stream that reads the log; give all of them")

    follow = command("follow", "stream the log into current state and reports")
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--every", default="30 seconds")
    follow.add_argument("--max-files", type=int)
    follow.add_argument("--once", action="store_true", help="work off what is new since the checkpoint, refresh, and stop")
    follow.add_argument("--refresh-every", type=int, default=0, help="seconds between refreshes of the reports at least")
    return parser.parse_args(argv)


def password(args: argparse.Namespace) -> str:
    """From a file or the environment: a command line shows up in process lists and logs."""
    return Path(args.password_file).read_text().strip() if args.password_file else os.environ["PGPASSWORD"]


def name_tables(lake: Lakehouse) -> None:
    """Names for SQL text: ``bronze.orders``, ``silver.orders``, ``gold.daily_revenue`` and so on."""
    name_log(lake.spark, lake.log_root)
    for name in lake.entities:
        lake.state_table(name)
    for name in GOLD:
        lake.report_table(name)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = Lakehouse(spark, args.root, args.buckets, named=True)
    now = datetime.now(timezone.utc)
    made_by = f"{args.command} {now.isoformat()}"
    if args.command == "init-tables":
        create_event_tables(spark, lake.log_root)
        create_state_tables(spark, f"{lake.root}/silver", buckets=lake.buckets, recreate=args.recreate)
    elif args.command == "ingest":
        records = read_topics(spark, args.servers, topics(args.topic_prefix), max_records=args.max_records)
        start_ingest(records, lake.log_root, args.checkpoint, {"processingTime": args.every}).awaitTermination()
    elif args.command == "load":
        for name in ENTITIES:
            rows = read_table(spark, args.url, name, args.user, password(args), args.blocks, args.parts)
            load_snapshot(lake, name, rows, made_by, now, f"{args.topic_prefix}.{name}")
    elif args.command == "load-files":
        for name, rows in load_csv(spark, args.folder).items():
            if name in ENTITIES:
                load_snapshot(lake, name, rows, made_by, now, f"{args.topic_prefix}.{name}")
    elif args.command == "merge":
        rules = {"late_guard": not args.no_late_guard, "delete_keeps_target": args.delete_keeps_target}
        changed = [name for name, (touched, _) in merge_new_events(lake, args.watermark, **rules).items() if touched]
        if args.refresh:
            refresh_reports(lake, changed)
    elif args.command == "rebuild":
        rebuild(lake)
        refresh_reports(lake)
    elif args.command == "refresh":
        refresh_reports(lake)
    elif args.command == "close-days":
        close_days(spark, lake.log_root, args.before, args.checkpoint)
    elif args.command == "follow":
        trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
        every = timedelta(days=1) if args.once else timedelta(seconds=args.refresh_every)
        start_state(lake, args.checkpoint, trigger, args.max_files, refresh=not args.once, refresh_every=every).awaitTermination()
        if args.once:
            refresh_reports(lake)
    if args.command not in ("ingest", "follow") or getattr(args, "once", False):
        name_tables(lake)


if __name__ == "__main__":
    parsed = arguments()
    run(build_session(f"tidelake {parsed.command}"), parsed)
