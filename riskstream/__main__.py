"""Command line: stream, backfill, merge, compact, prune, report."""

from __future__ import annotations

import argparse
import logging

from riskstream.operators.filters import period_filter
from riskstream.operators.upsert import RULES
from riskstream.options import JobOptions
from riskstream.plans.dashboard import Snapshot, dashboard
from riskstream.session import build_session, release
from riskstream.sources.messages import file_messages, kafka_messages
from riskstream.sources.tables import jdbc_table, parquet_table
from riskstream.streaming.database import database_writer, jdbc_stage, postgres
from riskstream.streaming.jobs import run_backfill, run_stream
from riskstream.streaming.log import compact, prune
from riskstream.streaming.metrics import BatchMetrics
from riskstream.streaming.monthly import has_summary, merge_batches, merged_summary

#: Rows of a frame on the console where all of them are in a folder.
SHOWN = 20


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskstream", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    for name in ("stream", "backfill"):
        job = commands.add_parser(name)
        job.add_argument("--messages", help="folder of JSON lines; the Kafka topic if not given")
        job.add_argument("--log", help="folder of the delivery log; the database if not given")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--metrics", help="folder for the counts of each batch")
        if name == "stream":
            job.add_argument("--route", help="folder for flagged messages; the flagged topic if not given")
            job.add_argument("--whole", action="store_true", help="forward messages as they came")
            job.add_argument("--every", default="10 seconds")
            job.add_argument("--apart", action="store_true", help="store and forward as two queries that read the source each")

    merge = commands.add_parser("compact")
    merge.add_argument("--log", required=True)
    merge.add_argument("--out", required=True)
    merge.add_argument("--rule", choices=sorted(RULES), default="flag_upsert")
    merge.add_argument("--through", type=int, help="last batch to take, where one job fills the log")
    merge.add_argument("--base", help="the table compacted last")

    months = commands.add_parser("merge", help="merge new batches of the log into a table by month")
    months.add_argument("--log", required=True)
    months.add_argument("--table", required=True)
    months.add_argument("--rule", choices=sorted(RULES), default="flag_upsert")

    gone = commands.add_parser("prune", help="remove the log's batches that a compacted table holds")
    gone.add_argument("--log", required=True)
    gone.add_argument("--table", required=True)

    report = commands.add_parser("report")
    report.add_argument("--table", help="folder of the table; the database if not given")
    report.add_argument("--from", dest="since", help="first day")
    report.add_argument("--to", dest="until", help="day after the last one")
    report.add_argument("--out", help="folder for every frame, whole, as Parquet")
    report.add_argument("--per-month", type=int, help="report on a sample of each month")
    report.add_argument("--accuracy", type=int, help="approximate boxes, from sketches of this size")
    for facet in ("status", "location", "card-type"):
        report.add_argument(f"--{facet}", nargs="*")
    return parser.parse_args()


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    arguments = _arguments()
    options = JobOptions.from_env()
    spark = build_session(options)

    if arguments.command in ("stream", "backfill"):
        streaming = arguments.command == "stream"
        rule = "flag_upsert" if streaming else "insert_ignore"
        if arguments.metrics:
            spark.streams.addListener(BatchMetrics(spark, arguments.metrics))
        if arguments.messages:
            messages = file_messages(spark, arguments.messages)
        else:
            start = "latest" if streaming else "earliest"
            messages = kafka_messages(spark, options, starting_offsets=start)
        if arguments.log:
            writer = arguments.log
        else:
            connect = postgres(
                host=options.db_host, port=options.db_port, dbname=options.db_name,
                user=options.db_user, password=options.db_password,
            )
            checkpoint = f"{arguments.checkpoint}/store" if streaming else arguments.checkpoint
            writer = database_writer(connect, jdbc_stage(options), options.db_table, rule, checkpoint)
        if streaming:
            run_stream(
                spark, messages, writer=writer, checkpoint=arguments.checkpoint,
                route_path=arguments.route, whole=arguments.whole, options=options,
                every=arguments.every, apart=arguments.apart,
            )
        else:
            run_backfill(messages, writer, arguments.checkpoint, options)
    elif arguments.command == "compact":
        compact(
            spark, arguments.log, arguments.rule, arguments.out, base_path=arguments.base,
            through_batch=arguments.through,
        )
    elif arguments.command == "merge":
        print("months rewritten:", *merge_batches(spark, arguments.log, arguments.rule, arguments.table))
    elif arguments.command == "prune":
        print(prune(spark, arguments.log, arguments.table), "batches removed")
    else:
        def load():
            rows = parquet_table(spark, arguments.table) if arguments.table else jdbc_table(spark, options)
            return period_filter(rows, arguments.since, arguments.until)

        by_day = None
        if arguments.table and arguments.per_month is None and has_summary(spark, arguments.table):
            by_day = period_filter(merged_summary(spark, arguments.table), arguments.since, arguments.until)
        with Snapshot(load, arguments.per_month, store=not arguments.table) as snapshot:
            frames = dashboard(
                snapshot.frame, status=arguments.status, location=arguments.location,
                card_type=arguments.card_type, accuracy=arguments.accuracy, by_day=by_day,
            )
            groups = frames.pop("summary")
            for name, frame in frames.items():
                if arguments.out:
                    frame.write.parquet(f"{arguments.out}/{name}")
                    frame = spark.read.parquet(f"{arguments.out}/{name}")
                rows = frame.count()
                print(f"{name}: {rows} rows")
                frame.show(min(rows, SHOWN) if arguments.out else rows, truncate=False)
            groups.unpersist()
    release(spark)


if __name__ == "__main__":
    main()
