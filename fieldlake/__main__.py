"""Command line: spark-submit -m style entry to the end-to-end jobs.

    python -m fieldlake history TABLES OUT --requester 0 [--owner 16] [--no-diseases] [--days 30]
    python -m fieldlake stream  TABLES OUT [--owner 16] [--interval 60] [--jobs store trend rain infections]
    python -m fieldlake images  RAW OUT [--name leaf-images]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fieldlake.operators.fields import with_permissions
from fieldlake.plans import pipelines
from fieldlake.session import configure
from fieldlake.sources import domain, streams


def main() -> None:
    parser = argparse.ArgumentParser(prog="fieldlake")
    commands = parser.add_subparsers(dest="command", required=True)
    history = commands.add_parser("history", help="cold history, disease records, daily summary")
    history.add_argument("--requester", type=int, required=True)
    history.add_argument("--no-diseases", action="store_true")
    history.add_argument("--days", type=int, help="days up to the newest reading; all if left out")
    stream = commands.add_parser("stream", help="drain live readings into hot and cold tables")
    stream.add_argument("--interval", type=int, help="seconds between batches; once over everything if left out")
    stream.add_argument("--jobs", nargs="+", default=["store"], choices=["store", "trend", "rain", "infections"])
    for command in (history, stream):
        command.add_argument("tables")
        command.add_argument("out")
        command.add_argument("--owner", type=int)
    images = commands.add_parser("images", help="split, resize, augment and describe an image tree")
    images.add_argument("raw")
    images.add_argument("out")
    images.add_argument("--name", default="leaf-images")
    args = parser.parse_args()

    spark = configure(SparkSession.builder.appName(f"fieldlake-{args.command}").getOrCreate())
    if args.command == "images":
        pipelines.prepare_images(spark, args.raw, args.out, args.name)
    elif args.command == "history":
        users = with_permissions(domain.users(spark, args.tables))
        pipelines.history(domain.readings(spark, args.tables), domain.fields(spark, args.tables), users,
                          args.requester, args.out, args.owner, not args.no_diseases, args.days)
    else:
        pipelines.live(streams.readings_stream(spark, args.tables), domain.fields(spark, args.tables),
                       args.out, args.owner, args.interval, args.jobs)


if __name__ == "__main__":
    main()
