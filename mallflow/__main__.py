"""Command line: ``python -m mallflow stream ...``, ``backfill ...`` and ``close ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from mallflow.operators.lookup import Dimensions, load_dimensions
from mallflow.plans.backfill import backfill_links
from mallflow.plans.closing import close_day
from mallflow.plans.documents import TRAILING
from mallflow.plans.warehouse import Warehouse
from mallflow.schema import BLACKLIST, SHOP
from mallflow.session import configure, size_for, stored_bytes
from mallflow.sources.messages import file_messages, kafka_messages
from mallflow.streaming.job import MallJob


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="mallflow")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="run the micro-batch job")
    stream.add_argument("--root", required=True, help="folder of the day tables, metrics and checkpoint")
    stream.add_argument("--shops", required=True, help="parquet shop map: posx, posy, floor, name, type")
    stream.add_argument("--blacklist", required=True, help="parquet device blacklist: mac")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS", help="read the topic from these brokers")
    source.add_argument("--directory", help="read text files arriving in this folder")
    stream.add_argument("--topic", help="topic to subscribe to, with --kafka")
    stream.add_argument(
        "--option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="option of the Kafka source, such as startingOffsets, maxOffsetsPerTrigger or kafka.security.protocol; may be repeated",
    )
    stream.add_argument("--max-files", type=int, help="most files of one micro-batch, with --directory")
    stream.add_argument("--interval", default="60 seconds", help="time between micro-batches")
    stream.add_argument("--once", action="store_true", help="process what is there, then stop")
    stream.add_argument("--no-links", action="store_true", help="leave the shop moves to the backfill")
    stream.add_argument("--trailing", action="append", default=[], choices=list(TRAILING), help="keep this metric over a trailing window too")
    stream.add_argument("--zone", default="UTC", help="time zone of the clock text and the processing dates")

    backfill = commands.add_parser("backfill", help="rebuild the shop moves of past days")
    backfill.add_argument("--root", required=True)
    backfill.add_argument("days", nargs="*", metavar="yyyyMMdd")
    backfill.add_argument("--all", action="store_true", help="every stored date")

    close = commands.add_parser("close", help="merge the batch folders of past days")
    close.add_argument("--root", required=True)
    close.add_argument("days", nargs="+", metavar="yyyyMMdd")

    parsed = parser.parse_args(argv)
    if parsed.command == "stream" and parsed.kafka and not parsed.topic:
        parser.error("--kafka needs --topic")
    if parsed.command == "stream" and any("=" not in option for option in parsed.option):
        parser.error("--option takes NAME=VALUE")
    if parsed.command == "backfill" and bool(parsed.days) == parsed.all:
        parser.error("name the days, or --all")
    if parsed.command != "stream" and (wrong := [day for day in parsed.days if not _is_date(day)]):
        parser.error(f"no date of the form yyyyMMdd: {', '.join(wrong)}")
    return parsed


def _is_date(day: str) -> bool:
    try:
        return datetime.strptime(day, "%Y%m%d").strftime("%Y%m%d") == day
    except ValueError:
        return False


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"mallflow-{args.command}").getOrCreate()
    configure(spark, getattr(args, "zone", "UTC"))
    house = Warehouse(spark, args.root.rstrip("/"))
    if args.command == "backfill":
        below = [""] if args.all else [f"/p_dt={day}" for day in args.days]
        size_for(spark, sum(stored_bytes(spark, f"{house.path('dw')}{part}") for part in below))
        backfill_links(spark, house.path("dw"), house.path("links"), None if args.all else args.days)
        return

    if args.command == "close":
        for day in args.days:
            size_for(spark, stored_bytes(spark, f"{house.path('dw')}/p_dt={day}"))
            close_day(house, day)
        return

    def dimensions() -> Dimensions:
        return load_dimensions(
            spark.read.schema(SHOP).parquet(args.shops), spark.read.schema(BLACKLIST).parquet(args.blacklist)
        )

    if args.kafka:
        lines = kafka_messages(spark, args.kafka, args.topic, origins=True, **dict(option.split("=", 1) for option in args.option))
    else:
        lines = file_messages(spark, args.directory, args.max_files, origins=True)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    MallJob(house, dimensions, links=not args.no_links, trailing=tuple(args.trailing)).start(lines, **trigger).awaitTermination()


if __name__ == "__main__":
    main()
