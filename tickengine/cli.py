"""Jobs for ``spark-submit``: stream, backfill, check, maintain.

::

    spark-submit job.py stream   --source stock-ticks --format kafka \\
        --option kafka.bootstrap.servers=host:9092 --tables /lake --checkpoints /lake/_cp
    spark-submit job.py backfill --source /lake/messages --out /lake/dump --checkpoints /lake/_cp
    spark-submit job.py check    --tables /lake
    spark-submit job.py maintain --tables /lake --delete

``job.py`` is ``from tickengine.cli import main; main()``. ``check`` and ``maintain`` end
with an error if a check or a table fails, so a scheduler can put one after the other.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tickengine.functions import times
from tickengine.operators import quality
from tickengine.plans.maintenance import run_all
from tickengine.schemas import EXPECTED_TICKERS
from tickengine.session import build_session, configure
from tickengine.sources.tables import read_table
from tickengine.streaming.jobs import DeliveryLog, await_all, backfill, run_streams
from tickengine.streaming.source import read_tick_stream


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    spark.streams.addListener(DeliveryLog())
    messages = read_tick_stream(spark, args.source, args.format, **_options(args.option))
    queries = run_streams(
        messages,
        args.tables,
        args.checkpoints,
        durations=tuple(args.window),
        watermark=args.watermark,
        high_low=args.high_low,
        every=None if args.once else args.every,
        upsert=args.upsert,
        decimals=args.decimals,
        max_ahead=args.max_ahead,
        exact=args.exact,
        chained=args.chained,
    )
    await_all(queries)


def dump(spark: SparkSession, args: argparse.Namespace) -> None:
    options = _options(args.option)
    await_all([backfill(spark, args.source, args.out, args.checkpoints, args.format, **options)])


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_table(spark, f"{args.tables}/raw")
    age = quality.require_fresh(raw, args.as_of, args.max_age, days=args.days)
    quality.require_coverage(raw, args.ticker or EXPECTED_TICKERS, args.as_of, args.lookback)
    print(f"fresh ({age} minutes) and covered")


def maintain(spark: SparkSession, args: argparse.Namespace) -> None:
    roots = {"raw": f"{args.tables}/raw"}
    keys, cluster_by = {}, {"raw": ["ticker"]}
    for window in args.window:
        name = f"vwap_{times.label(window)}"
        roots[name] = f"{args.tables}/{name}"
        keys[name] = ["window_start", "ticker"]
        cluster_by[name] = ["ticker", "window_start"]
    run_all(
        spark, roots, args.date, cluster_by=cluster_by, keys=keys,
        retention_hours=args.keep_hours, dry_run=not args.delete,
    ).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tickengine")
    jobs = root.add_subparsers(required=True)

    def job(name, run, *, source=False, tables=False, windows=False):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        if source:
            sub.add_argument("--source", required=True, help="topic or folder")
            sub.add_argument("--format", default="text")
            sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
            sub.add_argument("--checkpoints", required=True)
        if tables:
            sub.add_argument("--tables", required=True, help="folder of the tables")
        if windows:
            sub.add_argument("--window", nargs="+", default=["1 minute", "5 minutes"])
        return sub

    sub = job("stream", stream, source=True, tables=True, windows=True)
    sub.add_argument("--watermark", default="2 minutes")
    sub.add_argument("--every", default="30 seconds", help="trigger interval")
    sub.add_argument("--once", action="store_true", help="process what is there and end")
    sub.add_argument("--upsert", action="store_true", help="publish open windows too")
    sub.add_argument("--high-low", action="store_true")
    sub.add_argument("--decimals", type=int, help="sum prices exactly, as whole units")
    sub.add_argument("--exact", action="store_true", help="sum doubles exactly, in any order")
    sub.add_argument("--chained", action="store_true", help="all window lengths in one query")
    sub.add_argument("--max-ahead", default="1 day", help="quarantine times further ahead of their arrival")

    sub = job("backfill", dump, source=True)
    sub.add_argument("--out", required=True)

    sub = job("check", check, tables=True)
    sub.add_argument("--as-of", help="UTC time instead of now")
    sub.add_argument("--max-age", type=int, default=10, help="minutes")
    sub.add_argument("--days", type=int, default=1, help="partitions to look at")
    sub.add_argument("--ticker", nargs="+")
    sub.add_argument("--lookback", default="5 minutes")

    sub = job("maintain", maintain, tables=True, windows=True)
    sub.add_argument("--date", help="one date instead of all closed ones")
    sub.add_argument("--keep-hours", type=int, help="list dates that ended longer ago; without it all stay")
    sub.add_argument("--delete", action="store_true", help="remove the dates that --keep-hours lists")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession()
    args.run(configure(spark) if spark else build_session(), args)


if __name__ == "__main__":
    main()
