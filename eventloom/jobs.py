"""Command line: ``python -m eventloom.jobs <job> ...`` (or through spark-submit).

Only here does the wall clock supply defaults; the library takes every time as
a parameter.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from eventloom.plans.pipeline import (
    Lake, build_models, detect_anomalies, ingest_hours, load_hours, load_landed, run_hour,
)
from eventloom.session import build_session
from eventloom.sources.feed import feed_files
from eventloom.streaming import streams

SOURCE_LAG = timedelta(hours=2)  # how long after an hour its feed file appears


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    """Land the feed files of a span of days."""
    ingest_hours(Lake(spark, args.lake), args.feed, args.start_date, args.end_date, args.hour)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Load one landed hour, or by default all that is not loaded yet, and refresh the models."""
    lake = Lake(spark, args.lake)
    if args.at:
        report = load_hours(lake, args.at, args.at, now())
        print(f"processed {report.processed}, inserted {report.inserted}, rejected {report.rejected}")
    else:
        load_landed(lake, now())
    build_models(lake, now())


def hour(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run the whole pipeline for one hour."""
    at = args.at or (now() - SOURCE_LAG).replace(minute=0, second=0, microsecond=0)
    run_hour(
        spark, args.lake, args.feed, at, now(), args.run_id or f"hour-{at:%Y%m%d%H}",
        method=args.method, gate=not args.no_gate, check_everything=args.check_everything,
    ).show(truncate=False)


def anomalies(spark: SparkSession, args: argparse.Namespace) -> None:
    """Score every series again and replace the anomaly table."""
    lake = Lake(spark, args.lake)
    detect_anomalies(lake, lake.raw_table.dates(), args.method, now())


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send one feed file (default: the newest one to be expected) to a topic."""
    at = args.at or now() - SOURCE_LAG
    files = feed_files(spark, args.feed, at.date(), at.date(), at.hour)
    if not files:
        print("no feed file for that hour")
        return
    folder, name = files[0].rsplit("/", 1)
    lines = spark.readStream.format("text").option("pathGlobFilter", name).load(folder)
    streams.write_topic(
        streams.replay_messages(lines), args.servers, args.topic, args.checkpoint
    ).awaitTermination()


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Land a topic continuously, unreadable messages aside."""
    lake = Lake(spark, args.lake)
    messages = streams.read_topic(spark, args.servers, args.topic)
    streams.land_stream(messages, lake.path("landing_stream"), f"{args.checkpoint}/landing")
    streams.quarantine_stream(messages, lake.path("quarantine/stream"), f"{args.checkpoint}/quarantine")
    spark.streams.awaitAnyTermination()


def stream_load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Load what the stream landed so far, whatever hour it belongs to, and refresh the models."""
    lake = Lake(spark, args.lake)
    streams.load_stream(
        spark, lake.path("landing_stream"), lake.path("raw/events"), lake.path("quarantine/rows"),
        args.checkpoint, now(), on_loaded=lambda report: build_models(lake, now()),
    ).awaitTermination()


def _hour(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(minute=0, second=0, microsecond=0)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(fn, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(fn.__name__.replace("_", "-"), help=fn.__doc__)
        sub.set_defaults(run=fn)
        for name in options:
            sub.add_argument(f"--{name}", required=True)
        return sub

    span = job(backfill, "lake", "feed")
    span.add_argument("--start-date", type=date.fromisoformat, required=True)
    span.add_argument("--end-date", type=date.fromisoformat, required=True)
    span.add_argument("--hour", type=int)
    job(load, "lake").add_argument("--at", type=_hour)
    whole = job(hour, "lake", "feed")
    whole.add_argument("--at", type=_hour)
    whole.add_argument("--run-id")
    whole.add_argument("--method", default="auto")
    whole.add_argument("--no-gate", action="store_true")
    whole.add_argument("--check-everything", action="store_true")
    job(anomalies, "lake").add_argument("--method", default="auto")
    job(replay, "feed", "servers", "topic", "checkpoint").add_argument("--at", type=_hour)
    job(stream, "lake", "servers", "topic", "checkpoint")
    job(stream_load, "lake", "checkpoint")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"eventloom-{args.job}"), args)


if __name__ == "__main__":
    main()
