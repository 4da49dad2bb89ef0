"""Command line: one subcommand per job.

    python -m racestream.plans.cli clicks --input DIR --output DIR [--properties FILE]
           [--stream --checkpoint DIR [--available-now]]
    python -m racestream.plans.cli monitor-gap|find-follower|measure-gap|status
           (--input DIR | --kafka HOST:PORT) --output DIR [--target ID ... | --targets DIR]
           [--properties FILE] [--stream --checkpoint DIR [--available-now] [--idle-timeout TEXT]]
    python -m racestream.plans.cli gap-csv (--input DIR | --kafka HOST:PORT) --output DIR
    python -m racestream.plans.cli dump-bytes (--input DIR | --kafka HOST:PORT) --output DIR

Click input: files with columns (value, ts, seq). Telemetry input: files in the
Kafka layout (value, timestamp, offset, ...) or a Kafka topic. Batch outputs
are Parquet (reports) or the job's text/CSV layout.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from racestream.options import ClickOptions, TelemetryOptions
from racestream.plans import jobs
from racestream.schemas import CLICK_SCHEMA
from racestream.session import ship_package
from racestream.sources.clicks import read_clicks
from racestream.sources.telemetry import read_kafka, read_kafka_files
from racestream.streaming.telemetry import start_to_files

TELEMETRY_JOBS = {
    "monitor-gap": jobs.monitor_gap_job,
    "find-follower": jobs.find_follower_job,
    "measure-gap": jobs.measure_gap_job,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="racestream")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clicks")
    c.add_argument("--input", required=True)
    c.add_argument("--format", default="parquet")
    c.add_argument("--output", required=True)
    c.add_argument("--properties")
    c.add_argument("--stream", action="store_true")
    c.add_argument("--checkpoint")
    c.add_argument("--available-now", action="store_true")
    for name in (*TELEMETRY_JOBS, "status", "gap-csv", "dump-bytes"):
        t = sub.add_parser(name)
        src = t.add_mutually_exclusive_group(required=True)
        src.add_argument("--input")
        src.add_argument("--kafka")
        t.add_argument("--topic", default=TelemetryOptions().topic)
        t.add_argument("--output", required=True)
        t.add_argument("--target", action="append")
        t.add_argument("--targets", help="Parquet table (session_id, target_id) instead of --target")
        t.add_argument("--properties")
        t.add_argument("--idle-timeout")
        t.add_argument("--stream", action="store_true")
        t.add_argument("--checkpoint")
        t.add_argument("--available-now", action="store_true")
    return p


def _messages(spark: SparkSession, args, opts: TelemetryOptions):
    if args.kafka:
        return read_kafka(spark, opts, stream=args.stream)
    return read_kafka_files(spark, args.input, stream=args.stream)


def run(argv: list[str], spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"racestream-{args.job}").getOrCreate()
    ship_package(spark)
    if args.stream and not args.checkpoint and args.job != "clicks":
        raise SystemExit("--stream needs --checkpoint")

    if args.job == "clicks":
        opts = ClickOptions.from_properties(args.properties)
        clicks = read_clicks(spark, args.input, fmt=args.format, stream=args.stream, schema=CLICK_SCHEMA)
        if args.stream:
            jobs.click_job_stream(clicks, opts, args.output, args.checkpoint,
                                  available_now=args.available_now).awaitTermination()
        else:
            jobs.click_job_batch(clicks, opts, args.output)
        return

    given = {"target_ids": tuple(args.target) if args.target else None, "targets_path": args.targets,
             "bootstrap_servers": args.kafka, "idle_timeout": args.idle_timeout}
    topts = TelemetryOptions.from_properties(args.properties, topic=args.topic,
                                             **{k: v for k, v in given.items() if v is not None})
    msgs = _messages(spark, args, topts)
    if args.job == "dump-bytes":
        if args.stream:
            from racestream.operators.telemetry import dump_bytes
            start_to_files(dump_bytes(msgs).selectExpr("hex AS value"), args.output, args.checkpoint,
                           fmt="text", available_now=args.available_now).awaitTermination()
        else:
            jobs.validate_bytes_job(msgs, args.output)
    elif args.job == "gap-csv":
        if args.stream:
            jobs.monitor_gap_csv_stream(msgs, topts, args.output, args.checkpoint,
                                        available_now=args.available_now).awaitTermination()
        else:
            jobs.monitor_gap_csv_job(msgs, topts, args.output)
    elif args.job == "status":
        out = jobs.status_job(msgs)
        if args.stream:
            jobs.status_stream(msgs, args.checkpoint, path=args.output, fmt="parquet",
                               available_now=args.available_now).awaitTermination()
        else:
            out.write.mode("overwrite").parquet(args.output)
    elif args.stream:
        starts = {"monitor-gap": jobs.monitor_gap_stream, "measure-gap": jobs.measure_gap_stream,
                  "find-follower": jobs.find_follower_stream}
        starts[args.job](msgs, topts, args.checkpoint, path=args.output, fmt="parquet",
                         available_now=args.available_now).awaitTermination()
    else:
        TELEMETRY_JOBS[args.job](msgs, topts).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    run(sys.argv[1:])
