"""Command line: ``python -m rowcast run -c <config file or folder> ...``.

Starts one streaming pipeline per configuration (see :mod:`rowcast.plans.config`)
over a change-log folder, each with its own checkpoint, output, state and
metrics folder under ``--out`` / ``--checkpoint``.  A pipeline whose checkpoint is
gone resumes from its saved state, unless that is ahead of the log.  ``--once``
processes what is there and stops (``availableNow``); otherwise it runs until
stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rowcast.plans.config import load_configs
from rowcast.session import configure
from rowcast.sinks.fanout import kafka_writer
from rowcast.sources.changelog import FILES_PER_TRIGGER, stream_log
from rowcast.streaming.stream import start_pipeline


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rowcast")
    sub = p.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="run the pipelines of a configuration file or folder")
    run.add_argument("-c", "--config", required=True)
    run.add_argument("--log", required=True, help="change-log folder (parquet unless --format)")
    run.add_argument("--format", default="parquet")
    run.add_argument("--out", required=True)
    run.add_argument("--checkpoint", required=True)
    run.add_argument("--pk", default=None, help="comma-separated primary-key columns (else the log's pk_columns)")
    run.add_argument("--files-per-trigger", type=int, default=FILES_PER_TRIGGER)
    run.add_argument("--trigger", default=None, help="processing-time trigger, e.g. '10 seconds'")
    run.add_argument("--once", action="store_true")
    run.add_argument("--sink", choices=("files", "kafka"), default="files",
                     help="kafka: the brokers of [kafka_sink] addr (needs the connector); files: under --out")
    run.add_argument("--ui", action="store_true", help="keep the Spark web UI (off by default)")
    return p


def main(argv: list[str] | None = None) -> list:
    args = parser().parse_args(argv)
    b = SparkSession.builder.appName("rowcast")
    if not args.ui:
        b = b.config("spark.ui.enabled", "false")
    spark = configure(b.getOrCreate())
    schema = spark.read.format(args.format).load(args.log).schema
    pk = [c for c in args.pk.split(",") if c] if args.pk else None
    queries = []
    for cfg in load_configs(args.config, pk=pk):
        name = cfg.spec.name
        stream = stream_log(spark, args.log, schema, fmt=args.format, max_files_per_trigger=args.files_per_trigger)
        if args.sink == "kafka" and not cfg.kafka_servers:
            raise SystemExit(f"pipeline {name!r} has no [kafka_sink] addr")
        writer = kafka_writer(cfg.kafka_servers) if args.sink == "kafka" else None
        queries.append(start_pipeline(
            cfg.spec, stream, out=f"{args.out}/{name}/records", checkpoint=f"{args.checkpoint}/{name}",
            writer=writer, source=spark.read.format(args.format).schema(schema).load(args.log), state_path=f"{args.out}/{name}/{cfg.state_name}", metrics_path=f"{args.out}/{name}/metrics",
            available_now=args.once, processing_time=None if args.once else args.trigger,
            query_name=f"rowcast_{name}"))
    if args.once:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
    else:
        spark.streams.awaitAnyTermination()
    return queries


if __name__ == "__main__":
    main()
