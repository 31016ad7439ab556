"""Command-line jobs, for ``spark-submit``: train a model, watch packets, print the overview.

    python -m flowlake.plans.jobs train --csv FOLDER --cache TABLE --model PATH --metrics PATH
    python -m flowlake.plans.jobs monitor --packets FOLDER --model PATH --alerts TABLE
    python -m flowlake.plans.jobs overview --scored TABLE --out PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.operators import soc
from flowlake.plans import monitoring, training
from flowlake.runtime import release_scratch, stored
from flowlake.sources import csv_flows, metrics_json
from flowlake.streaming import run, sources


def train(spark: SparkSession, args) -> None:
    """Read (or reuse) the clean table, split, fit, evaluate, save the model and its metrics."""
    data = csv_flows.dataset_cache(spark, args.cache, args.csv)
    if args.sample_per_file:
        # The documented bound on the rows a model is fitted on; 0 takes all.
        data = csv_flows.sample_of_cache(data, args.sample_per_file)
    rows = monitoring.with_model_features(data).select(*monitoring.MODEL_FEATURES, "label")
    _, metrics = training.train_and_evaluate(
        rows, monitoring.MODEL_FEATURES, [*monitoring.MODEL_FEATURES, "label"], args.model_type, args.model
    )
    metrics = stored(metrics, "metrics")
    names = ["accuracy", "precision", "recall", "f1"]
    document = metrics.select("model_type", F.struct(*names).alias("metrics"), "tn", "fp", "fn", "tp", "train_samples", "test_samples")
    metrics_json.write_metrics_json(document, args.metrics)


def monitor(spark: SparkSession, args) -> None:
    """Score the flows of a packet stream and append the alerts. Without an interval: what is there."""
    packets = sources.packet_stream(spark, args.packets, args.max_files, args.format)
    model = training.load_model(args.model)
    alerts = monitoring.monitor(packets, model, args.delay, args.threshold, timeout_s=args.timeout)
    run.append_to(alerts, args.alerts, args.checkpoint, args.interval).awaitTermination()


def overview(spark: SparkSession, args) -> None:
    metrics_json.write_metrics_json(soc.soc_overview(spark.read.parquet(args.scored), args.threshold), args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("train")
    for name in ("--csv", "--cache", "--model", "--metrics"):
        job.add_argument(name, required=True)
    job.add_argument("--model-type", default="gbt")
    job.add_argument("--sample-per-file", type=int, default=S.SAMPLE_PER_FILE)
    job.set_defaults(job=train)

    job = jobs.add_parser("monitor")
    for name in ("--packets", "--model", "--alerts"):
        job.add_argument(name, required=True)
    job.add_argument("--format", default="parquet", choices=["parquet", "json"])
    job.add_argument("--max-files", type=int)
    job.add_argument("--delay", default="1 minute")
    job.add_argument("--timeout", type=int, default=S.FLOW_TIMEOUT_S)
    job.add_argument("--threshold", type=float, default=S.ALERT_THRESHOLD)
    job.add_argument("--checkpoint")
    job.add_argument("--interval")
    job.set_defaults(job=monitor)

    job = jobs.add_parser("overview")
    for name in ("--scored", "--out"):
        job.add_argument(name, required=True)
    job.add_argument("--threshold", type=float, default=S.ALERT_THRESHOLD)
    job.set_defaults(job=overview)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("flowlake").getOrCreate()
    args.job(spark, args)
    if args.job is not monitor:  # a stream may go on from its checkpoint
        release_scratch(spark)


if __name__ == "__main__":
    main()
