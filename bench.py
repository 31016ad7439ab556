"""Time the headline queries; prints one JSON line.

Every query is run to the end (all rows, into a sink that discards them) twice; the second time is
reported, so that the figures compare work and not class loading.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flowlake.plans import catalog, training  # noqa: E402
from flowlake.plans import tables as T  # noqa: E402

HEADLINE = [
    "flow_features", "flow_features_hot_keys", "packet_direction", "assemble_features", "alert_detail",
    "soc_overview", "top_talkers", "attack_heatmap", "timeline", "confidence_histogram",
    "latency_summary", "latency_summary_overall", "merge_worker_summaries", "count_window_latency",
    "label_distribution", "stratified_sample", "stratified_split", "encode_categoricals", "standardize",
    "read_flow_csv_dir", "classification_metrics",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(step) -> float:
    start = time.perf_counter()
    step()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    for name in HEADLINE:
        timed(lambda: run(queries[name](spark, sf_dir)))
        seconds[name] = round(timed(lambda: run(queries[name](spark, sf_dir))), 3)

    rows = T.trainable(spark, sf_dir)
    n_rows, n_packets = rows.count(), T.table(spark, sf_dir, "events").count()
    fit = lambda: training.fit(rows, T.TRAINABLE_FEATURES, "gbt", maxIter=10)
    model = fit()
    seconds["fit_gbt_10_trees"] = round(timed(fit), 3)
    run(training.score(model, rows))
    seconds["score_table"] = round(timed(lambda: run(training.score(model, rows))), 3)
    cached = training._spread(rows).cache()
    cached.count()
    run(training.score(model, cached))
    seconds["score_cached_table"] = round(timed(lambda: run(training.score(model, cached))), 3)
    rates = {
        "cached_rows_scored_per_sec": round(n_rows / seconds["score_cached_table"]),
        "packets_to_flows_per_sec": round(n_packets / seconds["flow_features"]),
        "rows_scored_per_sec": round(n_rows / seconds["score_table"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rates": rates,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
