"""Latency and throughput telemetry: summaries, repeats, baselines, devices, best settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import quantiles as Q
from flowlake.functions.ranks import global_row_number
from flowlake.runtime import stored

PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def latency_summary(
    df: DataFrame, value: str = "latency_ms", group: list[str] | None = None, exact: bool = True
) -> DataFrame:
    """n, avg, p50, p95, p99, min, max; zeros when there is nothing to summarise."""
    summarise = Q.distribution if exact else Q.approximate_distribution
    return summarise(df, value, PERCENTILES, group)


def throughput(df: DataFrame, group: list[str], value: str = "latency_ms") -> DataFrame:
    """Predictions, elapsed seconds and predictions per second of each configuration."""
    elapsed = F.sum(value) / 1000.0
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("predictions"),
        elapsed.alias("elapsed_s"),
        (F.count(F.lit(1)) / F.greatest(elapsed, F.lit(0.001))).alias("throughput"),
        F.avg(value).alias("avg_latency_ms"),
    )


def worker_summaries(df: DataFrame, run: list[str], worker: str = "worker_id") -> DataFrame:
    """What each worker of a run reports."""
    summary = Q.distribution(df, "latency_ms", PERCENTILES, [*run, worker], total="elapsed_s")
    return summary.withColumn("elapsed_s", F.col("elapsed_s") / 1000.0).withColumnRenamed("n", "predictions")


def worker_sketches(df: DataFrame, run: list[str], worker: str = "worker_id") -> DataFrame:
    """What each worker of a run reports, with a sketch in place of percentiles: mergeable without the rows."""
    return Q.sketches(df, "latency_ms", [*run, worker])


def merge_worker_sketches(sketches: DataFrame, run: list[str]) -> DataFrame:
    """Roll sketch rows up to the run: percentiles of all its predictions within the sketch's rank error."""
    return Q.sketched_distribution(Q.merged_sketches(sketches, run), PERCENTILES)


def merge_worker_summaries(summaries: DataFrame, run: list[str]) -> DataFrame:
    """Roll worker reports up to the run: means of averages and medians, the worst of the tails.

    Workers run side by side, so the run lasts as long as its slowest worker.
    """
    elapsed = F.max("elapsed_s")
    return summaries.groupBy(*run).agg(
        F.sum("predictions").alias("predictions"),
        elapsed.alias("elapsed_s"),
        (F.sum("predictions") / F.greatest(elapsed, F.lit(0.001))).alias("throughput"),
        F.avg("avg").alias("avg"),
        F.avg("p50").alias("p50"),
        F.max("p95").alias("p95"),
        F.max("p99").alias("p99"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def average_runs(runs: DataFrame, config: str, metrics: list[str]) -> DataFrame:
    """Mean and population deviation of every metric over the repeats of a configuration, and the
    speedup of the first metric over the smallest configuration."""
    means = [F.avg(m).alias(f"{m}_mean") for m in metrics]
    spreads = [F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias(f"{m}_std") for m in metrics]
    # One row per configuration, stored: the runs are not worked out again for the base.
    grouped = stored(runs.groupBy(config).agg(*means, *spreads), "runs")
    base = grouped.agg(F.min_by(f"{metrics[0]}_mean", config)).scalar()
    return grouped.withColumn("speedup", _over(F.col(f"{metrics[0]}_mean"), base))


def _over(value: Column, base: Column) -> Column:
    return value / F.greatest(base, F.lit(1.0))


def speedup_vs_baseline(results: DataFrame, is_baseline: Column, workers: str | None = None) -> DataFrame:
    """Throughput against that of the baseline rows taken together; per-worker efficiency where
    ``workers`` is given.

    The aggregated rows are stored, so the telemetry is not read again for the baseline.
    """
    results = stored(results, "results")
    of_base = lambda c: F.sum(F.when(is_baseline, F.col(c)))
    base = results.agg(of_base("predictions") / F.greatest(of_base("elapsed_s"), F.lit(0.001))).scalar()
    df = results.withColumn("speedup", _over(F.col("throughput"), base))
    return df if workers is None else df.withColumn("efficiency", F.col("speedup") / F.col(workers))


def mode_rating(results: DataFrame) -> DataFrame:
    s = F.col("speedup")
    return results.withColumn(
        "rating", F.when(s >= 1, "Optimal").when(s >= 0.5, "Acceptable").otherwise("Suboptimal")
    )


def device_speedup(results: DataFrame, config: str = "batch_size") -> DataFrame:
    """GPU against CPU where both were measured: both sides of the match in one grouping."""

    def of(device: str) -> Column:
        return F.max(F.when(F.col("device") == device, F.col("throughput"))).alias(device)

    both = results.groupBy(config).agg(of("cpu"), of("gpu")).dropna(subset=["cpu", "gpu"])
    return both.withColumn("speedup", _over(F.col("gpu"), F.col("cpu")))


def config_union_compare(left: DataFrame, right: DataFrame, config: str, names: tuple[str, str]) -> DataFrame:
    """Two result sets side by side on the union of their configurations, missing figures 0."""
    a, b = names
    figures = ["throughput", "speedup", "efficiency_pct"]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            config,
            F.col("throughput").alias(f"{name}_throughput"),
            F.col("speedup").alias(f"{name}_speedup"),
            (F.col("efficiency") * 100).alias(f"{name}_efficiency_pct"),
        )

    joined = side(left, a).join(side(right, b), config, "full_outer")
    filled = [F.coalesce(f"{n}_{f}", F.lit(0.0)).alias(f"{n}_{f}") for n in names for f in figures]
    out = joined.select(F.col(config).cast("int").alias(config), *filled)
    ratio = _over(F.col(f"{b}_throughput"), F.col(f"{a}_throughput"))
    return out.withColumn("ratio", ratio).orderBy(config)


def best_config(results: DataFrame, config: str) -> DataFrame:
    """Configuration of the highest throughput and of the lowest latency; ties: the smallest."""
    fast = F.max(F.struct(F.col("throughput"), (-F.col(config)).alias("c")))
    calm = F.min(F.struct(F.col("avg_latency_ms"), F.col(config).alias("c")))
    return results.agg(fast.alias("fast"), calm.alias("calm")).select(
        (-F.col("fast.c")).alias("best_throughput_config"),
        F.col("fast.throughput").alias("max_throughput"),
        F.col("calm.c").alias("best_latency_config"),
        F.col("calm.avg_latency_ms").alias("min_latency_ms"),
    )


def count_window_latency(
    df: DataFrame, order: list[str], us: str = "us", size: int = S.BATCH_SIZE
) -> DataFrame:
    """Tumbling windows of ``size`` records in arrival order; a record waits until its window is
    full. The last window is flushed as it is."""
    numbered = global_row_number(df, [F.col(c) for c in order])
    batch = F.floor((F.col("rn") - 1) / size).cast("bigint")
    closes = F.max(us).over(Window.partitionBy("batch"))
    return (
        numbered.withColumn("batch", batch)
        .withColumn("latency_us", closes - F.col(us))
        .drop("rn")
    )


def contiguous_slices(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """``k`` runs of equal length in the given order; the last one takes the remainder."""
    numbered = global_row_number(df, [F.col(c) for c in order])
    total = numbered.agg(F.max("rn")).scalar()
    chunk = F.greatest(F.floor(total / F.lit(k)), F.lit(1))
    part = F.least(F.floor((F.col("rn") - 1) / chunk), F.lit(k - 1)).cast("int")
    return numbered.withColumn("slice", part)
