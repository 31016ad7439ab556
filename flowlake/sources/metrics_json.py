"""Metrics documents: written as JSON, read back as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The sections of a result document.
BATCH, MODES, SCALING, DEVICES = (
    "test1_inference_batch",
    "test2_pipeline_comparison",
    "test5_scalability",
    "test6_cpu_gpu",
)
LATENCIES = ["avg_latency_ms", "p50_latency_ms", "p95_latency_ms", "p99_latency_ms"]

_D = T.DoubleType()
_RESULT = T.StructType(
    [T.StructField(n, _D) for n in ["throughput", "throughput_mean", *LATENCIES]]
)
_BY_CONFIG = T.MapType(T.StringType(), _RESULT)
_BY_GROUP = T.MapType(T.StringType(), _BY_CONFIG)
DOCUMENT = T.StructType(
    [
        T.StructField(BATCH, _BY_CONFIG),
        T.StructField(MODES, _BY_CONFIG),
        T.StructField(SCALING, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
        T.StructField(DEVICES, _BY_GROUP),
    ]
)


def as_map(results: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """Aggregated results, one row per configuration, as one map column ``document``."""
    entry = F.struct(F.col(key).cast("string"), F.struct(*value_cols))
    return results.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("document"))


def as_nested_map(results: DataFrame, group: str, key: str, value_cols: list[str]) -> DataFrame:
    inner = F.struct(F.col(key).cast("string"), F.struct(*value_cols))
    per_group = results.groupBy(group).agg(F.map_from_entries(F.sort_array(F.collect_list(inner))).alias("m"))
    outer = F.struct(F.col(group).cast("string").alias("g"), F.col("m"))
    return per_group.agg(F.map_from_entries(F.collect_list(outer)).alias("document"))


def write_metrics_json(df: DataFrame, path: str) -> None:
    """One JSON object per row: metrics rows, run summaries, whole documents."""
    df.write.mode("overwrite").json(path)


def _fraction(col, digits: int = 0):
    return F.round(F.coalesce(col, F.lit(0.0)), digits)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """A result document as (``section``, ``name``, ``config``, ``value``): rounded figures, 0 where absent.

    Sections: throughput by mode, latencies by mode, throughput by batch size and its maximum,
    throughput by worker count, throughput by device and batch size.
    """
    doc = spark.read.schema(DOCUMENT).json(path, multiLine=True)
    speed = F.coalesce("v.throughput_mean", "v.throughput")

    modes = spark.range(1).select(
        F.explode(F.array(*[F.lit(m) for m in ["single_thread", "multi_thread", "multi_process"]])).alias("name")
    )
    found = doc.select(F.explode_outer(MODES).alias("name", "v"))
    by_mode = modes.join(found, "name", "left")
    pipeline = by_mode.select(
        F.lit("pipeline").alias("section"), "name", F.lit("").alias("config"), _fraction(F.col("v.throughput")).alias("value")
    )
    latency = by_mode.select(
        F.lit("latency").alias("section"),
        "name",
        F.inline(F.array(*[F.struct(F.lit(c).alias("config"), _fraction(F.col(f"v.{c}"), 2).alias("value")) for c in LATENCIES])),
    )
    batches = doc.select(F.explode(BATCH).alias("config", "v"))
    scaling = batches.select(
        F.lit("batch_scaling").alias("section"), F.lit("").alias("name"), "config", _fraction(speed).alias("value")
    )
    fastest = batches.agg(_fraction(F.max(speed)).alias("value")).select(
        F.lit("max_batch_throughput").alias("section"), F.lit("").alias("name"), F.lit("").alias("config"), "value"
    )
    # Beside the two maps by worker count this section holds one flat baseline, so values stay text here.
    counted = doc.select(F.explode(SCALING).alias("name", "m")).where(F.col("name").isin("multi_thread", "multi_process"))
    workers = counted.select("name", F.explode("m").alias("config", "json")).select(
        F.lit("scalability").alias("section"),
        "name",
        "config",
        _fraction(F.get_json_object("json", "$.throughput").cast("double")).alias("value"),
    )
    devices = (
        doc.select(F.explode(DEVICES).alias("name", "m"))
        .select("name", F.explode("m").alias("config", "v"))
        .select(F.lit("cpu_gpu").alias("section"), "name", "config", _fraction(F.col("v.throughput")).alias("value"))
    )
    merged = pipeline
    for part in (latency, scaling, fastest, workers, devices):
        merged = merged.unionByName(part)
    return merged


def read_training_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Accuracy, F1, recall and precision of a training run in percent, 0 where absent."""
    names = ["accuracy", "f1", "recall", "precision"]
    metrics = T.StructType([T.StructField(n, _D) for n in names])
    doc = spark.read.schema(T.StructType([T.StructField("metrics", metrics)])).json(path, multiLine=True)
    return doc.select(*[(F.coalesce(f"metrics.{n}", F.lit(0.0)) * 100).alias(f"ai_{n}") for n in names])
