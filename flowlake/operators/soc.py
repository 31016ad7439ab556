"""Security-operations figures over a table of scored flows.

Everything here is an aggregate with map-side combine, a bounded top-k, or a projection: nothing
is windowed over the scored rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.operators.flows import with_micros
from flowlake.runtime import checked_lookup, stored

SEVERITIES = ["critical", "medium", "low"]
PROTOCOL_NAMES = ["TCP", "UDP", "ICMP"]
DIMENSIONS = ["src_ip", "dst_port", "dst_ip"]


def alert_filter(
    scored: DataFrame,
    threshold: float = S.ALERT_THRESHOLD,
    rule: str = "ge",
    label: str | None = None,
) -> DataFrame:
    label_col = None if label is None else F.col(label)
    return scored.where(X.is_alert(F.col("confidence"), threshold, rule, label_col))


def with_severity(df: DataFrame, critical: float = S.CRITICAL_CUT, medium: float = S.MEDIUM_CUT) -> DataFrame:
    return df.withColumn("severity", X.severity(F.col("confidence"), critical, medium))


def alert_projection(alerts: DataFrame) -> DataFrame:
    """The record shown for one alert."""
    return alerts.select(
        "flow_id",
        F.date_format("ts", "HH:mm:ss").alias("time"),
        "src_ip",
        "dst_ip",
        F.col("dst_port").alias("port"),
        X.protocol_name(F.col("protocol"), unknown_as="TCP").alias("protocol"),
        F.col("attack_type").alias("type"),
        F.round(F.col("confidence") * 100, 1).alias("confidence"),
        X.severity(F.col("confidence")).alias("severity"),
    )


def clamp_controls(controls: DataFrame) -> DataFrame:
    """Alert threshold and batch size forced into their bounds."""
    return controls.withColumns(
        {
            "threshold": X.clamp(F.col("threshold").cast("double"), *S.THRESHOLD_BOUNDS),
            "batch_size": X.clamp(F.col("batch_size").cast("int"), *S.BATCH_BOUNDS),
        }
    )


def apply_controls(scored: DataFrame, controls: DataFrame) -> DataFrame:
    """Alerts at the threshold that is set now. ``controls`` has one row; its bounds apply."""
    threshold = clamp_controls(controls).select("threshold").scalar()
    return scored.where(X.is_alert(F.col("confidence"), threshold))


def _total_aggregates(df: DataFrame, alert: Column) -> list[Column]:
    packets = F.sum("packets") if "packets" in df.columns else F.count(F.lit(1))
    return [
        F.count(F.lit(1)).alias("total_flows"),
        F.count_if(alert).alias("total_alerts"),
        F.coalesce(packets, F.lit(0)).alias("total_packets"),
        F.coalesce((F.max("us") - F.min("us")) / 1e6, F.lit(0.0)).alias("elapsed_s"),
    ]


def traffic_totals(scored: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """One row: flows, alerts, detection rate %, elapsed seconds, flows and packets per second.

    ``packets`` is used when the table has it; otherwise a scored flow counts as one packet.
    """
    df = with_micros(scored)
    return with_rates(df.agg(*_total_aggregates(df, X.is_alert(F.col("confidence"), threshold))))


def with_rates(totals: DataFrame) -> DataFrame:
    seconds = F.greatest(F.col("elapsed_s"), F.lit(0.001))
    return totals.withColumns(
        {
            "detection_rate": F.col("total_alerts") / F.greatest(F.col("total_flows"), F.lit(1)) * 100,
            "throughput": F.col("total_flows") / seconds,
            "packets_per_sec": F.col("total_packets") / seconds,
        }
    )


def display_rounding(totals: DataFrame) -> DataFrame:
    digits = {"throughput": 1, "packets_per_sec": 0, "detection_rate": 1, "elapsed_s": 1}
    return totals.withColumns({c: F.round(c, k) for c, k in digits.items() if c in totals.columns})


def _dense_counts(df: DataFrame, name: str, values: list) -> DataFrame:
    """Rows per value of ``name``, zeros included, with the share of the total in percent."""
    spark = df.sparkSession
    kinds = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    dense = kinds.join(counts, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))
    # One row per listed value: the window has len(values) rows.
    total = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))
    return dense.withColumn("share_pct", F.col("n") / total * 100)


def protocol_split(scored: DataFrame) -> DataFrame:
    named = scored.select(X.protocol_name(F.col("protocol"), unknown_as="ICMP").alias("protocol"))
    return _dense_counts(named, "protocol", PROTOCOL_NAMES)


def severity_counts(alerts: DataFrame) -> DataFrame:
    return _dense_counts(with_severity(alerts).select("severity"), "severity", SEVERITIES)


def attack_type_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("attack_type").agg(F.count(F.lit(1)).alias("n"))


def alert_counts_by_dim(alerts: DataFrame) -> DataFrame:
    """Alerts per source, target port and target, in one pass; ``first_us`` breaks later ties."""
    pairs = F.array(
        *[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in DIMENSIONS]
    )
    return (
        with_micros(alerts)
        .select("us", F.inline(pairs))
        .groupBy("dim", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"))
    )


def top_talkers(alerts: DataFrame, k: dict[str, int] | None = None) -> DataFrame:
    """Most frequent values per dimension; ties go to the one seen first, then the smaller one.

    The rank limit is applied before the shuffle as well, so k rows per task and dimension move.
    """
    k = k or S.TOP_K
    order = Window.partitionBy("dim").orderBy(F.desc("n"), "first_us", "value")
    limit = F.lit(0)
    for dim, n in k.items():
        limit = F.when(F.col("dim") == dim, n).otherwise(limit)
    ranked = alert_counts_by_dim(alerts).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("rank") <= max(k.values())) & (F.col("rank") <= limit)).drop("first_us")


def attack_heatmap(alerts: DataFrame) -> DataFrame:
    """Alerts by weekday (0 = Monday) and hour: always 7 x 24 rows."""
    counts = alerts.groupBy(
        X.weekday_index(F.col("ts")).alias("day"), F.hour("ts").alias("hour")
    ).agg(F.count(F.lit(1)).alias("n"))
    cell = F.col("id")
    grid = alerts.sparkSession.range(7 * 24).select(
        F.floor(cell / 24).cast("int").alias("day"), (cell % 24).cast("int").alias("hour")
    )
    return grid.join(counts, ["day", "hour"], "left").select(
        "day", "hour", F.coalesce("n", F.lit(0)).alias("n")
    )


def heatmap_intensity(heatmap: DataFrame) -> DataFrame:
    """Each of the 168 cells against the fullest one, and its colour band."""
    fullest = F.greatest(F.max("n").over(Window.partitionBy()), F.lit(1))
    v = F.col("intensity")
    band = F.when(v < 0.1, "none").when(v < 0.3, "low").when(v < 0.6, "mid").otherwise("high")
    return heatmap.withColumn("intensity", F.col("n") / fullest).withColumn("band", band)


def confidence_histogram(scored: DataFrame, bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [0, 1]; exactly 1.0 belongs to the last one, empty bins are kept."""
    index = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    counts = scored.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def newest(scored: DataFrame, n: int = S.ROLLING_LENGTH) -> DataFrame:
    """The last ``n`` rows by time: a bounded heap per task, not a sort of the table."""
    return scored.orderBy(F.desc("ts"), F.desc("flow_id")).limit(n)


def rolling_latency(scored: DataFrame, n: int = S.ROLLING_LENGTH) -> DataFrame:
    """avg and p95 of the last ``n`` latencies, one decimal, zeros when empty."""
    return newest(scored, n).agg(
        F.coalesce(F.round(F.avg("latency_ms"), 1), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(F.round(F.percentile("latency_ms", F.lit(0.95)), 1), F.lit(0.0)).alias("p95_latency_ms"),
    )


def rolling_confidence(scored: DataFrame, n: int = S.ROLLING_LENGTH) -> DataFrame:
    return confidence_histogram(newest(scored, n))


def recent_alerts(
    alerts: DataFrame, kept: int = S.ALERTS_KEPT, shown: int = S.ALERTS_SHOWN
) -> DataFrame:
    """Newest alerts first."""
    return alert_projection(newest(alerts, min(kept, shown)))


def mean_alert_confidence(scored: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    above = F.when(F.col("confidence") > threshold, F.col("confidence"))
    return scored.agg(F.coalesce(F.avg(above), F.lit(0.0)).alias("mean_confidence"))


def with_threat_status(df: DataFrame) -> DataFrame:
    """Badge and level from ``critical``, ``medium`` (alert counts) and ``detection_rate``."""
    crit, med, rate = F.col("critical"), F.col("medium"), F.col("detection_rate")
    worst = (crit > 15) | (rate > 25)
    raised = (crit > 5) | (med > 15) | (rate > 12)
    return df.withColumns(
        {
            "system_status": F.when(worst, "critical").when(raised, "elevated").otherwise("nominal"),
            "threat_level": F.when(worst, "High").when(raised, "Medium").otherwise("Low"),
        }
    )


def _counters(scored: DataFrame, threshold: float) -> DataFrame:
    """Totals, severity counters and, on labelled flows, mistakes: one pass over the scored rows."""
    conf = F.col("confidence")
    alert = X.is_alert(conf, threshold)
    df = with_micros(scored)
    aggregates = _total_aggregates(df, alert)
    aggregates += [F.count_if(alert & (X.severity(conf) == s)).alias(s) for s in SEVERITIES]
    if "y_true" in df.columns:
        benign = F.col("y_true") == 0
        aggregates += [F.count_if(benign & alert).alias("fp"), F.count_if(benign & ~alert).alias("tn")]
    return with_rates(df.agg(*aggregates))


def threat_status(scored: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    return with_threat_status(_counters(scored, threshold)).select(
        "critical", "medium", "detection_rate", "system_status", "threat_level"
    )


def timeline(scored: DataFrame, tick_s: int = 1, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """Normal and attack flows per time bucket; the label counts seconds from the first bucket."""
    alert = X.is_alert(F.col("confidence"), threshold)
    buckets = scored.groupBy(F.window("ts", f"{tick_s} seconds")).agg(
        F.count_if(~alert).alias("normal"), F.count_if(alert).alias("attack")
    )
    # One row per bucket, stored: the scored table is read once.
    buckets = stored(buckets.select(F.unix_micros("window.start").alias("start_us"), "normal", "attack"), "timeline")
    first = buckets.agg(F.min("start_us")).scalar()
    seconds = F.floor((F.col("start_us") - first) / 1_000_000).cast("bigint")
    return buckets.withColumn("label", F.concat(seconds.cast("string"), F.lit("s")))


def last_ticks(buckets: DataFrame, n: int = S.TIMELINE_BUCKETS) -> DataFrame:
    """The newest ``n`` buckets in time order."""
    return buckets.orderBy(F.desc("start_us")).limit(n).orderBy("start_us")


def alert_detail(alerts: DataFrame, flows: DataFrame, scored: DataFrame) -> DataFrame:
    """Each alert with the features of its flow and the number of flows from the same source.

    ``flow_id`` is unique on both sides. The source counts are aggregated before they are joined,
    one row per source, so a busy source multiplies nothing. They are broadcast when their counted
    number allows; beyond that, adaptive execution splits the rows of a busy source.
    """
    features = flows.select("flow_id", *[f for f in S.FLOW_FEATURES if f != "dst_port"])
    related = scored.groupBy("src_ip").agg(F.count(F.lit(1)).alias("related_flows"))
    related = checked_lookup(related, "sources")
    return alert_projection(alerts).join(features, "flow_id", "left").join(related, "src_ip", "left")


def soc_overview(scored: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """Every top-level figure as one row: totals, rates, latency, severities, status, mistakes.

    Two passes: one aggregate for all counters, one bounded top-n for the rolling latency, which
    joins the row as a scalar subquery.
    """
    latency = rolling_latency(scored).select(F.struct("avg_latency_ms", "p95_latency_ms")).scalar()
    row = with_threat_status(_counters(scored, threshold)).withColumn("latency", latency)
    if "fp" in row.columns:
        rate = X.ratio(F.col("fp"), F.col("fp") + F.col("tn")) * 100
        row = row.withColumn("false_positive_rate", F.round(rate, 1)).drop("fp", "tn")
    return (
        display_rounding(row)
        .withColumns(
            {
                "avg_latency_ms": F.col("latency.avg_latency_ms"),
                "p95_latency_ms": F.col("latency.p95_latency_ms"),
                "alert_threshold": F.lit(threshold),
            }
        )
        .drop("latency")
    )


def with_model_quality(overview: DataFrame, metrics: DataFrame, batch_size: int = S.BATCH_SIZE) -> DataFrame:
    """The overview row with the model's quality (``ai_...`` in percent, one row) and the batch size in force.

    Without a row of metrics the figures are 0.
    """
    names = ["ai_accuracy", "ai_f1", "ai_recall", "ai_precision"]
    found = metrics.agg(F.struct(*[F.max(n).alias(n) for n in names])).scalar()
    row = overview.withColumn("__ai", found)
    quality = {n: F.round(F.coalesce(F.col(f"__ai.{n}"), F.lit(0.0)), 2) for n in names}
    return row.withColumns(quality).withColumn("batch_size", F.lit(batch_size)).drop("__ai")
