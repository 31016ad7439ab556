"""Registered queries: security-operations figures over scored flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.operators import flows as O
from flowlake.operators import quality as Q
from flowlake.operators import soc
from flowlake.plans import catalog_flows as CF
from flowlake.plans import tables as T
from flowlake.runtime import scratch_path
from flowlake.sources import metrics_json as J

_TICK_S = 21_600  # the events cover 30 days: 120 buckets of six hours


def _alerts(spark, sf_dir):
    return soc.alert_filter(T.scored(spark, sf_dir))


def _judged(spark, sf_dir):
    alert = X.is_alert(F.col("confidence"))
    return T.scored(spark, sf_dir).withColumn("y_pred", alert.cast("int"))


def _micros(df):
    return O.with_micros(df).drop("ts")


def protocol_name(spark, sf_dir):
    p = F.col("l_linenumber") * 1 + F.when(F.col("l_linenumber") > 5, 11).otherwise(0)
    return T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        p.alias("protocol"),
        X.protocol_name(p, unknown_as="ICMP").alias("counted_as"),
        X.protocol_name(p, unknown_as="TCP").alias("shown_as"),
    )


def severity(spark, sf_dir):
    df = soc.with_severity(T.scored(spark, sf_dir))
    demo = X.severity(F.col("confidence"), medium=0.80)
    return df.select("flow_id", "severity", demo.alias("severity_080"))


def alert_filter(spark, sf_dir):
    """All three rules side by side on every scored flow."""
    df = _judged(spark, sf_dir)
    c = F.col("confidence")
    hard = (c > 0.5).cast("int")
    return df.select(
        "flow_id",
        X.is_alert(c).alias("at_or_above"),
        X.is_alert(c, rule="gt").alias("above"),
        X.is_alert(c, rule="label_and_gt", label=hard).alias("labelled_and_above"),
    )


def alerts(spark, sf_dir):
    return _alerts(spark, sf_dir).select("flow_id", "src_ip", "dst_ip", "dst_port")


def probability_pair(spark, sf_dir):
    """Logits to class probabilities and the hard label at the alert threshold."""
    p = X.logistic((F.col("l_quantity") - 25.0) / 5.0)
    pair = X.probability_pair(p)
    return T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.round(pair[0], 9).alias("p_normal"),
        F.round(pair[1], 9).alias("p_attack"),
        X.is_alert(pair[1]).cast("int").alias("y_pred"),
    )


def clamp_controls(spark, sf_dir):
    controls = T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity") / 40.0).alias("threshold"),
        F.col("l_partkey").alias("batch_size"),
    )
    return soc.clamp_controls(controls)


def _latest_controls(spark, sf_dir):
    """The control row in force: the setting that arrived last."""
    events = T.table(spark, sf_dir, "events")
    newest = F.max_by("value", F.col("event_id"))
    return events.agg((newest / 100.0).alias("threshold"), F.lit(64).alias("batch_size"))


def apply_controls(spark, sf_dir):
    found = soc.apply_controls(T.scored(spark, sf_dir), _latest_controls(spark, sf_dir))
    return found.select("flow_id", "confidence")


def alert_projection(spark, sf_dir):
    return soc.alert_projection(_alerts(spark, sf_dir))


def display_rounding(spark, sf_dir):
    return soc.display_rounding(soc.traffic_totals(T.scored(spark, sf_dir)))


def traffic_totals(spark, sf_dir):
    totals = soc.traffic_totals(T.scored(spark, sf_dir))
    rounded = ["detection_rate", "throughput", "packets_per_sec", "elapsed_s"]
    return totals.withColumns({c: F.round(c, 6) for c in rounded})


def _share(df):
    return df.withColumn("share_pct", F.round("share_pct", 6))


def protocol_split(spark, sf_dir):
    return _share(soc.protocol_split(T.scored(spark, sf_dir)))


def severity_counts(spark, sf_dir):
    return _share(soc.severity_counts(_alerts(spark, sf_dir)))


def attack_type_counts(spark, sf_dir):
    return soc.attack_type_counts(_alerts(spark, sf_dir))


def alert_counts_by_dim(spark, sf_dir):
    return soc.alert_counts_by_dim(_alerts(spark, sf_dir))


def attack_heatmap(spark, sf_dir):
    return soc.attack_heatmap(_alerts(spark, sf_dir))


def heatmap_intensity(spark, sf_dir):
    cells = soc.heatmap_intensity(soc.attack_heatmap(_alerts(spark, sf_dir)))
    return cells.withColumn("intensity", F.round("intensity", 6))


def confidence_histogram(spark, sf_dir):
    return soc.confidence_histogram(T.scored(spark, sf_dir))


def rolling_latency(spark, sf_dir):
    return soc.rolling_latency(T.scored(spark, sf_dir))


def rolling_confidence(spark, sf_dir):
    return soc.rolling_confidence(T.scored(spark, sf_dir))


def top_talkers(spark, sf_dir):
    return soc.top_talkers(_alerts(spark, sf_dir))


def recent_alerts(spark, sf_dir):
    return soc.recent_alerts(_alerts(spark, sf_dir))


def mean_alert_confidence(spark, sf_dir):
    return soc.mean_alert_confidence(T.scored(spark, sf_dir)).select(
        F.round("mean_confidence", 6).alias("mean_confidence")
    )


def threat_status(spark, sf_dir):
    df = soc.threat_status(T.scored(spark, sf_dir))
    return df.withColumn("detection_rate", F.round("detection_rate", 6))


def timeline(spark, sf_dir):
    return soc.timeline(T.scored(spark, sf_dir), tick_s=_TICK_S)


def last_ticks(spark, sf_dir):
    return soc.last_ticks(soc.timeline(T.scored(spark, sf_dir), tick_s=_TICK_S))


def alert_detail(spark, sf_dir):
    flows = O.flow_features(T.packets(spark, sf_dir), timeout_s=T.PACKET_TIMEOUT_S)
    df = soc.alert_detail(_alerts(spark, sf_dir), flows, T.scored(spark, sf_dir))
    return df.select(
        "flow_id", "time", "src_ip", "dst_ip", "port", "protocol", "type", "confidence", "severity",
        "fwd_packets", "bwd_packets", "syn_count", "ack_count", "rst_count", "related_flows",
        "flow_bytes_s", "flow_duration", "iat_mean", F.round(F.col("iat_std") / 1e6, 3).alias("iat_std_s"),
    )


def soc_overview(spark, sf_dir):
    return soc.soc_overview(T.scored(spark, sf_dir))


def soc_overview_with_model(spark, sf_dir):
    """The overview with the quality of the detector, written as a training document and read back."""
    path = scratch_path(spark, "training")
    figures = Q.classification_metrics(_judged(spark, sf_dir))
    J.write_metrics_json(figures.select(F.struct("accuracy", "precision", "recall", "f1").alias("metrics")), path)
    row = soc.with_model_quality(soc.soc_overview(T.scored(spark, sf_dir)), J.read_training_metrics(spark, path))
    return row.select("total_flows", "total_alerts", "ai_accuracy", "ai_f1", "ai_recall", "ai_precision", "batch_size")


def confusion_matrix(spark, sf_dir):
    return Q.confusion_matrix(_judged(spark, sf_dir))


def classification_metrics(spark, sf_dir):
    df = Q.classification_metrics(_judged(spark, sf_dir))
    return df.withColumns({c: F.round(c, 6) for c in ["accuracy", "precision", "recall", "f1"]})


def false_positive_rate(spark, sf_dir):
    df = Q.false_positive_rate(_judged(spark, sf_dir))
    return df.withColumn("false_positive_rate", F.round("false_positive_rate", 6))


QUERIES = {
    f.__name__: f
    for f in [
        protocol_name, severity, alert_filter, alerts, probability_pair, clamp_controls, apply_controls,
        alert_projection, display_rounding, traffic_totals, protocol_split, severity_counts,
        attack_type_counts, alert_counts_by_dim, attack_heatmap, heatmap_intensity,
        confidence_histogram, rolling_latency, rolling_confidence, top_talkers, recent_alerts,
        mean_alert_confidence, threat_status, timeline, last_ticks, alert_detail, soc_overview,
        soc_overview_with_model,
        confusion_matrix, classification_metrics, false_positive_rate,
    ]
}

# --- the same in SQL -------------------------------------------------------------------------

_SEVERITY = "CASE WHEN confidence >= 0.90 THEN 'critical' WHEN confidence >= 0.78 THEN 'medium' ELSE 'low' END"
_SHOWN_PROTOCOL = "CASE protocol WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 1 THEN 'ICMP' ELSE 'TCP' END"
_SCORED = f"""{T.SCORED_SQL},
alerts AS (SELECT * FROM scored WHERE confidence >= 0.7)"""
_RECORD = f"""flow_id, strftime(ts, '%H:%M:%S') AS time, src_ip, dst_ip, dst_port AS port,
       {_SHOWN_PROTOCOL} AS protocol, attack_type AS type, round(confidence * 100, 1) AS confidence,
       {_SEVERITY} AS severity"""
_TOTALS = f"""WITH {_SCORED},
t AS (
  SELECT count(*) AS total_flows, count(*) FILTER (confidence >= 0.7) AS total_alerts,
         count(*) AS total_packets, (max(us) - min(us)) / 1e6 AS elapsed_s,
         count(*) FILTER (confidence >= 0.7 AND {_SEVERITY} = 'critical') AS critical,
         count(*) FILTER (confidence >= 0.7 AND {_SEVERITY} = 'medium') AS medium,
         count(*) FILTER (confidence >= 0.7 AND {_SEVERITY} = 'low') AS low,
         count(*) FILTER (y_true = 0 AND confidence >= 0.7) AS fp,
         count(*) FILTER (y_true = 0 AND confidence < 0.7) AS tn,
         count(*) FILTER (y_true = 1 AND confidence >= 0.7) AS tp,
         count(*) FILTER (y_true = 1 AND confidence < 0.7) AS fn
  FROM scored),
r AS (
  SELECT *, total_alerts / greatest(total_flows, 1) * 100 AS detection_rate,
         total_flows / greatest(elapsed_s, 0.001) AS throughput,
         total_packets / greatest(elapsed_s, 0.001) AS packets_per_sec
  FROM t),
s AS (
  SELECT *, CASE WHEN critical > 15 OR detection_rate > 25 THEN 'critical'
                 WHEN critical > 5 OR medium > 15 OR detection_rate > 12 THEN 'elevated'
                 ELSE 'nominal' END AS system_status,
         CASE WHEN critical > 15 OR detection_rate > 25 THEN 'High'
              WHEN critical > 5 OR medium > 15 OR detection_rate > 12 THEN 'Medium'
              ELSE 'Low' END AS threat_level
  FROM r),
newest AS (SELECT * FROM scored ORDER BY ts DESC, flow_id DESC LIMIT 2000),
rolling AS (
  SELECT round(avg(latency_ms), 1) AS avg_latency_ms,
         round(quantile_cont(latency_ms, 0.95), 1) AS p95_latency_ms FROM newest)"""
_DIMS = f"""WITH {_SCORED},
dims AS (
  SELECT 'src_ip' AS dim, src_ip AS value, us FROM alerts
  UNION ALL SELECT 'dst_port', CAST(dst_port AS VARCHAR), us FROM alerts
  UNION ALL SELECT 'dst_ip', dst_ip, us FROM alerts),
counts AS (SELECT dim, value, count(*) AS n, min(us) AS first_us FROM dims GROUP BY ALL)"""
_HEATMAP = f"""WITH {_SCORED},
cells AS (
  SELECT (isodow(ts) - 1)::INT AS day, hour(ts)::INT AS hour, count(*) AS n FROM alerts GROUP BY ALL),
heat AS (
  SELECT d::INT AS day, h::INT AS hour, coalesce(n, 0) AS n
  FROM range(7) a(d) CROSS JOIN range(24) b(h) LEFT JOIN cells ON day = d AND hour = h)"""
_TIMELINE = f"""WITH {_SCORED},
buckets AS (
  SELECT us - us % {_TICK_S * 1_000_000} AS start_us,
         count(*) FILTER (confidence < 0.7) AS normal, count(*) FILTER (confidence >= 0.7) AS attack
  FROM scored GROUP BY 1),
line AS (
  SELECT *, CAST((start_us - min(start_us) OVER ()) // 1000000 AS VARCHAR) || 's' AS label
  FROM buckets)"""


def _histogram(source: str) -> str:
    return f"""
SELECT b::INT AS bin, coalesce(n, 0) AS n FROM range(10) g(b)
LEFT JOIN (SELECT least(floor(confidence * 10), 9) AS bin, count(*) AS n FROM {source} GROUP BY 1) c
ON c.bin = g.b"""


def _dense(values: list[str], expression: str, name: str, source: str) -> str:
    rows = ", ".join(f"('{v}')" for v in values)
    return f"""WITH {_SCORED},
kinds({name}) AS (VALUES {rows}),
counts AS (SELECT {expression} AS k, count(*) AS n FROM {source} GROUP BY 1),
dense AS (SELECT {name}, coalesce(n, 0) AS n FROM kinds LEFT JOIN counts ON k = {name})
SELECT *, round(n / greatest(sum(n) OVER (), 1) * 100, 6) AS share_pct FROM dense"""


_LINE_PROTOCOL = "l_linenumber + CASE WHEN l_linenumber > 5 THEN 11 ELSE 0 END"

ORACLES = {
    "protocol_name": f"""WITH p AS (SELECT l_orderkey, {_LINE_PROTOCOL} AS protocol FROM lineitem)
SELECT *, CASE protocol WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' ELSE 'ICMP' END AS counted_as,
       {_SHOWN_PROTOCOL} AS shown_as FROM p""",
    "severity": f"""WITH {_SCORED}
SELECT flow_id, {_SEVERITY} AS severity, {_SEVERITY.replace('0.78', '0.80')} AS severity_080
FROM scored""",
    "alert_filter": f"""WITH {_SCORED}
SELECT flow_id, confidence >= 0.7 AS at_or_above, confidence > 0.7 AS above,
       confidence > 0.5 AND confidence > 0.7 AS labelled_and_above FROM scored""",
    "alerts": f"WITH {_SCORED} SELECT flow_id, src_ip, dst_ip, dst_port FROM alerts",
    "probability_pair": """
WITH p AS (SELECT l_orderkey, 1 / (1 + exp(-((l_quantity - 25.0) / 5.0))) AS p FROM lineitem)
SELECT l_orderkey, round(1 - p, 9) AS p_normal, round(p, 9) AS p_attack, (p >= 0.7)::INT AS y_pred FROM p""",
    "clamp_controls": """
SELECT l_orderkey, least(greatest(l_quantity / 40.0, 0.3), 0.99)::DOUBLE AS threshold,
       least(greatest(l_partkey, 8), 512)::INT AS batch_size FROM lineitem""",
    "apply_controls": f"""WITH {_SCORED}
SELECT flow_id, confidence FROM scored WHERE confidence >=
  (SELECT least(greatest(arg_max(value, event_id) / 100.0, 0.3), 0.99) FROM events)""",
    "alert_projection": f"WITH {_SCORED} SELECT {_RECORD} FROM alerts",
    "display_rounding": f"""{_TOTALS}
SELECT total_flows, total_alerts, total_packets, round(elapsed_s, 1) AS elapsed_s,
       round(detection_rate, 1) AS detection_rate, round(throughput, 1) AS throughput,
       round(packets_per_sec, 0) AS packets_per_sec FROM r""",
    "traffic_totals": f"""{_TOTALS}
SELECT total_flows, total_alerts, total_packets, round(elapsed_s, 6) AS elapsed_s,
       round(detection_rate, 6) AS detection_rate, round(throughput, 6) AS throughput,
       round(packets_per_sec, 6) AS packets_per_sec FROM r""",
    "protocol_split": _dense(
        soc.PROTOCOL_NAMES,
        "CASE protocol WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' ELSE 'ICMP' END",
        "protocol",
        "scored",
    ),
    "severity_counts": _dense(soc.SEVERITIES, _SEVERITY, "severity", "alerts"),
    "attack_type_counts": f"""WITH {_SCORED}
SELECT attack_type, count(*) AS n FROM alerts GROUP BY 1""",
    "alert_counts_by_dim": f"{_DIMS} SELECT * FROM counts",
    "attack_heatmap": f"{_HEATMAP} SELECT * FROM heat",
    "heatmap_intensity": f"""{_HEATMAP},
shade AS (SELECT *, n / greatest(max(n) OVER (), 1) AS v FROM heat)
SELECT day, hour, n, round(v, 6) AS intensity,
       CASE WHEN v < 0.1 THEN 'none' WHEN v < 0.3 THEN 'low' WHEN v < 0.6 THEN 'mid' ELSE 'high' END AS band
FROM shade""",
    "confidence_histogram": f"WITH {_SCORED} {_histogram('scored')}",
    "rolling_latency": f"{_TOTALS} SELECT * FROM rolling",
    "rolling_confidence": f"{_TOTALS} {_histogram('newest')}",
    "top_talkers": f"""{_DIMS},
ranked AS (
  SELECT dim, value, n, row_number() OVER (PARTITION BY dim ORDER BY n DESC, first_us, value)::INT AS rank
  FROM counts)
SELECT * FROM ranked WHERE rank <= CASE dim WHEN 'dst_ip' THEN 6 ELSE 8 END""",
    "recent_alerts": f"""WITH {_SCORED},
shown AS (SELECT * FROM alerts ORDER BY ts DESC, flow_id DESC LIMIT 30)
SELECT {_RECORD} FROM shown""",
    "mean_alert_confidence": f"""WITH {_SCORED}
SELECT round(coalesce(avg(confidence) FILTER (confidence > 0.7), 0), 6) AS mean_confidence FROM scored""",
    "threat_status": f"""{_TOTALS}
SELECT critical, medium, round(detection_rate, 6) AS detection_rate, system_status, threat_level FROM s""",
    "timeline": f"{_TIMELINE} SELECT * FROM line",
    "last_ticks": f"{_TIMELINE} SELECT * FROM line ORDER BY start_us DESC LIMIT 60",
    "alert_detail": f"""WITH {CF.flows_sql('bidirectional')}, {_SCORED},
related AS (SELECT src_ip, count(*) AS related_flows FROM scored GROUP BY 1),
shown AS (SELECT {_RECORD} FROM alerts)
SELECT shown.*, fwd_packets, bwd_packets, syn_count, ack_count, rst_count, related_flows,
       flow_bytes_s, flow_duration, iat_mean, round(iat_std / 1e6, 3) AS iat_std_s
FROM shown LEFT JOIN flows USING (flow_id) LEFT JOIN related ON related.src_ip = shown.src_ip""",
    "soc_overview": f"""{_TOTALS}
SELECT total_flows, total_alerts, total_packets, round(elapsed_s, 1) AS elapsed_s, critical, medium, low,
       round(detection_rate, 1) AS detection_rate, round(throughput, 1) AS throughput,
       round(packets_per_sec, 0) AS packets_per_sec, system_status, threat_level, avg_latency_ms,
       p95_latency_ms, round(fp / (fp + tn) * 100, 1) AS false_positive_rate, 0.7::DOUBLE AS alert_threshold
FROM s, rolling""",
    "soc_overview_with_model": f"""{_TOTALS}
SELECT total_flows, total_alerts, round((tp + tn) / (tp + tn + fp + fn) * 100, 2) AS ai_accuracy,
       round(2 * tp / (2 * tp + fp + fn) * 100, 2) AS ai_f1, round(tp / (tp + fn) * 100, 2) AS ai_recall,
       round(tp / (tp + fp) * 100, 2) AS ai_precision, {S.BATCH_SIZE} AS batch_size
FROM s""",
    "confusion_matrix": f"{_TOTALS} SELECT tn, fp, fn, tp FROM t",
    "classification_metrics": f"""{_TOTALS}
SELECT tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM t""",
    "false_positive_rate": f"{_TOTALS} SELECT fp, tn, round(fp / (fp + tn), 6) AS false_positive_rate FROM t",
}
