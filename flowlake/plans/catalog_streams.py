"""Registered queries: the streaming operators, run until what there is has been worked on.

The tables are replayed in thirds of the month, each third as soon as the one before is done, with
one checkpoint: three or more micro-batches, state carried over, watermark moving.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.operators import batching as B
from flowlake.operators import flows as O
from flowlake.operators import soc
from flowlake.plans import catalog_flows as CF
from flowlake.plans import catalog_soc as CS
from flowlake.plans import monitoring as N
from flowlake.plans import tables as T
from flowlake.plans import training as L
from flowlake.runtime import scratch_path, stored, write_scratch
from flowlake.streaming import alerts as A
from flowlake.streaming import flows as W
from flowlake.streaming import run
from flowlake.streaming import sources as R
from flowlake.streaming import stats as Q
from flowlake.streaming.ledger import Ledger

_DELAY_S = 86_400
_DELAY = f"{_DELAY_S} seconds"
_SLICE_S = 3_600
_LANES = 4
_TICK_S = 21_600
_THIRDS = ["2024-01-11", "2024-01-21"]


def _third(ts):
    return F.when(ts < _THIRDS[0], 0).when(ts < _THIRDS[1], 1).otherwise(2)


@contextmanager
def _state_partitions(spark, n):
    """State partitions of a replay on one machine; the library itself takes the session's number."""
    name = "spark.sql.shuffle.partitions"
    wanted = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, wanted)


def _replay(spark, df, start, order=(0, 1, 2)):
    """Write the thirds of ``df`` one after the other; after each, ``start(stream, checkpoint)`` runs
    to the end of what is there."""
    folder, checkpoint = scratch_path(spark, "replay"), scratch_path(spark, "stream")
    thirds = df.withColumn("third", _third(F.col("ts")))
    for i in order:
        thirds.where(F.col("third") == i).drop("third").write.mode("append").parquet(folder)
        with _state_partitions(spark, 2 * spark.sparkContext.defaultParallelism):
            start(R.file_stream(spark, folder, df.schema), checkpoint).awaitTermination()


def _appended(spark, df, build):
    out = scratch_path(spark, "out")
    _replay(spark, df, lambda stream, checkpoint: run.append_to(build(stream), out, checkpoint))
    return spark.read.parquet(out)


def packet_stream_source(spark, sf_dir):
    path, out = write_scratch(T.packets(spark, sf_dir), "packets"), scratch_path(spark, "out")
    run.append_to(R.packet_stream(spark, path), out).awaitTermination()
    return O.with_micros(spark.read.parquet(out)).drop("ts")


def stream_flows(spark, sf_dir):
    flows = _appended(
        spark,
        T.packets(spark, sf_dir),
        lambda p: W.stream_flows(p, _DELAY, T.PACKET_TIMEOUT_S, slice_s=_SLICE_S, lanes=_LANES),
    )
    return CF.rounded_flows(flows)


def stream_flows_by_gap(spark, sf_dir):
    return _appended(
        spark, T.packets(spark, sf_dir), lambda p: W.stream_flows_by_gap(p, _DELAY, T.PACKET_TIMEOUT_S)
    )


def stream_timeline(spark, sf_dir):
    return _appended(spark, T.scored(spark, sf_dir), lambda s: Q.stream_timeline(s, _DELAY, _TICK_S))


def _differences(got, want, columns):
    """How many rows of each side the other does not have."""
    got, want = stored(got.select(columns), "got"), stored(want.select(columns), "want")
    missing = want.exceptAll(got).agg(F.count(F.lit(1))).scalar().alias("n_missing")
    return [missing, got.exceptAll(want).agg(F.count(F.lit(1))).scalar().alias("n_extra")]


def stream_score_alerts(spark, sf_dir):
    """The alerts of the stream beside those of one transform over the whole table."""
    rows = T.trainable(spark, sf_dir)
    model = L.fit(rows, T.TRAINABLE_FEATURES, "random_forest")
    stream = R.file_stream(spark, write_scratch(rows, "flows"), rows.schema)
    out = scratch_path(spark, "alerts")
    run.append_to(A.stream_score_alerts(stream, model), out).awaitTermination()
    alerts = spark.read.parquet(out)
    want = L.score(model, rows).where(X.is_alert(F.col("p_attack")))
    differences = _differences(alerts, want, ["l_orderkey", "l_linenumber", "label", "y_pred", "p_attack"])
    right = alerts.agg(F.avg("label") >= 0.95).scalar().alias("precise")
    return spark.range(1).select(*differences, right)


def _flow_model(spark, sf_dir):
    """Learns which flows hold a reset packet, from all flows."""
    flows = O.flow_features(T.packets(spark, sf_dir), timeout_s=T.PACKET_TIMEOUT_S)
    rows = N.with_model_features(flows).withColumn("label", (F.col("rst_count") > 0).cast("int"))
    return L.fit(stored(rows, "flows"), N.MODEL_FEATURES, "random_forest")


def _alerts(packets, model):
    scored = N.score_packets(packets, model, timeout_s=T.PACKET_TIMEOUT_S)
    return scored.where(X.is_alert(F.col("p_attack"), rule="label_and_gt", label=F.col("y_pred")))


def monitor_packets(spark, sf_dir):
    """Packets to alerts, batch: every alert is a flow, above the threshold, and nearly all hold a reset packet."""
    packets = T.packets(spark, sf_dir)
    alerts = stored(_alerts(packets, _flow_model(spark, sf_dir)), "alerts")
    flows = O.flow_features(packets, timeout_s=T.PACKET_TIMEOUT_S)
    keys = ["flow_id", "start_us", "close_reason"]
    reset = F.avg((F.col("rst_count") > 0).cast("double"))
    found = flows.agg(F.count_if(F.col("rst_count") > 0)).scalar()
    return alerts.agg(
        F.count_if(F.col("p_attack") <= S.ALERT_THRESHOLD).alias("n_below"),
        (reset >= 0.99).alias("precise"),
        (F.count_if(F.col("rst_count") > 0) >= 0.95 * found).alias("complete"),
    ).withColumn("n_unknown", alerts.select(keys).exceptAll(flows.select(keys)).agg(F.count(F.lit(1))).scalar())


def monitor_stream(spark, sf_dir):
    """Packets to alerts, stream, beside the batch alerts of the flows that are closed when the input ends."""
    packets, model = T.packets(spark, sf_dir), _flow_model(spark, sf_dir)
    got = _appended(
        spark,
        packets,
        lambda p: N.monitor(p, model, _DELAY, timeout_s=T.PACKET_TIMEOUT_S, slice_s=_SLICE_S, lanes=_LANES),
    )
    newest = packets.agg(F.max(F.unix_micros("ts"))).first()[0]
    watermark = (newest // 1000 - _DELAY_S * 1000) * 1000
    ended = F.col("close_reason") == "fin_rst"
    last = F.col("last_us") + F.when(ended, 0).otherwise(T.PACKET_TIMEOUT_S * 1_000_000)
    width = _SLICE_S * 1_000_000
    closed = (F.floor(last / width) + 1) * width <= watermark
    reason = F.when(ended, "fin_rst").otherwise("timeout").alias("close_reason")
    want = _alerts(packets, model).where(closed).select("flow_id", "start_us", reason)
    differences = _differences(got, want, ["flow_id", "start_us", "close_reason"])
    return got.agg(F.count_if(F.col("p_attack") <= S.ALERT_THRESHOLD).alias("n_below")).select("n_below", *differences)


def alert_sink(spark, sf_dir):
    out = scratch_path(spark, "alerts")
    _replay(
        spark,
        T.scored(spark, sf_dir),
        lambda s, checkpoint: A.alert_sink(soc.alert_projection(soc.alert_filter(s)), out, checkpoint),
    )
    stored = Ledger(spark, out).table().drop("batch_id")
    return stored.withColumn("line", A.log_line(F.col("confidence") / 100))


def stats_snapshot_sink(spark, sf_dir):
    """The newest snapshot; its tail latency is a sketch and is left out here."""
    out = scratch_path(spark, "snapshots")
    _replay(spark, T.scored(spark, sf_dir), lambda s, checkpoint: Q.stats_snapshots(s, out, checkpoint=checkpoint))
    latest = Q.latest_snapshot(spark, out).select(*[c for c in Q.SNAPSHOT if c != "p95_latency_ms"])
    return latest.withColumns({c: F.round(c, 6) for c in ["throughput", "avg_latency_ms", "detection_rate"]})


def stream_running_stats(spark, sf_dir):
    """The totals after each third of the month."""
    out, history = scratch_path(spark, "snapshots"), scratch_path(spark, "history")
    cols = ["batch_id", "total_flows", "total_alerts", "critical", "medium", "low", "elapsed_s", "detection_rate"]

    class Kept:
        """The snapshot of a third is kept before the next one replaces it."""

        def __init__(self, query):
            self.query = query

        def awaitTermination(self):
            self.query.awaitTermination()
            Ledger(spark, out).table().select(cols).write.mode("append").parquet(history)

    _replay(spark, T.scored(spark, sf_dir), lambda s, checkpoint: Kept(Q.stats_snapshots(s, out, checkpoint=checkpoint)))
    return spark.read.parquet(history).withColumns({c: F.round(c, 6) for c in ["elapsed_s", "detection_rate"]})


_BATCH, _AGE_S = 4, 900


def micro_batching(spark, sf_dir):
    """Packets in batches of four, or whatever has come in a quarter of an hour."""
    packets = O.with_micros(T.packets(spark, sf_dir)).select("packet_id", "us")
    return B.size_or_age_batches(packets, ["us", "packet_id"], _BATCH, _AGE_S)


def packet_messages(spark, sf_dir):
    """Packets as JSON messages, taken in as a message queue hands them over."""
    messages = T.packets(spark, sf_dir).select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).cast("binary").alias("value"))
    return O.with_micros(R.packets_from_json(messages)).drop("ts")


def late_and_dropped(spark, sf_dir):
    """The first third of the month arrives last."""
    out = scratch_path(spark, "late")
    _replay(
        spark,
        T.packets(spark, sf_dir),
        lambda p, checkpoint: Q.late_rows(p, out, _DELAY_S, checkpoint=checkpoint),
        order=(1, 2, 0),
    )
    return Ledger(spark, out).table().select("batch_id", "n_rows", "n_late")


def stream_controls(spark, sf_dir):
    """The threshold is changed before every third."""
    out, controls = scratch_path(spark, "alerts"), scratch_path(spark, "controls")
    thresholds = iter([0.5, 0.9, 0.1])

    def start(stream, checkpoint):
        setting = spark.range(1).select(F.lit(next(thresholds)).alias("threshold"), F.lit(64).alias("batch_size"))
        setting.write.mode("overwrite").parquet(controls)
        return A.alerts_under_controls(stream, controls, out, checkpoint)

    _replay(spark, T.scored(spark, sf_dir), start)
    return Ledger(spark, out).table().select("batch_id", "flow_id", "confidence")


QUERIES = {
    f.__name__: f
    for f in [
        packet_stream_source, stream_flows, stream_flows_by_gap, stream_timeline, stream_score_alerts,
        monitor_packets, monitor_stream, alert_sink, stats_snapshot_sink, stream_running_stats, micro_batching, packet_messages, late_and_dropped,
        stream_controls,
    ]
}

# --- the same in SQL -------------------------------------------------------------------------

_TIMEOUT_US = T.PACKET_TIMEOUT_S * 1_000_000
_SLICE_US = _SLICE_S * 1_000_000
_WATERMARK = f"(SELECT (max(epoch_us(ts)) // 1000 - {_DELAY_S * 1000}) * 1000 FROM events)"


def _slice_end(us: str) -> str:
    return f"(({us}) // {_SLICE_US} + 1) * {_SLICE_US}"


# A silent flow is given up when every slice that could still hold one of its packets is closed.
_STREAMED = f"""{CF.flows_sql('bidirectional')},
closed AS (
  SELECT * REPLACE (CASE WHEN close_reason = 'fin_rst' THEN 'fin_rst' ELSE 'timeout' END AS close_reason)
  FROM flows
  WHERE CASE WHEN close_reason = 'fin_rst' THEN {_slice_end('last_us')}
             ELSE {_slice_end(f'last_us + {_TIMEOUT_US}')} END <= {_WATERMARK})"""
_THIRD = f"CASE WHEN ts < '{_THIRDS[0]}' THEN 0 WHEN ts < '{_THIRDS[1]}' THEN 1 ELSE 2 END"
_SEVERITIES = ", ".join(
    f"count(*) FILTER (confidence >= 0.7 AND {CS._SEVERITY} = '{s}') AS {s}" for s in soc.SEVERITIES
)

ORACLES = {
    "stream_score_alerts": "SELECT 0::BIGINT AS n_missing, 0::BIGINT AS n_extra, TRUE AS precise",
    "monitor_packets": """SELECT 0::BIGINT AS n_below, TRUE AS precise, TRUE AS complete, 0::BIGINT AS n_unknown""",
    "monitor_stream": "SELECT 0::BIGINT AS n_below, 0::BIGINT AS n_missing, 0::BIGINT AS n_extra",
    "packet_stream_source": f"WITH {T.PACKETS_SQL} SELECT * EXCLUDE (ts) FROM packets",
    "stream_flows": f"""WITH {_STREAMED}
SELECT * EXCLUDE (iat_std_s, segment), iat_std_s FROM (SELECT {CF.ROUNDED_SQL} FROM closed)""",
    "stream_flows_by_gap": f"""WITH {CF.sequenced_sql('bidirectional')},
sessions AS (
  SELECT ip_a, port_a, ip_b, port_b, protocol, min(us) AS start_us, max(us) AS last_us, count(*) AS packets,
         sum(size)::BIGINT AS bytes
  FROM sequenced GROUP BY ip_a, port_a, ip_b, port_b, protocol, gaps_before)
SELECT * FROM sessions WHERE last_us + {_TIMEOUT_US} <= {_WATERMARK}""",
    "stream_timeline": f"""{CS._TIMELINE}
SELECT start_us, normal, attack FROM line WHERE start_us + {_TICK_S * 1_000_000} <= {_WATERMARK}""",
    "alert_sink": f"""WITH {CS._SCORED}, shown AS (SELECT {CS._RECORD} FROM alerts)
SELECT *, 'ALERT attack detected, confidence ' || round(confidence / 100, 4) AS line FROM shown""",
    "stats_snapshot_sink": f"""{CS._TOTALS}
SELECT total_flows, total_alerts, round(throughput, 6) AS throughput,
       (SELECT round(avg(latency_ms), 6) FROM scored) AS avg_latency_ms,
       round(detection_rate, 6) AS detection_rate, system_status FROM s""",
    "stream_running_stats": f"""WITH {T.SCORED_SQL}, b AS (SELECT range::INT AS batch_id FROM range(3))
SELECT batch_id, count(*) AS total_flows, count(*) FILTER (confidence >= 0.7) AS total_alerts, {_SEVERITIES},
       round((max(us) - min(us)) / 1e6, 6) AS elapsed_s,
       round(count(*) FILTER (confidence >= 0.7) / count(*) * 100, 6) AS detection_rate
FROM b JOIN scored ON {_THIRD} <= batch_id GROUP BY 1""",
    "packet_messages": f"WITH {T.PACKETS_SQL} SELECT * EXCLUDE (ts) FROM packets",
    # Batch by batch: each begins where the one before ended.
    "micro_batching": f"""WITH RECURSIVE {T.PACKETS_SQL},
p AS (SELECT packet_id, us, row_number() OVER (ORDER BY us, packet_id) AS rn,
             count(*) OVER (ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND {_AGE_S * 1_000_000 - 1} FOLLOWING) AS young
      FROM packets),
links AS (SELECT rn, us, least(rn + {_BATCH}, young + 1) AS next FROM p),
b(batch, rn, next, us) AS (
  SELECT 1::BIGINT, rn, next, us FROM links WHERE rn = 1
  UNION ALL SELECT b.batch + 1, l.rn, l.next, l.us FROM b JOIN links l ON l.rn = b.next),
held AS (
  SELECT p.packet_id, p.us, b.batch, b.us + {_AGE_S * 1_000_000} AS old_us, b.next - b.rn = {_BATCH} AND count(*) OVER w = {_BATCH} AS full_one,
         b.next > (SELECT max(rn) FROM p) AS is_last, max(p.us) OVER w AS newest
  FROM p JOIN b ON p.rn >= b.rn AND p.rn < b.next WINDOW w AS (PARTITION BY b.batch))
SELECT packet_id, us, batch, CASE WHEN full_one THEN 'size' WHEN is_last THEN 'end' ELSE 'age' END AS cause,
       CASE WHEN full_one OR is_last THEN newest ELSE old_us END - us AS wait_us
FROM held""",
    "late_and_dropped": f"""WITH p AS (SELECT *, {_THIRD} AS third, epoch_us(ts) AS us FROM events),
bound AS (SELECT (max(us) // 1000 - {_DELAY_S * 1000}) * 1000 AS wm FROM p WHERE third = 1)
SELECT CASE third WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END::INT AS batch_id, count(*) AS n_rows,
       count(*) FILTER (third = 0 AND us <= wm) AS n_late
FROM p, bound GROUP BY 1""",
    "stream_controls": f"""WITH {T.SCORED_SQL}
SELECT {_THIRD}::INT AS batch_id, flow_id, confidence FROM scored
WHERE confidence >= CASE {_THIRD} WHEN 0 THEN 0.5 WHEN 1 THEN 0.9 ELSE 0.3 END""",
}
