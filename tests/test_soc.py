"""Alert rules, severities, counters, ties, dense outputs and empty input."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowlake.functions import expressions as X
from flowlake.operators import quality as Q
from flowlake.operators import soc

COLUMNS = "flow_id long, ts timestamp, src_ip string, dst_ip string, dst_port int, protocol int, confidence double, y_true int, attack_type string, latency_ms double"


def flow(i, confidence=0.95, minute=0, src="1.1.1.1", port=80, protocol=6, y=1, day=1):
    return (i, datetime(2024, 1, day, 5, minute, i % 60), src, "9.9.9.9", port, protocol, confidence, y, "DDoS", float(i))


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize(
    "value,ge,gt,labelled", [(0.7, True, False, False), (0.71, True, True, True), (0.69, False, False, False)]
)
def test_rules_at_the_threshold(spark, value, ge, gt, labelled):
    c = F.col("c")
    row = spark.createDataFrame([(value, 1, 0)], "c double, one int, zero int").select(
        X.is_alert(c), X.is_alert(c, rule="gt"), X.is_alert(c, rule="label_and_gt", label=F.col("one")),
        X.is_alert(c, rule="label_and_gt", label=F.col("zero")),
    ).first()
    assert tuple(row) == (ge, gt, labelled, False)


def test_unknown_rules_are_refused():
    with pytest.raises(ValueError):
        X.is_alert(F.lit(1.0), rule="often")
    with pytest.raises(ValueError):
        X.is_alert(F.lit(1.0), rule="label_and_gt")


@pytest.mark.parametrize("value,expected", [(0.9, "critical"), (0.8999, "medium"), (0.78, "medium"), (0.7799, "low")])
def test_severity_cuts(spark, value, expected):
    assert spark.range(1).select(X.severity(F.lit(value))).first()[0] == expected


def test_protocols(spark):
    df = spark.createDataFrame([(6,), (17,), (1,), (99,), (None,)], "p int")
    counted = [r[0] for r in df.select(X.protocol_name(F.col("p"))).collect()]
    shown = [r[0] for r in df.select(X.protocol_name(F.col("p"), "TCP")).collect()]
    assert counted == ["TCP", "UDP", "ICMP", "ICMP", "ICMP"] and shown == ["TCP", "UDP", "ICMP", "TCP", "TCP"]


def test_vectors_and_probabilities(spark):
    row = spark.range(1).select(
        X.align_vector(F.array(F.lit(1.0), F.lit(2.0)), 4), X.align_vector(F.array(F.lit(1.0), F.lit(2.0)), 1),
        X.logistic(F.lit(0.0)), X.probability_pair(F.lit(0.25)),
    ).first()
    assert tuple(row) == ([1.0, 2.0, 0.0, 0.0], [1.0], 0.5, [0.75, 0.25])


def test_controls_are_clamped(spark):
    df = spark.createDataFrame([(0.1, 1), (0.5, 64), (5.0, 9999)], "threshold double, batch_size int")
    assert [tuple(r) for r in soc.clamp_controls(df).collect()] == [(0.3, 8), (0.5, 64), (0.99, 512)]


def test_controls_are_applied(spark):
    control = spark.createDataFrame([(0.0, 64)], "threshold double, batch_size int")
    df = table(spark, [flow(1, 0.29), flow(2, 0.3)])
    assert [r.flow_id for r in soc.apply_controls(df, control).collect()] == [2]


def test_histogram_edges_and_empty_bins(spark):
    df = table(spark, [flow(i, c) for i, c in enumerate([0.0, 0.05, 0.1, 0.999, 1.0])])
    got = [r.n for r in soc.confidence_histogram(df).orderBy("bin").collect()]
    assert got == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]


def test_top_talkers_ties(spark):
    rows = [flow(1, src="b", minute=1), flow(2, src="a", minute=2), flow(3, src="c", minute=0), flow(4, src="c", minute=3)]
    rows.append((5, rows[1][1], "0", *rows[1][3:]))
    top = soc.top_talkers(table(spark, rows), {"src_ip": 3, "dst_port": 1, "dst_ip": 1}).where("dim = 'src_ip'")
    # most first; then the one seen first; then the smaller value
    assert [r.value for r in top.orderBy("rank").collect()] == ["c", "b", "0"]


def test_top_talkers_limit_before_the_shuffle(spark):
    plan = soc.top_talkers(table(spark, [flow(1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_recent_alerts_and_rolling(spark):
    df = table(spark, [flow(i, minute=i // 60) for i in range(100)])
    recent = soc.recent_alerts(df).collect()
    assert len(recent) == 30 and recent[0].flow_id == 99 and recent[0].time == "05:01:39"
    assert tuple(soc.rolling_latency(df, 10).first()) == (94.5, 98.6)
    assert soc.rolling_confidence(df, 10).agg(F.sum("n")).first()[0] == 10
    plan = soc.newest(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_heatmap_is_dense(spark):
    heat = soc.attack_heatmap(table(spark, [flow(1, day=1), flow(2, day=1), flow(3, day=7)]))
    cells = {(r.day, r.hour): r.n for r in heat.collect()}
    assert len(cells) == 168 and cells[(0, 5)] == 2 and cells[(6, 5)] == 1 and sum(cells.values()) == 3
    bands = {(r.day, r.hour): r.band for r in soc.heatmap_intensity(heat).collect()}
    assert bands[(0, 5)] == "high" and bands[(6, 5)] == "mid" and bands[(1, 1)] == "none"


@pytest.mark.parametrize(
    "crit,med,rate,expected",
    [(16, 0, 0, "critical"), (15, 0, 0, "elevated"), (5, 15, 12, "nominal"), (5, 16, 0, "elevated"),
     (0, 0, 12.1, "elevated"), (0, 0, 25, "elevated"), (0, 0, 25.1, "critical")],
)
def test_status(spark, crit, med, rate, expected):
    df = spark.createDataFrame([(crit, med, float(rate))], "critical int, medium int, detection_rate double")
    row = soc.with_threat_status(df).first()
    assert row.system_status == expected
    assert row.threat_level == {"critical": "High", "elevated": "Medium", "nominal": "Low"}[expected]


def test_timeline_and_last_ticks(spark):
    df = table(spark, [flow(i, 0.9 if i % 2 else 0.1, minute=i) for i in range(10)])
    line = soc.timeline(df, tick_s=120)
    rows = line.orderBy("start_us").collect()
    assert [(r.normal, r.attack) for r in rows] == [(1, 1)] * 5 and [r.label for r in rows[:2]] == ["0s", "120s"]
    assert [r.label for r in soc.last_ticks(line, 2).collect()] == ["360s", "480s"]


def test_packets_are_counted_when_known(spark):
    df = table(spark, [flow(0), flow(10)]).withColumn("packets", F.lit(50))
    row = soc.traffic_totals(df).first()
    assert (row.total_packets, row.elapsed_s, row.packets_per_sec, row.throughput) == (100, 10.0, 10.0, 0.2)


def test_empty_input(spark):
    df = table(spark, [])
    totals = soc.traffic_totals(df).first()
    assert (totals.total_flows, totals.detection_rate, totals.throughput) == (0, 0.0, 0.0)
    assert tuple(soc.rolling_latency(df).first()) == (0.0, 0.0)
    assert [r.n for r in soc.severity_counts(df).collect()] == [0, 0, 0]
    assert soc.mean_alert_confidence(df).first()[0] == 0.0
    overview = soc.soc_overview(df).first()
    assert overview.system_status == "nominal" and overview.false_positive_rate == 0.0
    judged = df.withColumn("y_pred", F.lit(1))
    assert set(Q.classification_metrics(judged).first()) == {0, 0.0}


def test_quality(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y_true int, y_pred int")
    row = Q.classification_metrics(df).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 1, 1, 1)
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.6, 0.5, 0.5, 0.5)
    assert Q.false_positive_rate(df).first().false_positive_rate == pytest.approx(1 / 3)
    never = df.withColumn("y_pred", F.lit(0))
    assert Q.classification_metrics(never).first().precision == 0.0
