"""Percentiles, summaries, repeats, baselines and windows by count."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.functions import quantiles as Q
from flowlake.operators import telemetry as M

P = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 10.0],
        [5.0],
        [-3.0, -3.0, 0.0, 1e-9, 2.5e12],
        [7.0] * 50 + [8.0],
        [random.Random(1).lognormvariate(0, 3) for _ in range(700)],
        [1 + random.Random(2).random() * 1e-6 * i for i in range(300)],
        [random.Random(i).random() / 1000 for i in range(500)],
        [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.7e308, -1.7e308, 1.0, 2.0, 4.0, 0.1, -0.1],
        [2.0**k for k in range(-60, 60)] + [-(2.0**k) * (1 - 2**-53) for k in range(-60, 60)],
    ],
)
@pytest.mark.parametrize("window_rows", [Q.WINDOW_ROWS, 3])
def test_percentiles_match_linear_interpolation(spark, values, window_rows, monkeypatch):
    """Values of one bucket in one window, and found digit by digit."""
    monkeypatch.setattr(Q, "WINDOW_ROWS", window_rows)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    row = Q.distribution(df, "x", P).first()
    for name, p in P.items():
        assert row[name] == pytest.approx(float(np.percentile(values, p * 100)), rel=1e-12)
    assert (row["n"], row["min"], row["max"]) == (len(values), min(values), max(values))


def test_percentiles_by_group_with_null_group(spark):
    rng = random.Random(3)
    data = [(g, rng.gauss(0, 100)) for g in ["a", "b", None] for _ in range(rng.randint(1, 90))] + [("a", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r for r in Q.distribution(df, "x", P, ["g"]).collect()}
    for g in ["a", "b", None]:
        values = [v for k, v in data if k == g and v is not None]
        assert got[g].p95 == pytest.approx(float(np.percentile(values, 95)))
        assert got[g].avg == pytest.approx(np.mean(values)) and got[g].n == len(values)


def test_digits_order_like_the_values(spark):
    rng = random.Random(8)
    values = sorted({rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 300) for _ in range(2_000)} | {0.0, 1.0, float("inf"), -float("inf")})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = {r.x: (r["__d0"], r["__d1"], r["__d2"], r["__d3"]) for r in Q._digits(df, "x", more=True).collect()}
    digits = [rows[v] for v in values]
    assert digits == sorted(set(digits))


def test_no_window_sees_a_whole_bucket(spark, monkeypatch):
    """All values between 0 and 0.001 in one group: the windows behind a border bucket stay below the bound."""
    df = spark.range(60_000).select((F.rand(1) / 1000).alias("x"))
    values = sorted(r.x for r in df.collect())
    monkeypatch.setattr(Q, "WINDOW_ROWS", 50)
    seen, narrowed = [], Q._narrowed

    def watched(found, part, digit, ranks):
        seen.append((digit, found.groupBy(*part, digit).count().groupBy(*part).count().agg({"count": "max"}).first()[0]))
        return narrowed(found, part, digit, ranks)

    monkeypatch.setattr(Q, "_narrowed", watched)
    row = Q.distribution(df, "x", P).first()
    assert [d for d, _ in seen] == ["__d1", "__d2", "__d3"]
    assert seen[0][1] > 50 and seen[1][1] <= 2 and seen[2][1] <= 2
    for name, p in P.items():
        assert row[name] == pytest.approx(float(np.percentile(values, p * 100)), rel=1e-12)


def test_sketches_merge_without_the_rows(spark):
    rng = random.Random(4)
    data = [(b, k, rng.lognormvariate(0, 2)) for b in range(6) for k in ("a", "b") for _ in range(4_000)] + [(9, "c", None)]
    df = spark.createDataFrame(data, "batch int, k string, x double")
    parts = Q.sketches(df, "x", ["batch", "k"]).cache()
    got = {r.k: r for r in Q.sketched_distribution(Q.merged_sketches(parts, ["k"]), P).collect()}
    for k in ("a", "b"):
        values = np.sort([x for _, g, x in data if g == k])
        assert (got[k].n, got[k].min, got[k].max) == (len(values), values[0], values[-1])
        assert got[k].avg == pytest.approx(values.mean())
        for name, p in P.items():
            assert abs(np.searchsorted(values, got[k][name], "right") / len(values) - p) <= 2 * Q.RANK_ERROR
    assert set(got["c"][1:]) == {0, 0.0}
    assert set(Q.sketched_distribution(Q.merged_sketches(parts.where("k = 'z'")), P).first()) == {0, 0.0}


def test_empty_summary_is_zeros(spark):
    df = spark.createDataFrame([], "latency_ms double")
    assert set(M.latency_summary(df).first()) == {0, 0.0}
    assert set(M.latency_summary(df, exact=False).first()) == {0, 0.0}
    assert M.latency_summary(df.withColumn("g", F.lit(1)), group=["g"]).count() == 0


def test_approximate_summary_is_close(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("latency_ms"))
    exact, approx = M.latency_summary(df).first(), M.latency_summary(df, exact=False).first()
    assert approx["p95"] == pytest.approx(exact["p95"], rel=0.01) and approx["n"] == exact["n"]


def test_worker_merge(spark):
    columns = "run int, predictions long, elapsed_s double, avg double, p50 double, p95 double, p99 double, min double, max double"
    rows = [(1, 10, 2.0, 1.0, 1.0, 5.0, 6.0, 0.5, 7.0), (1, 30, 4.0, 3.0, 2.0, 4.0, 9.0, 0.1, 9.0)]
    row = M.merge_worker_summaries(spark.createDataFrame(rows, columns), ["run"]).first()
    assert (row.predictions, row.throughput, row.avg, row.p50) == (40, 10.0, 2.0, 1.5)
    assert (row.p95, row.p99, row["min"], row["max"]) == (5.0, 9.0, 0.1, 9.0)


def test_average_runs(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 20.0), (4, 60.0)], "batch int, throughput double")
    got = {r.batch: r for r in M.average_runs(df, "batch", ["throughput"]).collect()}
    assert (got[1].throughput_mean, got[1].throughput_std, got[1].speedup) == (15.0, 5.0, 1.0)
    assert (got[4].throughput_std, got[4].speedup) == (0.0, 4.0)


def test_baseline_guard_and_rating(spark):
    rows = [("a", 1, 2.0, 0.5, 2), ("b", 4, 2.0, 2.0, 4)]
    results = spark.createDataFrame(rows, "mode string, predictions long, elapsed_s double, throughput double, workers int")
    got = {r.mode: r for r in M.speedup_vs_baseline(results, F.col("mode") == "a", "workers").collect()}
    # a baseline below 1 counts as 1
    assert (got["a"].speedup, got["b"].speedup, got["b"].efficiency) == (0.5, 2.0, 0.5)
    speeds = spark.createDataFrame([(1.0,), (0.99,), (0.5,), (0.49,)], "speedup double")
    ratings = [r.rating for r in M.mode_rating(speeds).collect()]
    assert ratings == ["Optimal", "Acceptable", "Acceptable", "Suboptimal"]


def test_union_compare_fills_gaps_in_numeric_order(spark):
    columns = "w string, throughput double, speedup double, efficiency double"
    left = spark.createDataFrame([("2", 10.0, 1.0, 0.5), ("10", 30.0, 3.0, 0.3)], columns)
    right = spark.createDataFrame([("2", 5.0, 0.5, 0.25), ("4", 8.0, 0.8, 0.2)], columns)
    got = [tuple(r) for r in M.config_union_compare(left, right, "w", ("l", "r")).select("w", "l_throughput", "r_throughput", "ratio").collect()]
    assert got == [(2, 10.0, 5.0, 0.5), (4, 0.0, 8.0, 8.0), (10, 30.0, 0.0, 0.0)]


def test_device_speedup_needs_both(spark):
    rows = [("cpu", 1, 10.0), ("gpu", 1, 5.0), ("cpu", 2, 7.0)]
    df = spark.createDataFrame(rows, "device string, batch_size int, throughput double")
    assert [tuple(r) for r in M.device_speedup(df).collect()] == [(1, 10.0, 5.0, 0.5)]


def test_best_config_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([(8, 5.0, 2.0), (4, 5.0, 2.0), (2, 1.0, 9.0)], "c int, throughput double, avg_latency_ms double")
    row = M.best_config(df, "c").first()
    assert (row.best_throughput_config, row.best_latency_config) == (4, 4)


def test_count_windows_flush_the_rest(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(10)], "id long, us long").repartition(4)
    got = {r.id: (r.batch, r.latency_us) for r in M.count_window_latency(df, ["us", "id"], size=4).collect()}
    assert got[0] == (0, 30) and got[3] == (0, 0) and got[4] == (1, 30) and got[8] == (2, 10) and got[9] == (2, 0)


def test_slices_give_the_rest_to_the_last(spark):
    df = spark.range(11).repartition(3)
    got = [r["count"] for r in M.contiguous_slices(df, ["id"], 4).groupBy("slice").count().orderBy("slice").collect()]
    assert got == [2, 2, 2, 5]
    few = M.contiguous_slices(spark.range(2), ["id"], 4).select("slice").collect()
    assert sorted(r.slice for r in few) == [0, 1]
