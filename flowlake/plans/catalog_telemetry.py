"""Registered queries: latency and throughput telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.functions import quantiles as Q
from flowlake.operators import flows as O
from flowlake.operators import telemetry as M
from flowlake.plans import tables as T
from flowlake.runtime import stored

_SUMMARY = ["avg", "p50", "p95", "p99", "min", "max"]


def _rounded(df, cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def latency_summary(spark, sf_dir):
    return _rounded(M.latency_summary(T.telemetry(spark, sf_dir), group=["mode", "device"]), _SUMMARY)


def latency_summary_overall(spark, sf_dir):
    """One figure set for all scored flows; the latencies are continuous values."""
    return _rounded(M.latency_summary(T.scored(spark, sf_dir)), _SUMMARY)


def merge_worker_summaries(spark, sf_dir):
    workers = M.worker_summaries(T.telemetry(spark, sf_dir), ["mode"])
    return _rounded(M.merge_worker_summaries(workers, ["mode"]), [*_SUMMARY, "elapsed_s", "throughput"])


def merge_worker_sketches(spark, sf_dir):
    """Percentiles from merged sketches of the workers, and whether their ranks are within the stated error."""
    rows = T.telemetry(spark, sf_dir)
    sketches = stored(M.worker_sketches(rows, ["mode"]), "sketches")
    merged = M.merge_worker_sketches(sketches, ["mode"])
    joined = rows.join(F.broadcast(merged.select("mode", *M.PERCENTILES)), "mode")
    ranks = joined.groupBy("mode").agg(
        *[F.avg((F.col("latency_ms") < F.col(p)).cast("double")).alias(f"{p}_below") for p in M.PERCENTILES],
        *[F.avg((F.col("latency_ms") <= F.col(p)).cast("double")).alias(f"{p}_upto") for p in M.PERCENTILES],
    )
    within = [
        ((F.col(f"{p}_below") <= share + Q.RANK_ERROR) & (F.col(f"{p}_upto") >= share - Q.RANK_ERROR)).alias(f"{p}_within")
        for p, share in M.PERCENTILES.items()
    ]
    out = merged.join(ranks, "mode").select("mode", "n", "avg", "min", "max", *within)
    return _rounded(out, ["avg", "min", "max"])


def average_runs(spark, sf_dir):
    """Batch sizes, repeated once per worker."""
    runs = M.throughput(T.telemetry(spark, sf_dir), ["batch_size", "worker_id"])
    df = M.average_runs(runs, "batch_size", ["throughput", "avg_latency_ms"])
    return _rounded(df, [c for c in df.columns if c != "batch_size"])


def _is_single():
    return F.col("mode") == "single"


def _by_workers(spark, sf_dir):
    results = M.throughput(T.telemetry(spark, sf_dir), ["mode", "workers"])
    return M.speedup_vs_baseline(results, _is_single(), "workers")


def speedup_vs_baseline(spark, sf_dir):
    return _rounded(
        _by_workers(spark, sf_dir), ["elapsed_s", "throughput", "avg_latency_ms", "speedup", "efficiency"]
    )


def mode_rating(spark, sf_dir):
    t = M.throughput(T.telemetry(spark, sf_dir), ["mode"])
    rated = M.mode_rating(M.speedup_vs_baseline(t, _is_single()))
    return _rounded(rated, ["elapsed_s", "throughput", "avg_latency_ms", "speedup"])


def device_speedup(spark, sf_dir):
    results = M.throughput(T.telemetry(spark, sf_dir), ["device", "batch_size"])
    return _rounded(M.device_speedup(results), ["cpu", "gpu", "speedup"])


def config_union_compare(spark, sf_dir):
    # Two result sets out of one pass: the rows are one per configuration.
    results = stored(_by_workers(spark, sf_dir), "results")
    thread = results.where(F.col("mode") == "thread")
    process = results.where(F.col("mode") == "process")
    df = M.config_union_compare(thread, process, "workers", ("thread", "process"))
    return _rounded(df, [c for c in df.columns if c != "workers"])


def best_config(spark, sf_dir):
    df = M.best_config(M.throughput(T.telemetry(spark, sf_dir), ["batch_size"]), "batch_size")
    return _rounded(df, ["max_throughput", "min_latency_ms"])


def count_window_latency(spark, sf_dir):
    events = O.with_micros(T.scored(spark, sf_dir)).select("flow_id", "us")
    return M.count_window_latency(events, ["us", "flow_id"])


def contiguous_slices(spark, sf_dir):
    events = O.with_micros(T.scored(spark, sf_dir)).select("flow_id", "us")
    return M.contiguous_slices(events, ["us", "flow_id"], 7)


QUERIES = {
    f.__name__: f
    for f in [
        latency_summary, latency_summary_overall, merge_worker_summaries, merge_worker_sketches, average_runs,
        speedup_vs_baseline, mode_rating, device_speedup, config_union_compare, best_config,
        count_window_latency, contiguous_slices,
    ]
}

# --- the same in SQL -------------------------------------------------------------------------


def _stats(value: str) -> str:
    return f"""count({value}) AS n, avg({value}) AS avg, quantile_cont({value}, 0.50) AS p50,
  quantile_cont({value}, 0.95) AS p95, quantile_cont({value}, 0.99) AS p99,
  min({value}) AS min, max({value}) AS max"""


def _round(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


_THROUGHPUT = """count(*) AS predictions, sum(latency_ms) / 1000.0 AS elapsed_s,
  count(*) / greatest(sum(latency_ms) / 1000.0, 0.001) AS throughput, avg(latency_ms) AS avg_latency_ms"""
_MEASURES = ["elapsed_s", "throughput", "avg_latency_ms"]
_BY_WORKERS = f"""WITH {T.TELEMETRY_SQL},
base AS (SELECT count(*) / greatest(sum(latency_ms) / 1000.0, 0.001) AS b FROM telemetry WHERE mode = 'single'),
r AS (SELECT mode, workers, {_THROUGHPUT} FROM telemetry GROUP BY 1, 2),
by_workers AS (
  SELECT r.*, throughput / greatest(b, 1) AS speedup, throughput / greatest(b, 1) / workers AS efficiency
  FROM r, base)"""

ORACLES = {
    "merge_worker_sketches": f"""WITH {T.TELEMETRY_SQL}
SELECT mode, count(*) AS n, round(avg(latency_ms), 6) AS avg, round(min(latency_ms), 6) AS min,
       round(max(latency_ms), 6) AS max, TRUE AS p50_within, TRUE AS p95_within, TRUE AS p99_within
FROM telemetry GROUP BY mode""",
    "latency_summary": f"""WITH {T.TELEMETRY_SQL},
s AS (SELECT mode, device, {_stats('latency_ms')} FROM telemetry GROUP BY 1, 2)
SELECT mode, device, n, {_round(_SUMMARY)} FROM s""",
    "latency_summary_overall": f"""WITH {T.SCORED_SQL},
s AS (SELECT {_stats('latency_ms')} FROM scored) SELECT n, {_round(_SUMMARY)} FROM s""",
    "merge_worker_summaries": f"""WITH {T.TELEMETRY_SQL},
w AS (SELECT mode, worker_id, {_stats('latency_ms')}, sum(latency_ms) / 1000.0 AS elapsed_s
      FROM telemetry GROUP BY 1, 2),
m AS (SELECT mode, sum(n)::BIGINT AS predictions, max(elapsed_s) AS elapsed_s,
             sum(n) / greatest(max(elapsed_s), 0.001) AS throughput, avg(avg) AS avg, avg(p50) AS p50,
             max(p95) AS p95, max(p99) AS p99, min(min) AS min, max(max) AS max FROM w GROUP BY 1)
SELECT mode, predictions, {_round([*_SUMMARY, 'elapsed_s', 'throughput'])} FROM m""",
    "average_runs": f"""WITH {T.TELEMETRY_SQL},
r AS (SELECT batch_size, worker_id, {_THROUGHPUT} FROM telemetry GROUP BY 1, 2),
a AS (SELECT batch_size, avg(throughput) AS throughput_mean, avg(avg_latency_ms) AS avg_latency_ms_mean,
             stddev_pop(throughput) AS throughput_std, stddev_pop(avg_latency_ms) AS avg_latency_ms_std
      FROM r GROUP BY 1)
SELECT batch_size, {_round(['throughput_mean', 'avg_latency_ms_mean', 'throughput_std', 'avg_latency_ms_std'])},
       round(throughput_mean / greatest((SELECT arg_min(throughput_mean, batch_size) FROM a), 1), 6) AS speedup
FROM a""",
    "speedup_vs_baseline": f"""{_BY_WORKERS}
SELECT mode, workers, predictions, {_round([*_MEASURES, 'speedup', 'efficiency'])} FROM by_workers""",
    "mode_rating": f"""WITH {T.TELEMETRY_SQL},
r AS (SELECT mode, {_THROUGHPUT} FROM telemetry GROUP BY 1),
s AS (SELECT r.*, throughput / greatest((SELECT throughput FROM r WHERE mode = 'single'), 1) AS speedup FROM r)
SELECT mode, predictions, {_round([*_MEASURES, 'speedup'])},
       CASE WHEN speedup >= 1 THEN 'Optimal' WHEN speedup >= 0.5 THEN 'Acceptable' ELSE 'Suboptimal' END AS rating
FROM s""",
    "device_speedup": f"""WITH {T.TELEMETRY_SQL},
r AS (SELECT device, batch_size, {_THROUGHPUT} FROM telemetry GROUP BY 1, 2)
SELECT c.batch_size, round(c.throughput, 6) AS cpu, round(g.throughput, 6) AS gpu,
       round(g.throughput / greatest(c.throughput, 1), 6) AS speedup
FROM r c JOIN r g ON c.batch_size = g.batch_size AND c.device = 'cpu' AND g.device = 'gpu'""",
    "config_union_compare": f"""{_BY_WORKERS},
t AS (SELECT * FROM by_workers WHERE mode = 'thread'),
p AS (SELECT * FROM by_workers WHERE mode = 'process')
SELECT workers, round(coalesce(t.throughput, 0), 6) AS thread_throughput,
       round(coalesce(t.speedup, 0), 6) AS thread_speedup,
       round(coalesce(t.efficiency * 100, 0), 6) AS thread_efficiency_pct,
       round(coalesce(p.throughput, 0), 6) AS process_throughput,
       round(coalesce(p.speedup, 0), 6) AS process_speedup,
       round(coalesce(p.efficiency * 100, 0), 6) AS process_efficiency_pct,
       round(coalesce(p.throughput, 0) / greatest(coalesce(t.throughput, 0), 1), 6) AS ratio
FROM t FULL OUTER JOIN p USING (workers)""",
    "best_config": f"""WITH {T.TELEMETRY_SQL},
r AS (SELECT batch_size, {_THROUGHPUT} FROM telemetry GROUP BY 1)
SELECT (SELECT batch_size FROM r ORDER BY throughput DESC, batch_size LIMIT 1) AS best_throughput_config,
       (SELECT batch_size FROM r ORDER BY avg_latency_ms, batch_size LIMIT 1) AS best_latency_config,
       round(max(throughput), 6) AS max_throughput, round(min(avg_latency_ms), 6) AS min_latency_ms FROM r""",
    "count_window_latency": f"""WITH {T.SCORED_SQL},
n AS (SELECT flow_id, us, (row_number() OVER (ORDER BY us, flow_id) - 1) // 64 AS batch FROM scored)
SELECT flow_id, us, batch, max(us) OVER (PARTITION BY batch) - us AS latency_us FROM n""",
    "contiguous_slices": f"""WITH {T.SCORED_SQL},
n AS (SELECT flow_id, us, row_number() OVER (ORDER BY us, flow_id) AS rn, count(*) OVER () AS total FROM scored)
SELECT flow_id, us, rn, least((rn - 1) // greatest(total // 7, 1), 6)::INT AS slice FROM n""",
}
