"""Metrics documents and the shared scratch folder."""

import json

import pytest

from flowlake import runtime
from flowlake.sources import metrics_json as J


def result(throughput, **latency):
    return {"throughput": throughput, **latency}


def test_document_is_flattened_with_defaults(spark, tmp_path):
    doc = {
        J.BATCH: {"1": {"throughput_mean": 10.4}, "512": {"throughput": 99.6}},
        J.MODES: {"single_thread": result(100.6, avg_latency_ms=1.234, p95_latency_ms=5.0), "multi_thread": {}},
        J.SCALING: {
            "baseline_single_thread": result(5.0), "multi_thread": {"1": result(7.2), "2": result(8.8)},
            "multi_process": {"4": {}},
        },
        J.DEVICES: {"cpu": {"32": result(1.6)}, "gpu": {}},
    }
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=2))
    got = {(r.section, r.name, r.config): r.value for r in J.read_metrics_json(spark, str(path)).collect()}
    assert got[("pipeline", "single_thread", "")] == 101.0
    assert got[("pipeline", "multi_thread", "")] == got[("pipeline", "multi_process", "")] == 0.0
    assert got[("latency", "single_thread", "avg_latency_ms")] == 1.23
    assert got[("latency", "multi_process", "p99_latency_ms")] == 0.0
    assert got[("batch_scaling", "", "1")] == 10.0 and got[("max_batch_throughput", "", "")] == 100.0
    assert got[("scalability", "multi_thread", "2")] == 9.0 and got[("scalability", "multi_process", "4")] == 0.0
    assert got[("cpu_gpu", "cpu", "32")] == 2.0
    assert not [k for k in got if k[1] == "baseline_single_thread" or k[1] == "gpu"]


def test_empty_document(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text("{}")
    got = {(r.section, r.name): r.value for r in J.read_metrics_json(spark, str(path)).collect() if r.section != "latency"}
    assert got[("max_batch_throughput", "")] == 0.0 and got[("pipeline", "single_thread")] == 0.0 and len(got) == 4


def test_training_metrics_in_percent(spark, tmp_path):
    path = tmp_path / "run.json"
    path.write_text(json.dumps({"model_type": "gbt", "metrics": {"accuracy": 0.5, "f1": 0.25}}))
    row = J.read_training_metrics(spark, str(path)).first()
    assert (row.ai_accuracy, row.ai_f1, row.ai_recall, row.ai_precision) == (50.0, 25.0, 0.0, 0.0)


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert runtime.scratch_path(spark, "x").startswith(f"{root}/flowlake/")
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


def test_no_local_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Cluster:
        conf = Conf

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        runtime.scratch_root(Cluster)


def test_lookups_are_checked(spark, monkeypatch):
    small = runtime.checked_lookup(spark.range(5), "t")
    plan = spark.range(100).join(small, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and small.count() == 5
    monkeypatch.setattr(runtime, "LITERAL_ROWS", 3)
    assert runtime.checked_lookup(spark.range(5), "t").count() == 5
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 70)
    large = runtime.checked_lookup(spark.range(5), "t")
    plan = spark.range(100).join(large, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and large.count() == 5
