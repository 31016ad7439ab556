"""The command-line jobs, end to end on small folders."""

import json

from pyspark.sql import functions as F
from test_flows import COLUMNS, S1, packet

from flowlake import schema as S
from flowlake.plans import jobs, training
from flowlake.plans import tables as T
from flowlake.sources import metrics_json


def test_train_then_monitor(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    header = ",".join([*S.CANONICAL_FEATURES, "Label"])
    # flows with a reset are attacks
    lines = [",".join([str(i % 7)] * 10 + [str(i % 2)] + [str(i % 5)] * 7 + (["DoS"] if i % 2 else ["BENIGN"])) for i in range(400)]
    (folder / "a.csv").write_text("\n".join([header, *lines]) + "\n")
    paths = {name: str(tmp_path / name) for name in ("cache", "model", "metrics", "alerts", "packets", "overview")}
    jobs.main(["train", "--csv", str(folder), "--cache", paths["cache"], "--model", paths["model"],
               "--metrics", paths["metrics"], "--model-type", "random_forest"])
    row = metrics_json.read_training_metrics(spark, paths["metrics"]).first()
    assert row.ai_accuracy == 100.0

    rows = [packet(1, S1, client="10.0.0.1"), packet(2, 2 * S1, rst=True, client="10.0.0.1")]
    rows += [packet(3, S1, client="10.0.0.2"), packet(4, 2 * S1, fin=True, client="10.0.0.2"), packet(5, 900 * S1, client="10.0.0.3")]
    df = spark.createDataFrame(rows, COLUMNS).withColumn("ts", F.timestamp_micros("us"))
    df.select(*[f.name for f in S.PACKET_SCHEMA]).write.parquet(paths["packets"])
    jobs.main(["monitor", "--packets", paths["packets"], "--model", paths["model"], "--alerts", paths["alerts"],
               "--delay", "1 second", "--threshold", "0.5"])
    assert [r.flow_id for r in spark.read.parquet(paths["alerts"]).collect()] == [1]


def test_overview(spark, sf_dir, tmp_path):
    T.scored(spark, sf_dir).write.parquet(str(tmp_path / "scored"))
    jobs.main(["overview", "--scored", str(tmp_path / "scored"), "--out", str(tmp_path / "out")])
    (part,) = (tmp_path / "out").glob("part-*.json")
    assert json.loads(part.read_text())["total_flows"] == T.scored(spark, sf_dir).count()


def test_model_names():
    kinds = {name: type(training.classifier(name, 3)[0]).__name__ for name in ("xgboost", "torch_mlp", "other")}
    assert kinds == {"xgboost": "GBTClassifier", "torch_mlp": "MultilayerPerceptronClassifier", "other": "RandomForestClassifier"}
