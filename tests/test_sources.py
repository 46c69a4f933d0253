from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from intentloom.sources import io


@pytest.fixture(scope="module")
def split_table(spark):
    return spark.createDataFrame([(0, "a", "train"), (1, "b", "train"), (2, "c", "val")], "sample_id long, text string, split string")


def test_splits_round_trip_and_missing_split(spark, split_table, tmp_path):
    path = str(tmp_path / "splits")
    io.write_splits(split_table, path)
    io.write_splits(split_table, path)
    assert sorted(r["sample_id"] for r in io.read_splits(spark, path, ["train"]).collect()) == [0, 1]
    with pytest.raises(FileNotFoundError, match="test"):
        io.read_splits(spark, path, ["train", "test"])


def test_only_the_named_folders_are_read(spark, split_table, tmp_path):
    path = str(tmp_path / "splits")
    io.write_splits(split_table, path)
    plan = io.read_splits(spark, path, ["val"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*split", plan)


def test_union_renumbers(spark):
    a = spark.createDataFrame([(0, "x", 0), (1, "y", 1)], "sample_id long, text string, label int")
    b = spark.createDataFrame([(0, "z", 1)], "sample_id long, text string, label int")
    out = io.load_union(a, b)
    assert sorted(r["sample_id"] for r in out.collect()) == [0, 1, 2]
    assert io.union_report(out).first().asDict() == {"rows": 3, "labels": 2, "last_position": 2}


def test_report_csv(spark, tmp_path):
    report = spark.createDataFrame([(3, 0.5, 0.25, 0.333333, 4)], "label int, precision double, recall double, f1_score double, support long")
    path = str(tmp_path / "report")
    io.write_report_csv(report, path)
    header = next((tmp_path / "report").glob("*.csv")).read_text().splitlines()[0]
    assert header == "Unnamed: 0,precision,recall,f1-score,support"
    assert list(io.read_report_csv(spark, path).first()) == ["3", 0.5, 0.25, 0.333333, 4.0]


def test_metrics_json_keeps_numbers(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text(json.dumps({"accuracy": 0.91, "epochs": 6, "name": "x", "as_text": "0.5", "none": None, "done": True, "l": [1]}, indent=2))
    got = {r["metric"]: r["value"] for r in io.read_metrics_json(spark, str(path)).collect()}
    assert got == {"accuracy": 0.91, "epochs": 6.0, "done": 1.0}


def test_alert_lines_append_once(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts = spark.createDataFrame(
        [("latency_spike", "warning", "m", 120.0, 100.0)], "type string, severity string, message string, value double, threshold double"
    ).withColumn("timestamp", F.expr("timestamp_ntz'2024-01-02 03:04:05.678'"))
    assert io.read_alerts(spark, path).count() == 0
    for batch in ("a", "a", "b"):  # one is tried again
        io.write_alerts(alerts, path, batch)
    lines = [json.loads(x) for f in (tmp_path / "alerts").glob("batch=*/*.json") for x in f.read_text().splitlines()]
    assert len(lines) == io.read_alerts(spark, path).count() == 2
    assert list(lines[0]) == ["type", "severity", "message", "value", "threshold", "timestamp"]
    assert lines[0]["timestamp"] == "2024-01-02T03:04:05.678000+00:00"
    (tmp_path / "alerts" / "batch=b" / "_SUCCESS").unlink()  # a batch that broke off
    assert io.read_alerts(spark, path).count() == 1


def test_metric_log_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.range(5_000).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 40)").alias("ts"),
        F.col("id").cast("double").alias("latency_ms"), F.lit(0.5).alias("confidence"), F.lit("x").alias("predicted_label_name"),
    )
    for batch in ("1", "1", "2"):
        io.write_metric_log(log, path, batch, files_per_day=3)
    back = io.read_metric_log(spark, path)
    assert back.count() == 10_000 and back.filter("day = date'2024-01-02'").count() == 2 * 2_160
    days = list((tmp_path / "log" / "batch=1").glob("day=*"))
    assert len(days) == 3 and all(1 <= len(list(day.glob("*.parquet"))) <= 3 for day in days)


def test_audit_details(spark):
    log = spark.createDataFrame(
        [(7, "x" * 300, 2, "two", 0.5, 1.5)],
        "prediction_id long, text string, predicted_label int, predicted_label_name string, confidence double, latency_ms double",
    ).withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00'"))
    details = json.loads(io.prediction_audit(log).first()["details"])
    assert len(details["text_preview"]) == 200
    assert details["prediction"] == {"label": 2, "confidence": 0.5, "label_name": "two", "prediction_id": "7", "latency_ms": 1.5}


def test_feedback_id_is_stable(spark):
    requests = spark.createDataFrame(
        [("unknown", 3, None, "c"), ("unknown", 4, None, "c")],
        "prediction_id string, correct_label int, correct_label_name string, comment string",
    ).withColumn("created_at", F.expr("timestamp_ntz'2024-01-01 00:00:00'"))
    first = [r["feedback_id"] for r in io.feedback_rows(requests).collect()]
    assert first == [r["feedback_id"] for r in io.feedback_rows(requests).collect()]
    assert len(set(first)) == 2 and all(len(x) == 32 for x in first)


def test_metrics_of_several_rows(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = spark.createDataFrame([(0.5, 1), (0.25, 2), (0.75, 3)], "f1 double, n int").coalesce(1)
    io.write_metrics_json(rows, path)
    got = sorted((r["metric"], r["value"]) for r in io.read_metrics_json(spark, path).collect())
    assert got == [("f1", 0.25), ("f1", 0.5), ("f1", 0.75), ("n", 1.0), ("n", 2.0), ("n", 3.0)]


def test_a_repeated_feedback_batch_adds_no_rows(spark, tmp_path):
    path = str(tmp_path / "feedback")
    schema = "prediction_id long, correct_label int, correct_label_name string, comment string, created_at string"
    first = spark.createDataFrame([(1, 2, "a", None, "x"), (2, 3, None, "c", "y")], schema)
    for batch, rows in (("1", first), ("1", first), ("2", first.limit(1))):
        io.write_feedback(rows, path, batch)
    assert spark.read.parquet(path).count() == 3
