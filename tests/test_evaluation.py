from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from intentloom.operators import evaluation as e
from intentloom.operators import explain, scoring


def pairs(spark, true, pred):
    return spark.createDataFrame(list(zip(true, pred)), "label int, predicted_label int")


def test_perfect_pair(spark):
    row = e.classification_metrics(pairs(spark, [0, 1, 2, 3, 4] * 2, [0, 1, 2, 3, 4] * 2)).first()
    assert set(row.asDict().values()) == {1.0}


def test_three_class_pair(spark):
    p = pairs(spark, [0, 1, 2, 0, 1, 2], [0, 1, 2, 0, 2, 1])
    matrix = {(r[0], r[1]): r[2] for r in e.confusion_matrix(p).collect()}
    assert len(matrix) == 9 and matrix[0, 0] == 2 and matrix[1, 2] == 1 and matrix[0, 1] == 0
    assert sum(matrix.values()) == 6
    wide = e.confusion_wide(e.confusion_matrix(p), [0, 1, 2]).collect()
    assert [list(r)[1:] for r in wide] == [[2, 0, 0], [0, 1, 1], [0, 1, 1]]


def test_labels_of_either_side_and_zero_division(spark):
    report = {r["label"]: r for r in e.per_class_report(pairs(spark, [0, 0, 1], [0, 2, 0])).collect()}
    assert set(report) == {0, 1, 2}
    assert report[2]["recall"] == 0.0 and report[2]["support"] == 0
    assert report[1]["precision"] == 0.0 and report[1]["f1_score"] == 0.0
    row = e.classification_metrics(pairs(spark, [0, 0, 1], [0, 2, 0])).first()
    assert row["f1_macro"] == pytest.approx(0.5 / 3, abs=1e-6)
    assert row["accuracy"] == row["f1_micro"] == pytest.approx(1 / 3, abs=1e-6)
    assert row["f1_weighted"] == pytest.approx(2 / 3 * 0.5, abs=1e-6)


def test_gate_and_promotion_bounds(spark):
    metrics = spark.createDataFrame([(0.90, 0.89)], "accuracy double, f1_weighted double")
    latency = spark.createDataFrame([(100.0,)], "latency_ms double")
    clean = spark.createDataFrame([(True,)], "passed boolean")
    rows = {r["metric_name"]: r for r in e.validation_gate(metrics, latency, clean).collect()}
    assert {n: r["passed"] for n, r in rows.items()} == {"accuracy": True, "f1_score": False, "latency_ms": True, "no_nan_predictions": True}
    assert not rows["accuracy"]["all_passed"]
    empty = e.validation_gate(metrics, latency.limit(0), clean).filter("metric_name = 'latency_ms'").first()
    assert empty["actual_value"] == 0.0 and empty["passed"]
    gate = e.promotion_gate(spark.createDataFrame([(0.9,), (0.8999,), (None,)], "f1_weighted double"))
    assert [r["status"] for r in gate.collect()] == ["REGISTERED", "NOT_REGISTERED", "NOT_REGISTERED"]


def test_best_run(spark):
    runs = spark.createDataFrame(
        [("x", "r1", "a", 0.5), ("x", "r2", "b", 0.7), ("x", "r3", "b", None), ("y", "r4", "a", 0.1)],
        "experiment string, run_id string, run_name string, f1_macro double",
    )
    assert {r["experiment"]: r["run_id"] for r in e.best_run(runs).collect()} == {"x": "r2", "y": "r4"}
    assert {r["experiment"]: r["run_id"] for r in e.best_run(runs, "a").collect()} == {"x": "r1", "y": "r4"}
    assert e.best_run(runs, "none").isEmpty()


def test_variant_latency(spark):
    log = spark.createDataFrame([("fp32", 40.0), ("fp32", 50.0), ("int8", 10.0)], "variant string, latency_ms double")
    rows = {r["variant"]: r for r in e.variant_latency(log, "fp32").collect()}
    assert rows["fp32"]["speedup"] == 1.0 and rows["int8"]["speedup"] == 4.5


def test_scores_to_predictions(spark):
    df = spark.createDataFrame([(0, [2.0, 0.5, -1.0]), (1, [0.1, 0.1, 0.1])], "id long, logits array<double>")
    names = spark.createDataFrame([(1, "other")], "label int, label_name string")
    rows = {r["id"]: r for r in scoring.batch_score(df, names).collect()}
    assert rows[0]["predicted_label_name"] == "class_0" and rows[0]["confidence"] == 0.7856 and rows[0]["message"] is None
    assert rows[1]["low_confidence"] and "human review" in rows[1]["message"]


def test_confidence_bounds(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (0.8,), (0.3,)], "confidence double")
    flags = {r["confidence"]: r["low_confidence"] for r in scoring.low_confidence(df).collect()}
    assert flags == {0.5: False, 0.4999: True, 0.8: False, 0.3: True}
    assert {r["tier"]: r["n"] for r in scoring.confidence_tiers(df).collect()} == {"high": 1, "medium": 1, "low": 2}


def test_numpy_model(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, -1.0],)], "x array<double>")

    def make():
        return lambda x: x * 2.0

    assert [r["logits"] for r in scoring.model_logits(df, make, ["x"], [[2]]).collect()] == [[2.0, 4.0], [6.0, -2.0]]


def test_attribution_equals_dense(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((30, 5)) * (rng.random((30, 5)) < 0.4)
    w = rng.normal(size=(3, 5))
    want = np.abs(w[:, None, :] * (x - x.mean(axis=0))[None]).mean(axis=1)
    cells = [(int(i), f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    features = spark.createDataFrame(cells, "sample_id long, term string, weight double")
    coefficients = spark.createDataFrame([(f"c{i}", f"t{j}", float(w[i, j])) for i in range(3) for j in range(5)], "class_name string, term string, w double")
    spread = explain.feature_spread(features, 30)
    got = {(r[0], r[1]): r[2] for r in explain.class_importance(coefficients, spread).collect()}
    assert got == pytest.approx({(f"c{i}", f"t{j}"): want[i, j] for i in range(3) for j in range(5)})
    top = explain.linear_attribution(coefficients, spread, top=2).filter("class_name = 'c0'").orderBy("rank").collect()
    assert [r["term"] for r in top] == [f"t{j}" for j in np.argsort(want[0])[::-1][:2]]
    total = explain.global_importance(coefficients, spread, top=1).first()
    assert total["term"] == f"t{int(np.argmax(want.sum(axis=0)))}"


def test_metrics_long_prefix(spark):
    long = e.metrics_long(e.classification_metrics(pairs(spark, [0, 1], [0, 1])), prefix="test_")
    assert long.count() == 10 and long.filter(~F.col("metric").startswith("test_")).isEmpty()
