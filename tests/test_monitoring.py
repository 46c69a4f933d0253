from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from intentloom.functions import scale
from intentloom.operators import drift, monitor


def sides(spark, ref, cur, kind="double"):
    return spark.createDataFrame([("ref", v) for v in ref] + [("cur", v) for v in cur], f"side string, x {kind}")


def test_no_drift_against_itself(spark):
    values = [float(i % 37) for i in range(500)]
    row = drift.numeric_drift(sides(spark, values, values), ["x"]).first()
    assert (row["ks_statistic"], row["ks_p_value"], row["wasserstein_norm"], row["drifted"]) == (0.0, 1.0, 0.0, False)
    row = drift.categorical_drift(sides(spark, ["a", "b"] * 9, ["a", "b"] * 9, "string"), ["x"]).first()
    assert (row["js_distance"], row["chi_square"], row["psi"], row["drifted"]) == (0.0, 0.0, 0.0, False)


@pytest.mark.parametrize("range_rows", [1, 3, 250_000])
def test_numeric_drift_by_hand(spark, range_rows):
    row = drift.numeric_drift(sides(spark, [0.0, 1.0, 2.0, 3.0], [2.0, 3.0, 4.0, 5.0]), ["x"], range_rows=range_rows).first()
    assert row["ks_statistic"] == 0.5
    assert row["wasserstein_norm"] == pytest.approx(2.0 / math.sqrt(1.25), abs=1e-6)


def test_large_side_uses_the_distance(spark):
    ref = [float(i) for i in range(2_000)]
    moved = sides(spark, ref, [v + 1_000 for v in ref])
    assert drift.numeric_drift(moved, ["x"]).first()["drifted"]
    assert not drift.numeric_drift(moved, ["x"], distance_limit=5.0).first()["drifted"]


def test_disjoint_categories(spark):
    row = drift.categorical_drift(sides(spark, ["a"] * 5, ["b"] * 5, "string"), ["x"]).first()
    assert row["js_distance"] == pytest.approx(math.sqrt(math.log(2)), abs=1e-6)
    assert row["categories"] == 2 and row["chi_square"] == 10.0 and row["drifted"]


@pytest.mark.parametrize("ref, cur", [([1.0, 2.0, 2.0], []), ([], [1.0, 2.0])])
def test_empty_side(spark, ref, cur):
    row = drift.numeric_drift(sides(spark, ref, cur), ["x"]).first()
    assert (row["ks_statistic"], row["ks_p_value"], row["wasserstein_norm"], row["drifted"]) == (None, None, None, False)
    row = drift.categorical_drift(sides(spark, ref, cur), ["x"]).first()
    assert (row["js_distance"], row["chi_square"], row["psi"], row["drifted"]) == (None, None, None, False)
    assert drift.label_shift(sides(spark, ref, cur), "x").first()["alert"]
    assert drift.confidence_drop(sides(spark, ref, cur).withColumnRenamed("x", "confidence")).first()["alert"] is False


def test_ranges_follow_the_values(spark):
    """Nearly all distinct values lie in one narrow stretch; still no range is much longer than asked for."""
    df = spark.range(40_000).selectExpr("case when id < 39000 then 1 + id / 1e9 else id * 1e6 end as v", "'x' as column", "1L as n")
    made = scale.ranged(df, ["column"], "v", "part", range_rows=1_000)
    sizes = [r["count"] for r in made.groupBy("part").count().collect()]
    assert len(sizes) >= 35 and max(sizes) <= 2_000
    edges = made.groupBy("part").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(edges, edges[1:]))


def test_decisions_from_counts(spark):
    rows = [("a", 0.9, 1, "ref")] * 50 + [("b", 0.8, 2, "ref")] * 50 + [("a", 0.4, 1, "cur")] * 70 + [("c", float("nan"), None, "cur")] * 30
    df = spark.createDataFrame(rows, "name string, confidence double, predicted_label int, side string")
    counts = drift.number_counts(df, ["confidence"])
    exact = drift.confidence_drop(df.withColumn("confidence", F.nanvl("confidence", F.lit(None).cast("double")))).first()
    assert tuple(drift.drop_of_confidence(counts).first()) == pytest.approx(tuple(exact))
    assert drift.shift_of_labels(drift.category_counts(df, ["predicted_label"])).first()["max_shift"] == 0.5


def test_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.normal(size=700).round(2), (rng.normal(size=900) * 1.3 + 0.2).round(2)
    points = np.sort(np.unique(np.concatenate([a, b])))
    fa, fb = (np.searchsorted(np.sort(x), points, side="right") / len(x) for x in (a, b))
    row = drift.numeric_drift(sides(spark, a.tolist(), b.tolist()), ["x"], range_rows=16).first()
    assert row["ks_statistic"] == pytest.approx(np.abs(fa - fb).max(), abs=1e-6)
    distance = (np.abs(fa - fb)[:-1] * np.diff(points)).sum() / a.std()
    assert row["wasserstein_norm"] == pytest.approx(distance, abs=1e-6)


def numbers(spark, **v):
    schema = ", ".join(f"{k} {'boolean' if isinstance(x, bool) else 'double'}" for k, x in v.items())
    return spark.createDataFrame([tuple(v.values())], schema)


def checked(spark, share, detected, ref, cur, shift):
    summary = numbers(spark, share_of_drifted_columns=share, drift_detected=detected)
    drop = numbers(spark, ref_confidence=ref, cur_confidence=cur, drop=ref - cur)
    return drift.alert_check(summary, drop, numbers(spark, max_shift=shift))


def test_alert_messages(spark):
    row = checked(spark, 0.5, True, 0.9, 0.8, 0.25).first()
    assert [a["message"] for a in row["alerts"]] == [
        "DATA_DRIFT: 50.00% columns drifted (threshold: 15.00%)",
        "CONFIDENCE_DROP: 0.1000 (ref=0.9000, cur=0.8000, threshold=0.05)",
        "LABEL_SHIFT: max single-label shift 25.00%",
    ]
    assert row["alert_count"] == 3 and row["needs_attention"]


def test_limits_themselves_raise_nothing(spark):
    quiet = checked(spark, 0.15, False, 0.5, 0.5, 0.10)
    assert quiet.first()["alert_count"] == 0
    decision = drift.retrain_trigger(quiet).first()
    assert decision["should_retrain"] is False and decision["reasons"] == []


def test_retrain_reasons(spark):
    row = drift.retrain_trigger(checked(spark, 0.1, True, 0.5, 0.5, 0.3)).first()
    assert row["reasons"] == ["dataset_drift_detected", "LABEL_SHIFT: max single-label shift 30.00%"]
    assert row["should_retrain"] and row["alert_count"] == 1


def test_threshold_alerts(spark):
    schema = "drift_detected boolean, mean_confidence double, error_rate double, latency_p95 double"
    df = spark.createDataFrame([(True, 0.6, 0.1, 150.0), (False, 0.7, 0.05, 100.0), (None, None, None, None)], schema)
    rows = monitor.threshold_alerts(df).collect()
    assert [(r["type"], r["severity"]) for r in rows] == [
        ("drift_detected", "critical"), ("confidence_drop", "warning"), ("error_rate_spike", "critical"), ("latency_spike", "warning"),
    ]
    assert [r["message"] for r in rows] == [
        "Data drift detected in production predictions.",
        "Mean confidence 0.600 below threshold 0.7.",
        "Error rate 10.000% exceeds threshold 5.000%.",
        "P95 latency 150.0ms exceeds threshold 100.0ms.",
    ]
    assert monitor.threshold_alerts(df.select("mean_confidence")).count() == 1


def log(spark, rows):
    return spark.createDataFrame(rows, "ts string, latency_ms double, confidence double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_window_edges_and_empty_window(spark):
    rows = [("2024-01-01 00:59:00", 10.0, 0.5), ("2024-01-01 00:55:00", 20.0, 0.9), ("2024-01-01 00:00:00", 30.0, 0.1), ("2023-12-31 23:59:59", 99.0, 0.0)]
    as_of = F.expr("timestamp_ntz'2024-01-01 01:00:00'")
    got = {r["window"]: r for r in monitor.window_summary(log(spark, rows), as_of=as_of).collect()}
    assert {w: r["count"] for w, r in got.items()} == {"1min": 1, "5min": 2, "1hour": 3}
    assert got["5min"]["latency_p50"] == 15.0 and got["1hour"]["confidence_min"] == 0.1
    late = F.expr("timestamp_ntz'2030-01-01 00:00:00'")
    empty = monitor.window_summary(log(spark, rows), as_of=late).collect()
    assert len(empty) == 3 and all(list(r)[1:] == [0, 0, 0, 0, 0, 0, 0] for r in empty)


def test_retention_is_inclusive(spark):
    rows = [("2024-01-01 01:00:00", 1.0, 1.0), ("2024-01-01 00:00:00", 2.0, 1.0), ("2023-12-31 23:59:59", 3.0, 1.0)]
    assert monitor.retention_trim(log(spark, rows)).count() == 2


def test_bucket_quantile_interpolates(spark):
    rows = [("2024-01-01 00:00:00", v, 0.0) for v in (1.0, 6.0, 7.0, 8.0)] + [("2024-01-01 00:10:00", 900.0, 0.0)]
    got = monitor.bucket_quantiles(log(spark, rows), bounds=(5.0, 10.0)).orderBy("window_start").collect()
    assert got[0]["p50"] == pytest.approx(5 + 5 * (2 - 1) / 3, abs=1e-6)
    assert got[1]["p50"] == 10.0  # beyond the last bound


def test_feedback_stats(spark):
    df = spark.createDataFrame([(1, "one")] * 2 + [(2, None)] * 3 + [(3, "")], "correct_label int, correct_label_name string")
    rows = monitor.feedback_stats(df).collect()
    assert [(r["label"], r["label_name"], r["count"]) for r in rows] == [(2, "class_2", 3), (1, "one", 2), (3, "class_3", 1)]
    assert rows[0]["total_corrections"] == 6
    assert monitor.feedback_stats(df.limit(0)).isEmpty()


@pytest.mark.parametrize("rows", [1_000, 1_001])
def test_the_drift_rule_does_not_depend_on_the_number_of_rows(spark, rows):
    ref = [float(i % 100) for i in range(rows)]
    moved = sides(spark, ref, [v + 2 for v in ref])
    assert not drift.numeric_drift(moved, ["x"]).first()["drifted"]
    assert drift.numeric_drift(sides(spark, ref, [v + 35 for v in ref]), ["x"]).first()["drifted"]
    assert not drift.numeric_drift(moved, ["x"], rule="p").first()["drifted"]


def test_nan_is_no_value(spark):
    values = [float(i % 37) for i in range(200)]
    row = drift.numeric_drift(sides(spark, values, [*values, float("nan"), None]), ["x"]).first()
    assert (row["n_ref"], row["n_cur"], row["wasserstein_norm"], row["drifted"]) == (200, 200, 0.0, False)
