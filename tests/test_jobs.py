"""The jobs from files to files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from intentloom.operators import evaluation, quality, training
from intentloom.plans import jobs
from intentloom.sources import io
from intentloom.sources.labels import LABEL_NAMES, label_dictionary


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rows = spark.range(600).select(
        F.col("id").alias("sample_id"),
        F.concat(F.lit("please "), F.element_at(F.array(*[F.lit(x) for x in ("alpha", "beta", "gamma")]), (F.col("id") % 3 + 1).cast("int")), F.lit(" word"), F.col("id") % 11).alias("text"),
        (F.col("id") % 3).cast("int").alias("label"),
    )
    rows.filter("sample_id < 400").write.parquet(str(folder / "first"))
    rows.filter("sample_id >= 400").withColumn("sample_id", F.col("sample_id") - 400).write.parquet(str(folder / "second"))
    return folder


def test_prepare_train_score_explain(spark, raw, tmp_path):
    splits, out = str(tmp_path / "splits"), str(tmp_path / "out")
    check = jobs.prepare(spark, str(raw / "first"), str(raw / "second"), splits).first()
    assert check["rows"] == 600 and check["schema_passed"]
    counts = {r["split"]: r["count"] for r in spark.read.parquet(splits).groupBy("split").count().collect()}
    assert counts == {"train": 420, "val": 90, "test": 90}
    ranked, model, vocab = jobs.train(spark, splits, out, lambda n: {"logreg": training.logreg(n)}, max_features=100)
    first = ranked.first()
    assert first["f1_macro"] == 1.0 and first["status"] == "REGISTERED"
    assert {r["metric"] for r in io.read_metrics_json(spark, f"{out}/metrics").collect()} >= {"accuracy", "f1_weighted"}
    assert io.read_report_csv(spark, f"{out}/report").count() == 3
    test = io.read_splits(spark, splits, ["test"]).select("sample_id", "text", "label")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "label int, label_name string")
    scored = jobs.score(test, model, vocab, names)
    assert scored.filter("label <> predicted_label").isEmpty() and scored.count() == 90
    assert {r[0] for r in scored.select("predicted_label_name").distinct().collect()} == {"a", "b", "class_2"}
    top = jobs.explain_model(test, model, vocab, {0: "a", 1: "b", 2: "c"}, top=2)
    assert top.count() == 6 and top.filter("class_name = 'a' and term = 'alpha'").count() == 1


def test_training_on_augmented_rows(spark, raw, tmp_path):
    splits = str(tmp_path / "splits")
    jobs.prepare(spark, str(raw / "first"), str(raw / "second"), splits)
    models = lambda n: {"logreg": training.logreg(n, max_iter=10)}
    ranked, _, _ = jobs.train(spark, splits, str(tmp_path / "out"), models, max_features=100, augment=True)
    assert ranked.first()["accuracy"] > 0.9


def test_bad_rows_stop_the_job(spark, raw, tmp_path):
    bad = str(tmp_path / "bad")
    spark.createDataFrame([(0, "", 1)], "sample_id long, text string, label int").write.parquet(bad)
    check = jobs.prepare(spark, str(raw / "first"), bad, str(tmp_path / "splits")).first()
    assert not check["schema_passed"] and check["bad_rows"] == 1
    assert not (tmp_path / "splits").exists()


def test_monitor_job(spark, tmp_path):
    ref, cur, other = (str(tmp_path / n) for n in ("ref", "cur", "other"))
    rows = spark.range(2_000).select(
        F.concat(F.lit("t"), F.col("id")).alias("text"), (F.col("id") % 5).cast("int").alias("predicted_label"), ((F.col("id") % 100) / 100).alias("confidence")
    )
    rows.write.parquet(ref)
    rows.select("text", F.lit(0).alias("predicted_label"), (F.col("confidence") / 2).alias("confidence"), F.lit(1).alias("extra")).write.parquet(cur)
    spark.range(3).toDF("z").write.parquet(other)
    same = jobs.monitor(spark, ref, ref, str(tmp_path / "d1")).first()
    assert same["should_retrain"] is False and same["reasons"] == []
    moved = jobs.monitor(spark, ref, cur, str(tmp_path / "d2")).first()
    assert moved["should_retrain"] and moved["alert_count"] == 3
    assert moved["reasons"][0] == "dataset_drift_detected"
    assert jobs.monitor(spark, ref, other, str(tmp_path / "d3")).columns == ["error"]


def test_label_names(spark):
    assert len(LABEL_NAMES) == len(set(LABEL_NAMES)) == 77
    assert label_dictionary(spark).filter("label = 11").first()["label_name"] == "card_arrival"


@pytest.mark.parametrize("make", [training.logreg, training.linear_svc, lambda n: training.random_forest(n, trees=10, depth=5)])
def test_every_kind_of_model_is_stored_and_scores(spark, raw, tmp_path, make):
    """Train, save, load, score and explain from files; the loaded model gives what the fitted one gave."""
    splits, out, names, runs = (str(tmp_path / n) for n in ("splits", "out", "names", "runs"))
    jobs.prepare(spark, str(raw / "first"), str(raw / "second"), splits)
    for _ in range(2):  # a repeated run counts once
        _, model, vocab = jobs.train(spark, splits, out, lambda n: {"model": make(n)}, max_features=100, runs=runs, run="first")
    spark.createDataFrame([(0, "a"), (1, "b")], "label int, label_name string").write.parquet(names)
    rows = f"{splits}/split=test"
    summary = jobs.score_table(spark, out, rows, names, str(tmp_path / "scored")).first()
    assert summary["rows"] == 90 and summary["distinct_labels"] == 3
    columns = ["sample_id", "label", "predicted_label", "predicted_label_name", "confidence"]
    got = spark.read.parquet(str(tmp_path / "scored")).select(columns)
    test = io.read_splits(spark, splits, ["test"]).select("sample_id", "text", "label")
    want = jobs.score(test, model, vocab, spark.read.parquet(names)).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("label = predicted_label").count() >= 80
    assert {r["passed"] for r in spark.read.json(f"{out}/validation").collect()} <= {True, False}
    assert spark.read.json(f"{out}/validation").count() == 4

    best = evaluation.best_run(io.read_runs(spark, runs)).collect()
    assert [(r["run_id"], r["experiment"], r["run_name"]) for r in best] == [("first", splits, "model")]
    history = io.read_history(spark, runs)
    if hasattr(model, "trees"):
        assert history.count() == 0
        with pytest.raises(TypeError):
            jobs.explain_table(spark, out, rows, names, str(tmp_path / "terms"))
    else:
        points = quality.history_series(history.withColumn("loss", -F.col("objective")), ["objective"], "loss").orderBy("epoch").collect()
        assert [r["epoch"] for r in points] == list(range(len(points))) and len(points) > 2
        terms = jobs.explain_table(spark, out, rows, names, str(tmp_path / "terms"))
        assert terms.filter("class_name = 'a' and term = 'alpha'").count() == 1


def test_runs_without_metrics_are_not_read(spark, tmp_path):
    runs = spark.createDataFrame([("r", "e", "m", 0.9, 0.8, 0.8, "REGISTERED")], io.RUN_SCHEMA)
    history = spark.createDataFrame([("r", "m", 0, 1.5)], io.HISTORY_SCHEMA)
    assert io.read_runs(spark, str(tmp_path)).count() == 0
    io.write_run(runs, history, str(tmp_path), "r")
    history.withColumn("run_id", F.lit("broken")).write.parquet(f"{tmp_path}/history/batch=broken")
    assert [r["run_id"] for r in io.read_history(spark, str(tmp_path)).collect()] == ["r"]


def test_few_rows_are_marked(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 5).cast("int").alias("predicted_label"), (F.col("id") / 100).alias("confidence"))
    rows.write.parquet(str(tmp_path / "ref"))
    rows.limit(10).write.parquet(str(tmp_path / "cur"))
    assert jobs.monitor(spark, str(tmp_path / "ref"), str(tmp_path / "cur"), str(tmp_path / "d")).first()["too_few"] is True
    assert jobs.monitor(spark, str(tmp_path / "ref"), str(tmp_path / "ref"), str(tmp_path / "e")).first()["too_few"] is False
