from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from intentloom.operators import certificate, explain, training
from intentloom.plans import training as plans


@pytest.fixture(scope="module")
def vectors(spark):
    """Three classes told apart by one word each, with noise words."""
    rows = []
    for i in range(240):
        label = i % 3 if i % 8 else 0
        rows.append((i, f"{['alpha', 'beta', 'gamma'][label]} word{i % 5} word{i % 7} filler", label))
    df = spark.createDataFrame(rows, "sample_id long, text string, label int")
    train, test = df.filter("sample_id % 4 <> 3"), df.filter("sample_id % 4 = 3")
    return training.prepare(train, test, 50), train, test


@pytest.mark.parametrize("make", [training.logreg, training.linear_svc, lambda n: training.random_forest(n, trees=20, depth=5)])
def test_models_learn(vectors, make):
    (train, test, _), _, _ = vectors
    _, metrics = training.train_and_evaluate("m", make(train.count()), train, test)
    assert metrics.first()["accuracy"] >= 0.95


def test_sweep_ranks_and_saves(spark, vectors, tmp_path):
    (train, test, _), _, _ = vectors
    models = {"strong": training.logreg(train.count()), "weak": training.logreg(train.count(), c=1e-9)}
    ranked, best, _, fitted = training.model_sweep(train, test, models, save_to=str(tmp_path / "model"))
    assert best == "strong" and [r["model"] for r in ranked.orderBy("rank").collect()] == ["strong", "weak"]
    assert LogisticRegressionModel.load(str(tmp_path / "model")).numClasses == 3
    assert set(fitted) == {"strong", "weak"} and len(training.objective_history(fitted["strong"])) > 1


def test_vocabulary_is_of_the_training_split_only(vectors):
    (_, _, vocab), _, _ = vectors
    assert vocab.count() <= 50 and vocab.filter(F.col("term") == "alpha").count() == 1


def test_learning_curve_marks_one_best(vectors):
    _, train, test = vectors
    rows = training.learning_curve(train, test, lambda n: training.logreg(n, max_iter=20), (2, 8), 50).collect()
    assert [r["train_rows"] for r in sorted(rows, key=lambda r: r["shots"])] == [6, 24]
    assert sum(r["best"] for r in rows) == 1


def test_search_is_seeded(vectors):
    assert training.draw_trials(5) == training.draw_trials(5)
    (train, test, _), _, _ = vectors
    rows = training.param_search(train, test, train.count(), 2).collect()
    assert len(rows) == 2 and sum(r["best"] for r in rows) == 1


def test_attribution_of_fitted_models(vectors):
    (train, test, vocab), _, _ = vectors
    model, _ = training.train_and_evaluate("lr", training.logreg(train.count()), train, test)
    table = explain.coefficient_table(model, vocab, {0: "a", 1: "b", 2: "c"})
    strongest = table.filter("class_name = 'b'").orderBy(F.desc("w")).first()
    assert strongest["term"].startswith("beta")
    svc, _ = training.train_and_evaluate("svc", training.linear_svc(train.count(), max_iter=20), train, test)
    assert explain.coefficient_table(svc, vocab).select("class_name").distinct().count() == 3
    forest, _ = training.train_and_evaluate("rf", training.random_forest(train.count(), trees=3, depth=3), train, test)
    with pytest.raises(TypeError):
        explain.coefficient_table(forest, vocab)


def test_forest_keeps_the_rows_nodes_and_grows_the_same_trees(vectors):
    (train, _, _), _, _ = vectors
    forest = training.random_forest(train.count(), trees=5, depth=6)
    assert forest.getCacheNodeIds()
    assert forest.fit(train).toDebugString.split("\n")[1:] == forest.copy({forest.cacheNodeIds: False}).fit(train).toDebugString.split("\n")[1:]


def test_fits_are_not_cut_short(spark):
    forest = plans._estimators(100)["tfidf_forest"]
    assert forest.getMaxDepth() == 30 and forest.getNumTrees() == 200
    assert {p["max_iter"] for p in training.draw_trials(50)} == {training.logreg(100).getMaxIter()}


def objective_and_gradient(x, y, v, model, reg):
    b, b0 = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    z = x @ b.T + b0
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    r = v[:, None] * (p - np.eye(len(b0))[y])
    loss = -(v * np.log(p[np.arange(len(y)), y])).sum() / v.sum()
    return loss + reg / 2 * (b**2).sum(), r.T @ x / v.sum() + reg * b, np.abs(r.sum(axis=0)).max() / v.sum()


@pytest.mark.parametrize("iterations, certified", [(1, False), (1000, True)])
def test_certificate_equals_dense_numpy(vectors, iterations, certified):
    (train, _, vocab), rows, _ = vectors
    n = train.count()
    model = training.logreg(n, max_iter=iterations).fit(train)
    held = train.select("features", "label", "weight").collect()
    x = np.array([r["features"].toArray() for r in held])
    y, v = np.array([r["label"] for r in held]), np.array([r["weight"] for r in held])
    objective, gradient, free = objective_and_gradient(x, y, v, model, 1 / n)
    weighted = training.sampling.with_class_weights(rows).unionByName(
        rows.limit(1).select("sample_id", "text", F.lit(None).cast("int").alias("label"), F.lit(None).cast("double").alias("weight"))
    )
    got = certificate.logreg_certificate(weighted, model, vocab, 1 / n).first()
    assert got["rows"] == n and got["certified"] == certified
    assert got["objective"] == pytest.approx(objective) and got["intercept_gradient"] == pytest.approx(free, abs=1e-9)
    assert got["gap"] == pytest.approx((gradient**2).sum() * n / 2, rel=1e-6, abs=1e-12)


def test_as_many_fits_at_a_time_as_memory_holds(vectors, monkeypatch):
    """Blocks of fits that lie on disk are read at every iteration, and many at a time can end the executors."""
    (train, test, _), _, _ = vectors
    cells = sum(r["features"].numNonzeros() for r in train.select("features").collect())
    running, most, parts = [], [], []
    fit_svc, fit_lr = training.OneVsRest.fit, training.LogisticRegression.fit

    def counted(self, data):
        running.append(1)
        most.append(len(running))
        try:
            return fit_lr(self, data)
        finally:
            running.pop()

    monkeypatch.setattr(training.LogisticRegression, "fit", counted)
    monkeypatch.setattr(training.OneVsRest, "fit", lambda self, data: parts.append(self.getParallelism()) or fit_svc(self, data))
    found = []
    for room in (1 << 30, 2 * 12 * cells, 12 * cells - 1):
        monkeypatch.setattr(training, "storage_room", lambda spark, room=room: room, raising=False)
        most.clear()
        _, metrics = training.fit_all({str(c): training.logreg(180, c=c) for c in (0.1, 1.0, 10.0, 100.0)}, train, test)
        _, svc = training.train_and_evaluate("svc", training.linear_svc(180, max_iter=20), train, test)
        found.append((max(most), parts[-1], sorted(metrics.collect()) + svc.collect()))
    assert [f[:2] for f in found] == [(3, 4), (2, 2), (1, 1)]
    assert found[0][2] == found[1][2] == found[2][2]


def test_room_is_that_of_the_session(spark):
    assert 0 < training.storage_room(spark) < 6 << 30
