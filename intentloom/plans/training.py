"""Classifiers on the labelled texts. SQL checks the facts of a fit and its certificate; of the others only rows are checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.operators import certificate
from intentloom.operators import training as tr
from intentloom.operators.sampling import stratified_split, with_class_weights
from intentloom.plans import jobs
from intentloom.plans.fixtures import with_views
from intentloom.sources import tables as t

FEATURES = tr.features.MAX_FEATURES
TREES = 200
SHOTS = tr.SHOT_COUNTS
TRIALS = tr.N_TRIALS


def _splits(spark, d):
    table = stratified_split(t.samples(spark, d))
    return [table.filter(F.col("split") == name).drop("split") for name in ("train", "val", "test")]


def _vectors(spark, d, evaluate_on="test"):
    train, val, test = _splits(spark, d)
    held_out = test if evaluate_on == "test" else val
    return tr.prepare(train, held_out, FEATURES)


def _estimators(n: int) -> dict:
    return {
        "tfidf_logreg": tr.logreg(n),
        "tfidf_svm": tr.linear_svc(n),
        "tfidf_forest": tr.random_forest(n, trees=TREES),
    }


def _train(name):
    def run(spark, d):
        train, test, _ = _vectors(spark, d)
        return tr.train_and_evaluate(name, _estimators(train.count())[name], train, test)[1]

    return run


def logreg_certificate(spark, d):
    """What holds for a fit whatever its solver: its rows, classes and weights, and that it is close to the optimum."""
    train, _, test = _splits(spark, d)
    vectors, held_out, vocab = tr.prepare(train, test, FEATURES)
    n = vectors.count()
    model, metrics = tr.train_and_evaluate("tfidf_logreg", tr.logreg(n, tol=tr.CERTIFIED_TOLERANCE), vectors, held_out)
    weighted = with_class_weights(train)
    found = certificate.logreg_certificate(weighted, model, vocab, 1.0 / n)
    facts = weighted.agg(F.countDistinct("label").alias("classes"), F.round(F.sum("weight"), 6).alias("weight_sum")).first()
    got = metrics.first()
    return found.select(
        F.col("rows").alias("train_rows"), F.lit(held_out.count()).cast("long").alias("test_rows"), F.lit(facts["classes"]).cast("long").alias("classes"),
        F.lit(facts["weight_sum"]).alias("weight_sum"), F.lit(got["f1_micro"] == got["accuracy"]).alias("micro_is_accuracy"), "certified",
    )


def model_sweep(spark, d):
    train, test, _ = _vectors(spark, d)
    return tr.model_sweep(train, test, _estimators(train.count()))[0]


def learning_curve(spark, d):
    train, _, test = _splits(spark, d)
    return tr.learning_curve(train, test, tr.logreg, SHOTS, FEATURES)


def param_search(spark, d):
    train, val, _ = _vectors(spark, d, "val")
    return tr.param_search(train, val, train.count(), TRIALS)


def batch_score_model(spark, d):
    """Score the test split with a freshly trained model, by its own vocabulary."""
    train, _, test = _splits(spark, d)
    vectors, _, vocab = tr.prepare(train, test, FEATURES)
    model = tr.logreg(vectors.count()).fit(vectors)
    names = t.samples(spark, d).select("label", "label_name").distinct()
    out = jobs.score(test.select("sample_id", "text", "label"), model, vocab, names)
    return out.select("sample_id", "label", "predicted_label", "predicted_label_name", "confidence", "low_confidence")


def explain_model(spark, d):
    train, _, test = _splits(spark, d)
    vectors, _, vocab = tr.prepare(train, test, FEATURES)
    model = tr.logreg(vectors.count()).fit(vectors)
    names = {r["label"]: r["label_name"] for r in t.samples(spark, d).select("label", "label_name").distinct().collect()}
    return jobs.explain_model(test, model, vocab, names)


QUERIES = {
    "batch_score_model": batch_score_model,
    "explain_model": explain_model,
    "logreg_certificate": logreg_certificate,
    "train_logreg": _train("tfidf_logreg"),
    "train_linear_svc": _train("tfidf_svm"),
    "train_random_forest": _train("tfidf_forest"),
    "model_sweep": model_sweep,
    "learning_curve": learning_curve,
    "param_search": param_search,
}
ORACLE = {
    "logreg_certificate": with_views(
        """c as (select label, count(*) as n from samples where label is not null group by 1),
          f as (select n * 70 // 100 as train, n - n * 85 // 100 as test from c)
          select sum(train)::bigint as train_rows, sum(test)::bigint as test_rows, count(*) as classes,
            round(sum(train)::double, 6) as weight_sum, true as micro_is_accuracy, true as certified from f""",
        "samples",
    ),
}
