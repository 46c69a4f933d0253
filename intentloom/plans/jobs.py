"""The whole jobs: prepare, train, score, explain, monitor. Each reads and writes tables.

    spark-submit intentloom/plans/jobs.py prepare --first a.parquet --second b.parquet --out splits
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegressionModel, OneVsRestModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.operators import drift, evaluation, explain, features, quality, sampling, scoring, training
from intentloom.session import drop_scratch, through_table
from intentloom.sources import io


def prepare(spark: SparkSession, first: str, second: str, out: str, id_col: str = "sample_id") -> DataFrame:
    """Append the two tables, check the rows, split them and write the splits; returns the check."""
    whole = io.load_union(spark.read.parquet(first), spark.read.parquet(second), id_col)
    check = broadcast_small(quality.validate_split(whole, "all", quality.full_rules()))
    if not check.first()["schema_passed"]:
        return check
    io.write_splits(sampling.stratified_split(whole, id_col=id_col), out)
    return check


def default_models(n_rows: int) -> dict:
    return {
        "tfidf_logreg": training.logreg(n_rows),
        "tfidf_svm": training.linear_svc(n_rows),
        "tfidf_forest": training.random_forest(n_rows),
    }


def train(
    spark: SparkSession,
    splits: str,
    out: str,
    models: Callable[[int], Mapping] = default_models,
    max_features: int = features.MAX_FEATURES,
    augment: bool = False,
    threshold: float = 0.90,
    runs: str | None = None,
    run: str | None = None,
) -> tuple[DataFrame, Model, DataFrame]:
    """Train all models on the train split, rank them on the test split, write model and reports.

    Returns the ranking with the release status of each, the best model and the vocabulary. The
    models judged are the ones just trained. The checks of the validation gate on the best one are written
    beside it. With ``runs``, a run log, the run is added to it under the name ``run``.
    """
    table = io.read_splits(spark, splits, ["train", "test"])
    train_rows, test_rows = (table.filter(F.col("split") == n).select("sample_id", "text", "label") for n in ("train", "test"))
    if augment:
        more = sampling.augment_minority(train_rows)
        new_id = F.concat_ws("-", "source_id", "copy_no")
        train_rows = more.select(new_id.alias("sample_id"), "text", "label")
    train_vectors, test_vectors, vocab = training.prepare(train_rows, test_rows, max_features)
    estimators = models(train_vectors.count())
    ranked, best, model, fitted = training.model_sweep(train_vectors, test_vectors, estimators, f"{out}/model")
    vocab.write.mode("overwrite").parquet(f"{out}/vocabulary")
    io.write_metrics_json(ranked.filter("rank = 1"), f"{out}/metrics")
    scored = model.transform(test_vectors).select("label", F.col("prediction").cast("int").alias("predicted_label"))
    io.write_report_csv(evaluation.per_class_report(scored), f"{out}/report")
    logits = scoring.classifier_logits(model, test_vectors)
    no_log = spark.createDataFrame([], "latency_ms double")
    checks = evaluation.validation_gate(ranked.filter("rank = 1"), no_log, quality.nan_logit_check(logits), threshold, threshold)
    checks.write.mode("overwrite").json(f"{out}/validation")
    status = F.when(F.col("f1_weighted") < threshold, "NOT_REGISTERED").otherwise("REGISTERED")
    ranked = ranked.withColumn("status", status)
    if runs:
        log_run(spark, ranked, fitted, runs, run or uuid.uuid4().hex, experiment=splits)
    return ranked, model, vocab


def log_run(spark: SparkSession, ranked: DataFrame, fitted: Mapping[str, Model], path: str, run: str, experiment: str) -> None:
    """Add the metrics of all models of a run, and what their objective was after each iteration."""
    columns = ["accuracy", "f1_macro", "f1_weighted", "status"]
    rows = ranked.select(F.lit(run).alias("run_id"), F.lit(experiment).alias("experiment"), F.col("model").alias("run_name"), *columns)
    points = [(run, name, i, float(v)) for name, model in fitted.items() for i, v in enumerate(training.objective_history(model))]
    io.write_run(rows, spark.createDataFrame(points, io.HISTORY_SCHEMA), path, run)


def load_model(spark: SparkSession, path: str) -> Model:
    """A saved classifier of any of the three kinds."""
    kind = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"].rsplit(".", 1)[1]
    kinds = {m.__name__: m for m in (LogisticRegressionModel, OneVsRestModel, RandomForestClassificationModel)}
    return kinds[kind].load(path)


def score_table(spark: SparkSession, model: str, rows: str, dictionary: str, out: str) -> DataFrame:
    """Score the table ``rows`` with what ``train`` left in ``model``; writes the predictions, returns their summary."""
    vocab, names = spark.read.parquet(f"{model}/vocabulary"), spark.read.parquet(dictionary).select("label", "label_name")
    scored = score(spark.read.parquet(rows), load_model(spark, f"{model}/model"), vocab, names)
    scored.write.mode("overwrite").parquet(out)
    return scoring.prediction_summary(spark.read.parquet(out))


def explain_table(spark: SparkSession, model: str, rows: str, dictionary: str, out: str) -> DataFrame:
    """The strongest terms of every class of a stored linear model over the table ``rows``; writes and returns them."""
    named = spark.read.parquet(dictionary).select("label", "label_name").limit(MAX_CLASSES + 1).collect()
    if len(named) > MAX_CLASSES:
        raise ValueError(f"the dictionary has more than {MAX_CLASSES} classes")
    names = {r["label"]: r["label_name"] for r in named}
    made = explain_model(spark.read.parquet(rows), load_model(spark, f"{model}/model"), spark.read.parquet(f"{model}/vocabulary"), names)
    made.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def vector_size(model: Model) -> int:
    """Number of features a fitted classifier reads; a one-vs-rest model has it in its parts."""
    return model.models[0].numFeatures if isinstance(model, OneVsRestModel) else model.numFeatures


def score(rows: DataFrame, model: Model, vocab: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Score a table of (sample_id, text, ...) with a trained model."""
    vectors = features.stored_tfidf_vectors(rows, vocab, size=vector_size(model))
    return scoring.batch_score(scoring.classifier_logits(model, vectors).drop("features"), dictionary)


def explain_model(rows: DataFrame, model: Model, vocab: DataFrame, names: dict[int, str], top: int = 20) -> DataFrame:
    """The ``top`` terms of every class of a linear model, over all ``rows``."""
    long = through_table(features.tfidf_features(rows, vocab), "tfidf")
    spread = explain.feature_spread(long, rows.count())
    return explain.linear_attribution(explain.coefficient_table(model, vocab, names), spread, top)


MAX_CLASSES = 10_000  # class names are a list on the driver
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def monitor(
    spark: SparkSession, reference: str, current: str, out: str, id_cols: tuple[str, ...] = ("text",), min_samples: int = 50
) -> DataFrame:
    """Compare two prediction tables on their shared columns; writes and returns the decision row.

    ``id_cols`` are not compared. A label column counts as a category, whatever its type. With fewer than
    ``min_samples`` current rows the decision is made all the same and marked as ``too_few``.
    """
    few = quality.min_samples_guard(spark.read.parquet(current), min_samples)
    sides = quality.shared_columns(spark.read.parquet(reference), spark.read.parquet(current), ("created_at", *id_cols))
    if "error" in sides.columns:
        return sides
    kinds = {c: k for c, k in sides.dtypes if c != "side"}
    numeric = [c for c, k in kinds.items() if k in NUMERIC and "label" not in c]
    categories = [c for c in kinds if c not in numeric]
    parts = []
    if numeric:
        parts.append(drift.numeric_drift(sides, numeric).select("column", "drifted"))
    if categories:
        parts.append(drift.categorical_drift(sides, categories).select("column", "drifted"))
    summary = drift.drift_summary(*parts)
    checked = drift.alert_check(
        summary,
        drift.confidence_drop(sides) if "confidence" in kinds else None,
        drift.label_shift(sides) if "predicted_label" in kinds else None,
    )
    decided = drift.retrain_trigger(checked).withColumn("too_few", few.select("too_few").scalar())
    decision = broadcast_small(decided)
    decision.write.mode("overwrite").json(out)
    return decision


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="job", required=True)
    for job, names in {
        "prepare": ("first", "second", "out"),
        "train": ("splits", "out"),
        "score": ("model", "rows", "dictionary", "out"),
        "explain": ("model", "rows", "dictionary", "out"),
        "monitor": ("reference", "current", "out"),
    }.items():
        command = commands.add_parser(job)
        for name in names:
            command.add_argument(f"--{name}", required=True)
        if job == "train":
            command.add_argument("--runs", help="folder of the run log")
    args = vars(parser.parse_args())
    job = args.pop("job")
    spark = SparkSession.builder.appName(f"intentloom-{job}").getOrCreate()
    jobs = {"prepare": prepare, "train": train, "score": score_table, "explain": explain_table, "monitor": monitor}
    result = jobs[job](spark, **args)
    (result[0] if job == "train" else result).show(truncate=False)
    drop_scratch(spark)


if __name__ == "__main__":
    main()
