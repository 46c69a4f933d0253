"""Classical classifiers on TF-IDF with Spark ML, model sweep, learning curve and search."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions.hashing import SEED
from intentloom.operators import evaluation, features, sampling
from intentloom.session import through_table

SHOT_COUNTS = (2, 4, 8, 16, 32)
N_TRIALS = 20
MAX_ITER = 1_000
TOLERANCE = 1e-4  # relative change at which a fit stops: within 0.1 % of the optimum by ``certificate`` on the given texts
CERTIFIED_TOLERANCE = 1e-6  # for a fit whose intercepts, too, shall be at rest
CELL_BYTES = 12  # of a vector's cell in the blocks that a fit stores: an index and a value


def logreg(n_rows: int, c: float = 1.0, max_iter: int = MAX_ITER, tol: float = TOLERANCE) -> Estimator:
    """L2 strength 1 / (C * rows), the per-row form of the usual C, on the features as they are."""
    return LogisticRegression(
        family="multinomial", regParam=1.0 / (c * n_rows), maxIter=max_iter, tol=tol, weightCol="weight", standardization=False
    )


def linear_svc(n_rows: int, c: float = 1.0, max_iter: int = 2_000) -> Estimator:
    svc = LinearSVC(regParam=1.0 / (c * n_rows), maxIter=max_iter, tol=TOLERANCE, standardization=False)
    return OneVsRest(classifier=svc, weightCol="weight", parallelism=4)


def random_forest(n_rows: int, trees: int = 200, depth: int = 30) -> Estimator:
    """Each row's node of every tree is kept from pass to pass: else each pass sends all trees out and walks every row down from their roots."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=SEED, weightCol="weight", featureSubsetStrategy="sqrt", cacheNodeIds=True
    )


def prepare(
    train: DataFrame, test: DataFrame, max_features: int = features.MAX_FEATURES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors of both splits, with the vocabulary of the training split only: (train, test, vocabulary)."""
    vocab = features.broadcast_small(features.vocabulary(train, max_features))
    weighted = sampling.with_class_weights(train)
    cols = ["sample_id", "text", "label"]
    # every fit reads its vectors many times: they are made once
    return (
        features.stored_tfidf_vectors(weighted.select(*cols, "weight"), vocab, size=max_features),
        features.stored_tfidf_vectors(test.select(*cols), vocab, size=max_features),
        vocab,
    )


def storage_room(spark: SparkSession) -> int:
    """Bytes that the executors can keep in memory, all together; of a session without any, the driver."""
    status = spark._jsc.sc().getExecutorMemoryStatus().toList()
    room = {status.apply(i)._1(): status.apply(i)._2()._1() for i in range(status.size())}
    own = room.pop(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort(), 0)
    return sum(room.values()) or own


def fits_held(vectors: DataFrame) -> int:
    """How many fits' own blocks of these stored vectors fit into the executors' memory at a time, one at least.

    Past it the blocks lie on disk, and every iteration of every fit reads them from there.
    """
    stored = vectors.sparkSession.read.parquet(*vectors.inputFiles())
    cells = stored.agg(F.sum(F.size("features.values"))).first()[0] or 0
    return max(1, storage_room(vectors.sparkSession) // max(1, CELL_BYTES * cells))


def train_and_evaluate(
    name: str, estimator: Estimator, train_vectors: DataFrame, test_vectors: DataFrame, held: int | None = None
) -> tuple[Model, DataFrame]:
    """Fit one model; its metrics on the test vectors as one row. ``held`` of its parts, as far as known, are fitted at a time."""
    if isinstance(estimator, OneVsRest):
        held = fits_held(train_vectors) if held is None else held
        estimator = estimator.copy({estimator.parallelism: max(1, min(held, estimator.getParallelism()))})
    model = estimator.fit(train_vectors)
    scored = model.transform(test_vectors).select("label", F.col("prediction").cast("int").alias("predicted_label"))
    metrics = evaluation.classification_metrics(scored)
    return model, metrics.select(F.lit(name).alias("model"), *evaluation.METRICS)


def fit_all(
    estimators: Mapping[str, Estimator], train_vectors: DataFrame, test_vectors: DataFrame, parallelism: int = 3
) -> tuple[dict[str, Model], DataFrame]:
    """Fit several models at a time, as a cross-validator does: their fits share the cluster.

    Fewer at a time where their blocks would not fit into memory side by side; the models are the same.
    Returns the models and one metrics row per model.
    """
    held = fits_held(train_vectors)
    at_once = max(1, min(parallelism, held))
    fit = inheritable_thread_target(train_vectors.sparkSession)(
        lambda item: train_and_evaluate(*item, train_vectors, test_vectors, held // at_once)
    )
    with ThreadPool(at_once) as pool:
        results = dict(zip(estimators, pool.map(fit, estimators.items(), chunksize=1)))
    metrics = reduce(DataFrame.unionByName, [row for _, row in results.values()])
    return {name: model for name, (model, _) in results.items()}, features.broadcast_small(metrics)


def model_sweep(
    train_vectors: DataFrame, test_vectors: DataFrame, estimators: Mapping[str, Estimator], save_to: str | None = None
) -> tuple[DataFrame, str, Model, dict[str, Model]]:
    """All models on the same vectors: (ranked metrics, best name, best model, all models); the best is saved if asked."""
    fitted, metrics = fit_all(estimators, train_vectors, test_vectors)
    ranked = evaluation.model_comparison(metrics)
    best = ranked.filter("rank = 1").first()["model"]
    if save_to:
        fitted[best].write().overwrite().save(save_to)
    return ranked, best, fitted[best], fitted


def objective_history(model: Model) -> list[float]:
    """The objective after each iteration of a fitted linear model (of one against the rest: all parts in turn); a
    forest has none. A model read from a file does not know it any more."""
    if isinstance(model, RandomForestClassificationModel):
        return []
    parts = model.models if isinstance(model, OneVsRestModel) else [model]
    return [v for m in parts if getattr(m, "hasSummary", False) for v in _summary(m).objectiveHistory]


def _summary(model: Model):
    return model.summary() if callable(model.summary) else model.summary


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    make: Callable[[int], Estimator],
    shots: tuple[int, ...] = SHOT_COUNTS,
    max_features: int = features.MAX_FEATURES,
) -> DataFrame:
    """For each number of shots: draw, train, evaluate on the whole test split; the best one is marked."""
    rows = None
    for n in shots:
        drawn = through_table(sampling.few_shot_sample(train, n), "shots")
        size = drawn.count()
        train_vectors, test_vectors, _ = prepare(drawn, test, max_features)
        _, metrics = train_and_evaluate(f"{n}-shot", make(size), train_vectors, test_vectors)
        row = metrics.select(F.lit(n).alias("shots"), F.lit(size).alias("train_rows"), *evaluation.METRICS)
        rows = row if rows is None else rows.unionByName(row)
    rows = features.broadcast_small(rows)
    best = rows.orderBy(F.desc("f1_macro"), "shots").first()["shots"]
    return rows.withColumn("best", F.col("shots") == best)


def draw_trials(n_trials: int, seed: int = SEED) -> list[dict[str, float]]:
    """Seeded points of the search space: C log-uniform; every fit goes on to convergence within ``MAX_ITER``."""
    rng = random.Random(seed)
    return [{"c": 10 ** rng.uniform(-2, 2), "max_iter": MAX_ITER} for _ in range(n_trials)]


def param_search(train_vectors: DataFrame, val_vectors: DataFrame, n_rows: int, n_trials: int = N_TRIALS) -> DataFrame:
    """Seeded random search for the highest validation macro F1: one row per trial, the best marked."""
    trials = draw_trials(n_trials)
    estimators = {str(i): logreg(n_rows, c=p["c"], max_iter=p["max_iter"]) for i, p in enumerate(trials)}
    _, metrics = fit_all(estimators, train_vectors, val_vectors)
    points = train_vectors.sparkSession.createDataFrame(
        [(str(i), i, p["c"], p["max_iter"]) for i, p in enumerate(trials)], "model string, trial int, c double, max_iter int"
    )
    rows = points.join(metrics, "model").select("trial", "c", "max_iter", "f1_macro")
    best = metrics.orderBy(F.desc("f1_macro"), F.col("model").cast("int")).first()["model"]
    return rows.withColumn("best", F.col("trial") == int(best))
