"""Batch scoring: scores to probabilities, labels, confidences, names and review flags."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentloom.functions.scoring import argmax, minmax, softmax
from intentloom.operators.quality import label_lookup

CONFIDENCE_THRESHOLD = 0.5
REVIEW_MESSAGE = "Low confidence - consider human review"


def centroids(df: DataFrame, vec: str = "vec", label: str = "label") -> DataFrame:
    """Element-wise mean vector per class, added up map-side."""
    mean = Summarizer.mean(array_to_vector(F.col(vec)))
    return df.groupBy(label).agg(mean.alias("m")).select(label, vector_to_array("m").alias("centroid"))


def model_logits(
    df: DataFrame,
    make_predict: Callable,
    inputs: Sequence[str],
    shapes: Sequence[Sequence[int]] | None = None,
    out: str = "logits",
    batch_size: int = 1_024,
) -> DataFrame:
    """Add scores from any numpy model, in Arrow batches.

    ``make_predict`` runs once per Python worker and returns the function from input arrays to a
    (rows, classes) array.
    """
    predict = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=shapes
    )
    return df.withColumn(out, predict(*inputs))


def centroid_logits(
    df: DataFrame, centers: DataFrame, vec: str = "vec", measure: str = "euclidean", out: str = "logits"
) -> DataFrame:
    """Add a closeness to every class centre, in label order.

    ``measure``: minus the squared distance (euclidean), minus the sum of absolute differences
    (manhattan), or the cosine. The centres (one per class) travel with the function.
    """
    rows = centers.orderBy("label").collect()  # one row per class
    if [r["label"] for r in rows] != list(range(len(rows))):
        raise ValueError("class numbers must be 0..k-1, each with rows")
    points = np.array([r["centroid"] for r in rows])

    def make_predict():
        def predict(x: np.ndarray) -> np.ndarray:
            if measure == "cosine":
                return (x @ points.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(points, axis=1)
            distance = np.square if measure == "euclidean" else np.abs
            return np.stack([-distance(x - p).sum(axis=1) for p in points], axis=1)

        return predict

    return model_logits(df, make_predict, [vec], [[points.shape[1]]], out)


def classifier_logits(model: Model, vectors: DataFrame, out: str = "logits") -> DataFrame:
    """Add the scores of a fitted Spark classifier, such that their softmax is its probability.

    Margin models without probabilities (one-vs-rest) give their margins.
    """
    scored = model.transform(vectors)
    if "probability" in scored.columns:
        scores = F.transform(vector_to_array("probability"), lambda p: F.log(F.greatest(p, F.lit(1e-300))))
    else:
        scores = vector_to_array("rawPrediction")
    made = [c for c in scored.columns if c not in vectors.columns]
    return scored.withColumn(out, scores).drop(*made)


def batch_score(df: DataFrame, dictionary: DataFrame, logits: str = "logits", decimals: int | None = 4) -> DataFrame:
    """Replace scores by label, confidence, name, review flag and message.

    The label is the first of the largest scores; the confidence is its softmax probability.
    """
    confidence = F.array_max(softmax(logits))
    confidence = confidence if decimals is None else F.round(confidence, decimals)
    scored = df.withColumn("predicted_label", argmax(logits)).withColumn("confidence", confidence).drop(logits)
    return low_confidence(label_lookup(scored, dictionary, "predicted_label", "predicted_label_name"))


def low_confidence(df: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    flag = F.col("confidence") < threshold
    return df.withColumn("low_confidence", flag).withColumn("message", F.when(flag, REVIEW_MESSAGE))


def low_confidence_share(df: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    flagged = F.count_if("low_confidence")
    return low_confidence(df, threshold).agg(
        F.count(F.lit(1)).alias("rows"),
        flagged.alias("flagged"),
        F.round(F.try_divide(flagged, F.count(F.lit(1))), 6).alias("flagged_share"),
    )


def confidence_tiers(df: DataFrame, high: float = 0.8, medium: float = 0.5) -> DataFrame:
    c = F.col("confidence")
    tier = F.when(c >= high, "high").when(c >= medium, "medium").otherwise("low")
    return df.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"))


def prediction_summary(df: DataFrame, changed: str | None = None) -> DataFrame:
    """Rows, mean and smallest confidence, distinct labels; with ``changed``, the share of rows it marks."""
    extra = []
    if changed:
        extra = [
            F.count_if(changed).alias("labels_changed"),
            F.round(F.avg(F.col(changed).cast("double")), 6).alias("changed_share"),
        ]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("confidence"), 6).alias("mean_confidence"),
        F.round(F.min("confidence"), 6).alias("min_confidence"),
        F.countDistinct("predicted_label").alias("distinct_labels"),
        *extra,
    )


def minmax_scale(df: DataFrame, col: str = "vec", out: str = "scaled") -> DataFrame:
    return df.withColumn(out, minmax(col))
