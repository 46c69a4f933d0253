"""Feature attribution of linear models over all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small


def coefficient_table(model, terms_by_idx: DataFrame, label_names: dict[int, str] | None = None) -> DataFrame:
    """(class, term, w) of a fitted Spark linear model, over the limited vocabulary.

    Handles a multinomial logistic regression and a one-vs-rest linear model; a forest has no
    coefficients and raises.
    """
    if hasattr(model, "coefficientMatrix"):
        matrix = model.coefficientMatrix.toArray()
    elif hasattr(model, "models") and all(hasattr(m, "coefficients") for m in model.models):
        matrix = np.vstack([m.coefficients.toArray() for m in model.models])
    else:
        raise TypeError("attribution needs a linear model")
    c, f = np.nonzero(matrix)
    names = [(label_names or {}).get(int(i), str(int(i))) for i in c]
    table = pd.DataFrame({"class_name": names, "idx": f.astype("int64"), "w": matrix[c, f]})
    spark = terms_by_idx.sparkSession
    schema = "class_name string, idx bigint, w double"
    return spark.createDataFrame(table, schema).join(broadcast_small(terms_by_idx.select("term", "idx")), "idx").drop("idx")


def feature_spread(features: DataFrame, n_rows: int) -> DataFrame:
    """Mean over all rows of |x - mean x| per term.

    ``features`` is sparse: a row without the term has x = 0 and adds |mean x|.
    """
    n = F.lit(float(n_rows))
    means = features.groupBy("term").agg((F.sum("weight") / n).alias("mean_x"), F.count(F.lit(1)).alias("nnz"))
    gaps = (
        features.join(broadcast_small(means), "term")
        .groupBy("term")
        .agg(
            F.sum(F.abs(F.col("weight") - F.col("mean_x"))).alias("gap"),
            F.max("mean_x").alias("mean_x"),
            F.max("nnz").alias("nnz"),
        )
    )
    zeros = (n - F.col("nnz")) * F.abs("mean_x")
    return gaps.select("term", ((F.col("gap") + zeros) / n).alias("spread"))


def class_importance(coefficients: DataFrame, spread: DataFrame) -> DataFrame:
    """Mean |w * (x - mean x)| per (class, term): |w| times the term's spread."""
    return coefficients.join(broadcast_small(spread), "term").select(
        "class_name", "term", (F.abs("w") * F.col("spread")).alias("importance")
    )


def linear_attribution(coefficients: DataFrame, spread: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` terms of each class."""
    rounded = class_importance(coefficients, spread).withColumn("importance", F.round("importance", 6))
    order = W.partitionBy("class_name").orderBy(F.desc("importance"), "term")  # vocabulary-sized groups
    return rounded.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def global_importance(coefficients: DataFrame, spread: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` terms by importance summed over classes."""
    total = class_importance(coefficients, spread).groupBy("term").agg(F.round(F.sum("importance"), 6).alias("importance"))
    return total.orderBy(F.desc("importance"), "term").limit(top)
