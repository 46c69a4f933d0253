"""How far a fitted multinomial regression is from the optimum of its stated objective, without its trainer.

The objective is the weighted mean of the log losses plus ``reg / 2`` times the squared coefficients;
intercepts are free. Loss and gradient are Spark aggregations over the TF-IDF terms, kept as one array per row. The objective is
strongly convex in the coefficients with modulus ``reg``, so with these intercepts no coefficients can be
better by more than |gradient|^2 / (2 reg): that is the gap.

Defined results: rows without a known term take part with their intercepts only; rows without a label
have no weight and are left out; a term that no row holds still counts with its penalty.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.functions.text import let
from intentloom.operators import features
from intentloom.session import through_table

GAP = 0.01  # of the objective
INTERCEPTS = 1e-3
CELLS = "array<struct<idx:bigint,x:double>>"


def _plus(values: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, values)


def _held_cells(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per id its ``_members`` of (y, v) and its terms as ``_cells`` of (idx, x), as in the long TF-IDF table.

    Rows of one id share their terms; a row without an id keeps none.
    """
    member = F.struct("y", "v")
    cells = F.flatten(F.collect_list("_cells"))
    held = features.with_cells(rows.filter("id is not null"), vocab)[0].groupBy("id").agg(F.collect_list(member).alias("_members"), cells.alias("_raw"))
    norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, c: a + c["raw"] * c["raw"]))
    scaled = let(norm, lambda n: F.transform("_raw", lambda c: F.struct(c["idx"].alias("idx"), (c["raw"] / n).alias("x"))))
    bare = rows.filter("id is null").select(F.array(member).alias("_members"), F.array().cast(CELLS).alias("_cells"))
    return held.select("_members", scaled.cast(CELLS).alias("_cells")).unionByName(bare)


def _margins(matrix: np.ndarray, intercepts: list[float]):
    """Per row the margin of every class."""

    @F.arrow_udf("array<double>")
    def margins(cells: pa.Array) -> pa.Array:
        lengths = pc.list_value_length(cells).to_numpy(zero_copy_only=False)
        idx, x = cells.flatten().flatten()
        row = np.repeat(np.arange(len(cells)), lengths)
        idx, x = idx.to_numpy(zero_copy_only=False), x.to_numpy(zero_copy_only=False)
        z = [b + np.bincount(row, w[idx] * x, len(cells)) for w, b in zip(matrix, intercepts)]
        offsets = pa.array(np.arange(len(cells) + 1) * len(intercepts), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(np.stack(z, axis=1).ravel()))

    return margins


def logreg_certificate(
    train: DataFrame, model, vocab: DataFrame, reg: float, id_col: str = "sample_id", label: str = "label", weight: str = "weight"
) -> DataFrame:
    """One row: rows, objective, gap, intercept_gradient and certified, for the rows a model was fitted on.

    ``train`` has text, label (0 to classes - 1) and weight; ``model`` gives coefficients and intercepts.
    """
    spark = train.sparkSession
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray().tolist()
    classes = range(len(intercepts))
    coefficients = spark.createDataFrame([(i, w) for i, w in enumerate(matrix.T.tolist())], "idx long, w array<double>")  # the vocabulary
    rows = train.filter(F.col(label).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), F.col(weight).cast("double").alias("v"), "text"
    )
    known = _held_cells(rows, vocab).withColumn("z", _margins(matrix, intercepts)("_cells")).select(F.inline("_members"), "_cells", "z")
    top = known.withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, b: a + F.exp(b - F.col("top")))
    shares = let(total, lambda s: F.transform("z", lambda b, c: F.col("v") * (F.exp(b - F.col("top")) / s - (c == F.col("y")).cast("double"))))
    loss = F.col("v") * (F.col("top") + F.log(total) - F.get("z", F.col("y")))
    residuals = through_table(top.select("v", shares.alias("r"), loss.alias("loss"), "_cells"), "residuals")

    of_class = [F.sum(F.get("r", F.lit(c))) for c in classes]
    sums = residuals.agg(F.count(F.lit(1)), F.sum("v"), F.sum("loss"), *of_class).first()
    n, weighed, lost, free = sums[0], sums[1] or 1.0, sums[2] or 0.0, [s or 0.0 for s in sums[3:]]
    pulls = [F.sum(F.col("x") * F.get("r", F.lit(c))).alias(f"g{c}") for c in classes]
    pulled = residuals.select("r", F.inline("_cells")).groupBy("idx").agg(*pulls)
    parts = [F.coalesce(f"g{c}", F.lit(0.0)) / weighed + reg * F.get("w", F.lit(c)) for c in classes]
    squares = coefficients.join(pulled, "idx", "left").agg(
        F.sum(_plus([p * p for p in parts])), F.sum(_plus([F.get("w", F.lit(c)) * F.get("w", F.lit(c)) for c in classes]))
    )
    slope, size = squares.first()
    objective, gap, free = lost / weighed + reg / 2 * size, slope / (2 * reg), max(abs(g) / weighed for g in free)
    certified = gap <= GAP * objective and free <= INTERCEPTS
    return spark.createDataFrame(
        [(n, objective, gap, free, certified)], "rows long, objective double, gap double, intercept_gradient double, certified boolean"
    )
