"""The most similar classes: an exact top-n join of class vectors, tile by tile.

Class vectors are sorted by their heaviest term and cut into blocks. Each block is first compared with
itself; the n-th best similarity found there is a floor for the answer. Two blocks can hold a better pair
only if the product of their term-wise greatest weights reaches that floor; only such pairs of blocks are
multiplied. A tile hands out no more than its own best pairs, so a task holds two blocks and one tile.

Defined results: rows without a class or a term are left out; classes that share no term are no pair; a
vector without weight is similar to none; fewer than n pairs are all returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.session import through_table

BLOCK = 256  # classes
COLUMNS = 8_192  # terms multiplied at a time
SAME = 1e-6  # similarities are compared as rounded to six places
BLOCKS = "block long, names array<string>, sizes array<int>, idx array<int>, w array<double>"
PAIRS = "class_a string, class_b string, similarity double"


def _dense(sizes: np.ndarray, idx: np.ndarray, w: np.ndarray, columns: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.minimum(np.searchsorted(columns, idx), len(columns) - 1)
    held = columns[at] == idx
    out = np.zeros((len(sizes), len(columns)))
    out[row[held], at[held]] = w[held]
    return out


def _best_pairs(x: dict, y: dict, same: bool, n: int) -> tuple[list, list, list]:
    """The n best pairs of two blocks, and those that rounding cannot tell from the last of them."""
    common = np.intersect1d(x["idx"], y["idx"])
    dots = np.zeros((len(x["sizes"]), len(y["sizes"])))
    for at in range(0, len(common), COLUMNS):
        columns = common[at : at + COLUMNS]
        dots += _dense(x["sizes"], x["idx"], x["w"], columns) @ _dense(y["sizes"], y["idx"], y["w"], columns).T
    if same:
        dots = np.triu(dots, 1)
    i, j = np.nonzero(dots)
    found = dots[i, j]
    if len(found) > n:
        kept = found >= np.partition(found, -n)[-n] - SAME
        i, j, found = i[kept], j[kept], found[kept]
    names = [sorted((x["names"][a], y["names"][b])) for a, b in zip(i.tolist(), j.tolist())]
    return [a for a, _ in names], [b for _, b in names], found.tolist()


def _tiles(n: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a row is a block, or two
                sides = []
                for side in ("x",) if same else ("x", "y"):
                    whole = batch.column(batch.schema.get_field_index(side))[at]
                    block = {c: whole[c].values.to_numpy(zero_copy_only=False) for c in ("sizes", "idx", "w")}
                    sides.append({**block, "names": whole["names"].as_py()})
                a, b, dots = _best_pairs(sides[0], sides[-1], same, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(dots, pa.float64())], ["class_a", "class_b", "similarity"]
                )

    return run


def _cut(block: int):
    """Rows (name, cells) in order, cut into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, names, cells = TaskContext.get().partitionId() << 32, [], []

        def made():
            idx, w = (pa.array([[c[k] for row in cells for c in row]], pa.list_(kind)) for k, kind in (("idx", pa.int32()), ("weight", pa.float64())))
            sizes = pa.array([[len(row) for row in cells]], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([names], pa.list_(pa.string())), sizes, idx, w], ["block", "names", "sizes", "idx", "w"]
            )

        for batch in batches:
            for name, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                cells.append(row)
                if len(names) == block:
                    yield made()
                    number, names, cells = number + 1, [], []
        if names:
            yield made()

    return run


def class_blocks(weights: DataFrame, label: str = "label_name", block: int = BLOCK) -> DataFrame:
    """``BLOCKS`` rows of the vectors in ``weights`` (class, term, weight), neighbours by heaviest term together."""
    known = weights.filter(F.col(label).isNotNull() & F.col("term").isNotNull() & (F.col("weight") != 0))
    known = through_table(known.select(F.col(label).cast("string").alias("name"), "term", "weight"), "class-weights")
    index = known.select("term").distinct().select("term", (F.row_number().over(W.orderBy("term")) - 1).alias("idx"))  # the vocabulary
    cells = known.join(broadcast_small(index), "term")
    heavy = F.max_by("term", F.abs("weight")).alias("heavy")  # a class has at most one cell per term of the vocabulary
    vectors = through_table(cells.groupBy("name").agg(F.collect_list(F.struct("idx", "weight")).alias("cells"), heavy), "class-vectors")
    tasks = max(1, math.ceil(vectors.count() / (8 * block)))
    dealt = vectors.repartitionByRange(tasks, "heavy", "name").sortWithinPartitions("heavy", "name")
    return through_table(dealt.select("name", "cells").mapInArrow(_cut(block), BLOCKS), "class-blocks")


def promising(blocks: DataFrame, floor: float) -> DataFrame:
    """(a, b): pairs of blocks that may hold a pair of classes as similar as ``floor``."""
    cells = blocks.select("block", F.explode(F.arrays_zip("idx", "w")).alias("c"))
    tops = cells.groupBy("block", "c.idx").agg(F.max(F.abs("c.w")).alias("top"))
    tops = through_table(tops, "block-tops")
    left, right = (tops.select(F.col("block").alias(n), "idx", F.col("top").alias(f"top_{n}")) for n in "ab")
    bounds = left.join(right, "idx").filter("a < b").groupBy("a", "b").agg(F.sum(F.expr("top_a * top_b")).alias("bound"))
    return bounds.filter(F.col("bound") >= floor - SAME).select("a", "b")


def similar_pairs(weights: DataFrame, n: int, label: str = "label_name", block: int = BLOCK) -> DataFrame:
    """The ``n`` pairs of classes with the greatest cosine: (class_a < class_b, similarity), by (similarity rounded, names).

    ``weights`` holds unit vectors in long form.
    """
    blocks = class_blocks(weights, label, block)
    whole = F.struct("block", "names", "sizes", "idx", "w")

    def best(pairs: DataFrame) -> DataFrame:
        rounded = pairs.select("class_a", "class_b", F.round("similarity", 6).alias("similarity"))
        return rounded.orderBy(F.desc("similarity"), "class_a", "class_b").limit(n)

    inside = through_table(best(blocks.select(whole.alias("x")).mapInArrow(_tiles(n, True), PAIRS)), "block-pairs")
    known = inside.agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least")).first()
    chosen = through_table(promising(blocks, known["least"] if known["n"] == n else 0.0), "tiles")
    x, y = (blocks.select(F.col("block").alias(k), whole.alias(side)) for k, side in (("a", "x"), ("b", "y")))
    across = chosen.join(x, "a").join(y, "b").select("x", "y").mapInArrow(_tiles(n, False), PAIRS)
    return best(inside.unionByName(across))


def class_overlap_pairs(weights: DataFrame, n: int = 5, label: str = "label_name") -> DataFrame:
    """The ``n`` most similar class pairs."""
    return similar_pairs(weights, n, label)


def overlap_submatrix(weights: DataFrame, top_pairs: int = 10, max_classes: int = 15, label: str = "label_name") -> DataFrame:
    """Similarity matrix (long form, zero diagonal) of the classes in the most similar pairs."""
    leading = similar_pairs(weights, top_pairs, label).collect()  # top_pairs rows
    names = sorted({c for r in leading for c in (r["class_a"], r["class_b"])})[:max_classes]
    spark = weights.sparkSession
    grid = spark.createDataFrame([(a, b) for a in names for b in names], "class_a string, class_b string")
    few = weights.filter(F.col(label).isin(names))
    a, b = (few.select(F.col(label).cast("string").alias(c), "term", F.col("weight").alias(w)) for c, w in (("class_a", "u"), ("class_b", "v")))
    dots = a.join(b, "term").filter("class_a <> class_b").groupBy("class_a", "class_b").agg(F.sum(F.expr("u * v")).alias("similarity"))
    cells = grid.join(dots, ["class_a", "class_b"], "left")  # max_classes squared at most
    return cells.select("class_a", "class_b", F.round(F.coalesce("similarity", F.lit(0.0)), 6).alias("similarity"))
