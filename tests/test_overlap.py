"""The most similar classes against dense numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentloom.operators import overlap

SCHEMA = "label_name string, term string, weight double"


def vectors(k, terms, per, seed=4, groups=None):
    """k classes of ``per`` terms; of a group of classes each has the terms of its group, a little changed."""
    rng = np.random.default_rng(seed)
    rows = np.zeros((k, terms))
    for c in range(k):
        g = c if groups is None else c % groups
        own = np.random.default_rng(g)
        rows[c, own.choice(terms, per, replace=False)] = own.uniform(0.2, 1, per) * rng.uniform(0.5, 1.5, per)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def table(spark, dense):
    c, t = np.nonzero(dense)
    return spark.createDataFrame([(f"c{a:05d}", f"t{b:05d}", float(w)) for a, b, w in zip(c, t, dense[c, t])], SCHEMA)


def brute(dense, n):
    dots = np.triu(dense @ dense.T, 1)
    pairs = [(-round(dots[i, j], 6), f"c{i:05d}", f"c{j:05d}") for i, j in zip(*np.nonzero(dots))]
    return [(a, b, pytest.approx(-d, abs=2e-6)) for d, a, b in sorted(pairs)[:n]]


@pytest.mark.parametrize("block", [1, 3, 16, 256])
@pytest.mark.parametrize("n", [1, 7, 10_000])
def test_pairs_equal_dense(spark, block, n):
    dense = vectors(40, 60, 6)
    got = overlap.similar_pairs(table(spark, dense), n, block=block).collect()
    want = brute(dense, n)
    assert len(got) == len(want)
    got = sorted(((r["class_a"], r["class_b"], r["similarity"]) for r in got), key=lambda r: (-r[2], r[:2]))
    assert sorted(got) == sorted(want, key=lambda r: r[:2])


def test_ties_are_taken_by_name(spark):
    rows = [(f"c{i:05d}", "t", 1.0) for i in range(30)]
    got = overlap.similar_pairs(spark.createDataFrame(rows, SCHEMA), 4, block=7).collect()
    assert sorted((r["class_a"], r["class_b"]) for r in got) == [("c00000", f"c{i:05d}") for i in (1, 2, 3, 4)]


def test_nulls_zeros_one_class_and_none(spark):
    rows = [(None, "t", 1.0), ("a", None, 1.0), ("a", "t", 1.0), ("b", "t", 0.0), ("é", "u", 1.0)]
    assert overlap.similar_pairs(spark.createDataFrame(rows, SCHEMA), 5).count() == 0
    assert overlap.similar_pairs(spark.createDataFrame([], SCHEMA), 5).count() == 0
    assert overlap.overlap_submatrix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_twenty_thousand_classes(spark):
    dense = vectors(20_000, 3_000, 8, groups=10_000)
    dense[777], dense[12_345] = dense[3], dense[4]
    weights = table(spark, dense)
    got = overlap.class_overlap_pairs(weights, 5).collect()
    best = {(r["class_a"], r["class_b"]): r["similarity"] for r in got}
    assert best[("c00003", "c00777")] == best[("c00004", "c12345")] == 1.0
    floor = min(best.values())
    for at in range(0, 20_000, 2_000):  # no better pair is left out
        dots = dense[at : at + 2_000] @ dense.T
        i, j = np.nonzero(dots > floor + 2e-6)
        assert all((f"c{a + at:05d}", f"c{b:05d}") in best for a, b in zip(i, j) if a + at < b)


def test_few_tiles_are_left_where_classes_group(spark):
    dense = np.zeros((64, 64))
    for c in range(64):
        dense[c, [c - c % 8, c - c % 8 + 1 + c % 7]] = (0.9, 0.1)
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    blocks = overlap.class_blocks(table(spark, dense), block=8)
    assert blocks.count() == 8
    assert overlap.promising(blocks, 0.9).count() == 0 and blocks.agg(F.sum(F.size("names"))).first()[0] == 64
