from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentloom.llm import packing
from intentloom.session import through_table

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_least_squares_against_a_known_solution():
    rng = np.random.default_rng(3)
    a = rng.random((40, 12))
    x = np.maximum(rng.normal(size=12), 0)
    assert np.allclose(packing.nonnegative_least_squares(a, a @ x), x, atol=1e-6)
    b = rng.normal(size=40)
    got = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ got)
    assert (got >= 0).all() and (slope <= 1e-6).all() and np.allclose(slope[got > 0], 0, atol=1e-6)


def test_patterns_fill_a_sequence():
    got = packing.length_patterns(12)
    assert len(got) == len(set(got)) == 1 + 6 + 12
    assert all(sum(p) == 12 and list(p) == sorted(p, reverse=True) for p in got)


def unrolled(histogram, capacity=packing.CAPACITY):
    """Every piece's (sequence, offset); checks that ranks are dealt once and sequences have no gaps."""
    rows, n = packing.plan(histogram, capacity)
    ranks, filled = collections.Counter(), collections.defaultdict(list)
    for length, lo, count, times, first, offset in rows:
        for j in range(count):
            ranks[length, lo + j] += 1
            filled[first + j // times].append((offset + j % times * length, length))
    assert ranks == collections.Counter((x, r) for x, c in histogram.items() for r in range(c))
    assert set(filled) <= set(range(n))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(np.exp(rng.normal(4.5 + seed / 2, 1.0, 4000)).astype(int) + 1, 1, packing.CAPACITY)
    histogram = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    used, half = unrolled(histogram), int((lengths > packing.CAPACITY // 2).sum())
    assert used <= 1.02 * max(-(-lengths.sum() // packing.CAPACITY), half) + 1


def test_plans_of_few_lengths():
    assert packing.plan({}) == ([], 0)
    assert unrolled({4096: 7}) == 7
    assert unrolled({1: 9000}) == 3
    assert unrolled({2048: 5}) == 3
    assert unrolled({3000: 4, 1096: 4}) == 4
    assert unrolled({2049: 3, 1: 5000}) == 3


TEXTS = [None, "", "  ", "one word", "Ünï code — 😀", "again and again", "again and again", "long " * 9000, "x" * 9000]


def checked(spark, docs, rows):
    plain, pieces, filled = Tokenizer.from_file(WORD), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    want = collections.Counter()
    for d in docs:
        ids = np.array([*plain.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 4096):
            want[d["doc_id"], k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(filled), -(-sum(k[3] * c for k, c in want.items()) // 4096)


def test_odd_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one word"), (3, "other"), (None, "one word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit(1)).withColumn("rank", F.lit(2))
    used, bound = checked(spark, docs.collect(), packing.packed_documents(docs).collect())
    assert used <= bound + 1


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    used, bound = checked(spark, docs, packing.op7_pattern_packing(spark, sf_dir).collect())
    assert used <= 1.02 * bound + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    packed = packing.pack(through_table(packing.pieces(docs, WORD, False, keep_ids=True), "pieces"))
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert bytes(whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]) == bytes(r["ids"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed_documents(docs).count() == 0
