from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentloom.llm import importance

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def buckets_of(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [zlib.crc32(w.encode()) % 10000 for w in WORD.findall(lower)]


def brute(rows, target, share=10):
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((n + 1) * (all_t + 10000)))) for b, n in s.items()}
    out = []
    for doc, text in rows:
        words = buckets_of(text)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in words)
        out.append([doc, len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    known = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for k in range(len(known) * share // 100):
        known[k][4] = k + 1
    return sorted(as_key(r) for r in out)


def as_key(row):
    return tuple(-1 if v is None else v for v in row)


def corpus():
    rng = random.Random(6)
    target = [None, "", *(" ".join(f"t{rng.randrange(80)}" for _ in range(40)) for _ in range(30))]
    rows = [(1, None), (2, ""), (3, " \n\x7f"), (4, "É é" * 30), (5, "x" * 2_000_000), (6, "Long " * 300_000), (7, "a1-b2 " * 9 + "é _z")]
    for i in range(600):
        names = rng.choice(["t", "W", "é", "w" * 40])
        rows.append((10 + i, " ".join(f"{names}{rng.randrange(100)}" for _ in range(rng.choice([5, 19, 20, 21, 200])))))
    same = rows[100][1] + " more words" * 20
    rows += [(50, same)] * 150 + [(None, same)] * 150 + [(50, rows[9][1]), (None, rows[9][1] + " t1" * 25)]
    return rows, target


def tables(spark, rows, target):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).selectExpr("*", "1 as score", "2 as words", "3 as place")
    return docs.repartition(4), spark.createDataFrame(list(enumerate(target)), "item_id long, text string")


@pytest.mark.parametrize("width, rows_sorted, share", [(0.002, 250_000, 10), (1e-9, 40, 10), (0.002, 7, 60)])
def test_draw_equals_plain_python(spark, monkeypatch, width, rows_sorted, share):
    monkeypatch.setattr(importance, "BRACKET", width)
    monkeypatch.setattr(importance, "SORTED_ROWS", rows_sorted)
    rows, target = corpus()
    docs, aim = tables(spark, rows, target)
    got = importance.importance_resample(docs, aim, share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(as_key(r) for r in got.collect()) == brute(rows, target, share)


def test_bracket_is_widened_until_it_holds_the_cutoff(spark, monkeypatch):
    monkeypatch.setattr(importance, "BRACKET", 1e-9)
    monkeypatch.setattr(importance, "SKETCH", 2)  # a sketch this coarse points far away
    scores = spark.range(10_000).select((F.col("id") * F.col("id")).alias("score"))
    for take in (1, 17, 5_000, 9_999, 10_000):
        low, high, above, inside = importance.bracket(scores, 10_000, take)
        assert above < take <= above + inside
        cut = (10_000 - take) ** 2
        assert low <= cut <= high


def test_one_score_for_all_rows(spark):
    docs = spark.createDataFrame([(None, "one two three four five " * 5)] * 500, "doc_id long, text string").repartition(8)
    got = importance.importance_resample(docs, docs.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 51)) and len(got) == 500


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    full = spark.createDataFrame([(1, "a few words only", None, None, None)], SCHEMA)
    assert importance.importance_resample(empty, full).count() == 0
    assert [tuple(r) for r in importance.importance_resample(full, empty).select("doc_id", "n_features", "rank").collect()] == [(1, 4, None)]


def test_hashes_equal_zlib():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé😀09") for _ in range(rng.choice([1, 2, 7, 8, 31, 32, 33, 500]))).encode() for _ in range(800)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = importance.word_hashes(data, np.concatenate([[0], ends[:-1]]), ends, importance._crc_table())
    assert got.tolist() == [zlib.crc32(w) for w in words]
