from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from intentloom.llm import encode, fill_middle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(4)
    some = [None, "", "a", "é", "😀b", "has <S> inside", "ends with <", "<P", "<<S", "> and <M", "\x00\x01 tab\t\r\n"]
    some += ["".join(rng.choice("ab Zé😀<>PSM\n\x00ſK1-") for _ in range(rng.randrange(1, 90))) for _ in range(400)]
    return some + ["word " * 700_000 + "é", "x" * 3_000_000, "é😀" * 600_000] + ["the same"] * 5


def as_key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_outputs_equal_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (None, None), (7, "again seven"), (7, "again seven")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).selectExpr("*", "1 as n", "2 as form", "3 as h1").repartition(3)
    made = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    want = sorted(as_key(brute(i, t)) + (t or "",) for i, t in rows)
    assert sorted(as_key(r) for r in made) == want
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_query_digests(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts()[:100])]
    spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(as_key(r) for r in fill_middle.op12_fill_middle(spark, str(tmp_path)).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted(as_key((*brute(i, t)[:5], sha(brute(i, t)[5]), sha(t or ""))) for i, t in rows)


def test_parameters(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(300)], "doc_id long, text string")
    forms = [r["form"] for r in fill_middle.fill_in_middle(docs, seed=9, plain=50, spm=100).collect()]
    assert set(forms) == {"plain", "spm"} and 100 < forms.count("plain") < 200
    assert {r["form"] for r in fill_middle.fill_in_middle(docs, plain=0, spm=0).collect()} == {"psm"}


def test_empty_table(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ranks_equal_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        classes = rng.integers(0, 4, n).astype(np.uint8)
        matrix, at = fill_middle.WaveletMatrix(classes), np.arange(n + 1)
        for c in range(4):
            assert matrix.rank(c, at).tolist() == np.concatenate([[0], np.cumsum(classes == c)]).tolist()


def test_text_bytes_of_slices():
    column = pa.array(["ab", None, "é", "", "xyz"]).slice(1, 3)
    data, offsets = encode.text_bytes(column)
    assert bytes(data) == "é".encode() and offsets.tolist() == [0, 0, 2, 2]
    assert [(lo, hi) for lo, hi, *_ in encode.pieces(data, offsets)] == [(0, 3)]
