from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from intentloom.functions import grams, scoring, text
from intentloom.operators import features, profiling


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "text string").select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("value", ["a b  c", " a b\tc\n", "", "   ", "één twee"])
def test_words_split_on_any_space(spark, value):
    assert one(spark, value, text.words("text")) == value.split()


def test_tokens_are_unicode_words(spark):
    assert one(spark, "Don't ÉCOLE x größe_1, 42!", text.tokens("text")) == ["don", "école", "größe_1", "42"]


ODD_TEXTS = [None, "", "a", "é", "中", "中中", "x y", "Don't ÉCOLE größe_1, 42!", "ΣΑΣ İstanbul ½½ 𝒜𝒜 😀😀 a😀bb", "ǅ٣ _ __ a-b aa-bb", "e\u0301te\nab\tcd", "ab" * 300_000]


def test_arrow_tokens_equal_spark_tokens(spark):
    """The byte-wise split gives the tokens of the column expression, in any script and across slices."""
    rows = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "i int, text string").coalesce(1)
    held = rows.select(F.lower("text").alias("low"), text.tokens("text").alias("want")).toArrow().combine_chunks()
    low, want = held["low"].combine_chunks(), [w or [] for w in held["want"].to_pylist()]
    letters = text.token_letters(spark)
    assert grams.token_lists(low, letters).to_pylist() == want
    assert grams.token_lists(low.slice(3, 6), letters).to_pylist() == want[3:9]


def test_counts_take_texts_not_token_columns(spark):
    """Spark's token expression costs ten times the split in Arrow batches: no statistic of terms goes through it."""
    rows = spark.createDataFrame([(1, "aa bb aa", "x"), (2, None, None), (3, "aa", None)], "sample_id int, text string, label_name string")
    counts = features.class_term_counts(rows)
    assert "regexp" not in counts._jdf.queryExecution().toString()
    assert {(r["label_name"], r["term"], r["tf"]) for r in counts.collect()} == {("x", "aa", 2), ("x", "bb", 1), (None, "aa", 1)}
    assert "regexp" not in features.tfidf_features(rows)._jdf.queryExecution().toString()


def test_text_key_ignores_case_and_outer_space(spark):
    keys = {one(spark, v, text.text_key("text")) for v in ("Hello World", "  hello world\n", " HELLO WORLD ")}
    assert len(keys) == 1
    assert keys.pop() == "b94d27b9934d3e08a52e52d7da7dabfac484efe37a5380ee9088f7ace2efcde9"


@pytest.mark.parametrize(
    "value, n, want",
    [
        ("I lost my Card", 1, "I missing my Card"),
        ("I lost my Card", 2, "I missing my payment card"),
        ("card, please", 1, "card, please"),
        ("pay   pay", 1, "remit pay"),
        ("", 1, ""),
    ],
)
def test_synonym_replace(spark, value, n, want):
    assert one(spark, value, text.synonym_replace("text", n)) == want


@pytest.mark.parametrize("n", [1, 3])
def test_random_swap_keeps_the_words(spark, n):
    rows = spark.range(200).select("id", F.lit("one two three four five").alias("text"))
    got = rows.select(text.random_swap("text", ["id"], n).alias("x")).collect()
    words = "one two three four five".split()
    assert all(sorted(r["x"].split()) == sorted(words) for r in got)
    if n == 1:
        moved = [sum(a != b for a, b in zip(r["x"].split(), words)) for r in got]
        assert set(moved) == {2}
        assert len({r["x"] for r in got}) == 10  # every pair of five positions


@pytest.mark.parametrize("value", ["", "alone", "  alone  "])
def test_random_swap_leaves_short_texts(spark, value):
    assert one(spark, value, text.random_swap("text", [F.lit(1)])) == value


def test_term_counts_and_ngrams(spark):
    df = spark.createDataFrame([("bb aa bb bb",), ("solo",), ("",)], "text string")
    rows = df.select(text.term_counts(features.terms("text")).alias("c")).collect()
    assert {(x["term"], x["tf"]) for x in rows[0]["c"]} == {("aa", 1), ("bb", 3), ("bb aa", 1), ("aa bb", 1), ("bb bb", 1)}
    assert [(x["term"], x["tf"]) for x in rows[1]["c"]] == [("solo", 1)]
    assert rows[2]["c"] == []


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([2.0, 0.5, -1.0],), ([1000.0, 1000.0],), ([0.0] * 77,)], "logits array<double>")
    rows = df.select(scoring.softmax("logits").alias("p"), scoring.argmax("logits").alias("a")).collect()
    assert [r["a"] for r in rows] == [0, 0, 0]
    assert all(sum(r["p"]) == pytest.approx(1.0) for r in rows)
    assert rows[0]["p"][0] == pytest.approx(math.exp(2) / (math.exp(2) + math.exp(0.5) + math.exp(-1)))


def test_minmax_scale(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0],), ([4.0, 4.0],)], "v array<double>")
    got = [r["s"] for r in df.select(scoring.minmax("v").alias("s")).collect()]
    assert got[0] == pytest.approx([0.0, 1.0, 0.5], abs=1e-7)
    assert got[1] == [0.0, 0.0]


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, "aa bb aa"), (1, "bb cc"), (2, "!!")], "sample_id long, text string")
    rows = {(r["sample_id"], r["term"]): r["weight"] for r in features.tfidf_features(df, ngram_range=(1, 1)).collect()}
    idf = {"aa": math.log(4 / 2) + 1, "bb": math.log(4 / 3) + 1, "cc": math.log(4 / 2) + 1}
    raw = {"aa": (1 + math.log(2)) * idf["aa"], "bb": idf["bb"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert set(rows) == {(0, "aa"), (0, "bb"), (1, "bb"), (1, "cc")}
    assert rows[0, "aa"] == pytest.approx(raw["aa"] / norm)


def test_vectors_equal_long_form(spark, sf_dir):
    from intentloom.sources import tables as t

    df = t.samples(spark, sf_dir).filter("sample_id < 40")
    vocab = features.vocabulary(df, 300)
    long = {(r["sample_id"], r["idx"]): r["weight"] for r in features.tfidf_features(df, vocab).collect()}
    rows = df.select("sample_id", "text", "label")
    vectors = features.stored_tfidf_vectors(rows, vocab, size=300).collect()
    assert len(vectors) == 40 and all(r["features"].size == 300 for r in vectors)
    assert all((np.diff(r["features"].indices) > 0).all() for r in vectors)
    flat = {(r["sample_id"], int(i)): v for r in vectors for i, v in zip(r["features"].indices, r["features"].values)}
    assert flat == pytest.approx(long)


def test_class_documents_are_whole(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", f"t{i}") for i in range(50)], "sample_id long, label_name string, text string")
    parts = profiling.class_documents(df, rows_per_part=7).orderBy("label_name", "part").collect()
    for name in "ab":
        want = " ".join(f"t{i}" for i in range(50) if ("a" if i % 3 else "b") == name)
        assert " ".join(p["text"] for p in parts if p["label_name"] == name) == want


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("ab",)] * 5, "text string")
    rows = profiling.length_histograms(df).filter("n > 0").collect()
    assert sorted((r["measure"], r["n"]) for r in rows) == [("chars", 5), ("words", 5)]
    assert profiling.length_histograms(df).count() == 80


def counted_terms(rows, sizes):
    """(term, total, df) by plain counting."""
    total, held = Counter(), Counter()
    for text_ in rows:
        toks = re.findall(r"\w{2,}", (text_ or "").lower())
        found = [" ".join(toks[i : i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(toks) - n + 1)]
        total.update(found)
        held.update(set(found))
    return sorted(((t, n, held[t]) for t, n in total.items()), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (1, 3), (2, 2)])
@pytest.mark.parametrize("most", [3, 7, 60, 10_000])
def test_vocabulary_equals_plain_counting(spark, monkeypatch, sizes, most):
    monkeypatch.setattr(features.grams, "SLICE_TOKENS", 5)
    words = ["aa", "bb", "cc", "dd", "ee", "ff", "gg"]
    rows = [" ".join(words[(i * j + j // 2) % (2 + i % 6)] for j in range(i % 9)) for i in range(40)] + [None, "", "aa", "cc cc cc cc dd"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "sample_id long, text string")
    want = counted_terms(rows, sizes)[:most]
    got = {r["term"]: r["idf"] for r in features.vocabulary(df, most, sizes).collect()}
    assert got == pytest.approx({t: math.log((len(rows) + 1) / (held + 1)) + 1 for t, _, held in want})
    longer = features._term_totals(df, (2, 2), pa.array(["aa", "cc"])).collect()
    assert {r["term"] for r in longer} <= {"aa cc", "cc aa", "aa aa", "cc cc"} and longer


def test_rare_words_make_no_longer_terms(spark, monkeypatch):
    """What is counted beyond single words does not grow with the rare words."""
    rows = [(i, f"common words rare{i} rarer{i}") for i in range(50)]
    asked = []
    counted = features._term_totals
    monkeypatch.setattr(features, "_term_totals", lambda df, sizes, words=None: asked.append(words) or counted(df, sizes, words))
    got = features.vocabulary(spark.createDataFrame(rows, "sample_id long, text string"), 2).collect()
    assert {r["term"] for r in got} == {"common", "common words"}
    assert asked[0] is None and sorted(asked[1].to_pylist()) == ["common", "words"]


def test_weights_of_repeated_and_missing_ids(spark):
    rows = [(1, "aa bb"), (1, "aa bb"), (None, "aa aa"), (None, "bb"), (3, None)]
    df = spark.createDataFrame(rows, "sample_id long, text string")
    vocab = spark.createDataFrame([("aa", 0, 1.0), ("bb", 1, 2.0)], "term string, idx int, idf double")
    got = sorted((r["sample_id"] or 0, r["term"], round(r["weight"], 6)) for r in features.tfidf_features(df, vocab).collect())
    one, none = math.sqrt(10), math.sqrt((1 + math.log(2)) ** 2 + 4)
    want = [(0, "aa", (1 + math.log(2)) / none), (0, "bb", 2 / none)] + 2 * [(1, "aa", 1 / one)] + 2 * [(1, "bb", 2 / one)]
    assert got == sorted((i, t, round(w, 6)) for i, t, w in want)
    vectors = features.stored_tfidf_vectors(df, vocab, size=2).select("sample_id", F.unwrap_udt("features")["indices"].alias("at"))
    assert {r["sample_id"]: r["at"] for r in vectors.collect()} == {1: [0, 0, 1, 1], None: [0, 1], 3: []}
