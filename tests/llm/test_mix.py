from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from intentloom.llm import mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(n, source, words):
    return [(i, " ".join(["w"] * words(i)), "en", source, 0) for i in range(n)]


def dealt(sizes, share=mix.SHARE):
    """Targets by dealing again until none is above its cap: {source: target}."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weigh = {s: mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    full, words = set(), share * sum(sizes.values())
    while True:
        rest = sum(w for s, w in weigh.items() if s not in full)
        level = (words - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        over = {s for s in names if s not in full and weigh[s] * level > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s] if s in full else weigh[s] * level) for s in names}
        full |= over


def targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "of string, n long").repartition(5)
    return {r["of"]: r["target"] for r in mix.targets(table).collect()}


def test_targets_share_all_words_and_stop_at_the_cap(spark):
    by = targets(spark, {"a": 100, "b": 1000, "c": 1000, None: 0})
    assert set(by) == {"a", "b", "c", None}
    assert by["a"] == 200 and by[None] == 0
    assert by["b"] * 2 == by["c"]
    assert sum(by.values()) == pytest.approx(1.5 * 2100)


def test_targets_of_one_source_and_of_none(spark):
    assert targets(spark, {"a": 10}) == {"a": 15.0}
    assert targets(spark, {}) == {}
    assert targets(spark, {"a": 0}) == {"a": 0.0}


def test_targets_equal_dealing_again(spark):
    sizes = {f"s{i}": (i * i * 7919) % (10 ** (1 + i % 5)) for i in range(500)} | {None: 3}
    assert targets(spark, sizes) == pytest.approx(dealt(sizes), rel=1e-9)


def test_as_many_sources_as_documents(spark):
    n = 120_000
    docs = spark.range(n, numPartitions=8).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 5 as int)) as text", "concat('h', id) as source")
    got = mix.mix_copies(docs, mix.word_count(F.col("text"))).selectExpr("doc.doc_id as i", "size", "source_size", "target", "copies").toPandas()
    want = dealt({f"h{i}": 1 + i % 5 for i in range(n)})
    assert len(got) == n and (got["size"] == got["source_size"]).all()
    assert got["target"].to_list() == pytest.approx([want[f"h{i}"] for i in got["i"]], rel=1e-9)
    assert ((got["copies"] * got["size"] - got["target"]).abs() <= got["size"]).all()


def test_very_long_text(spark):
    docs = [(1, "w " * 3_000_000, "en", "x", 0), (2, "w", "en", "x", 0)]
    got = {r["doc"]["doc_id"]: r["size"] for r in mix.mix_copies(spark.createDataFrame(docs, SCHEMA), mix.word_count(F.col("text"))).collect()}
    assert got == {1: 3_000_000, 2: 1}


def test_taken_words_come_near_each_target(spark):
    docs = rows(400, "x", lambda i: 1 + i % 97) + rows(3000, "y", lambda i: 20) + rows(50, None, lambda i: 0)
    got = mix.mix_copies(spark.createDataFrame(docs, SCHEMA), mix.word_count(F.col("text"))).collect()
    assert len(got) == len(docs)
    taken, target = collections.Counter(), {}
    for r in got:
        assert 0 <= r["copies"] <= 2
        taken[r["doc"]["source"]] += r["copies"] * r["size"]
        target[r["doc"]["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 100 for s, t in target.items())


def test_nulls_repeats_and_clashing_columns(spark):
    docs = [(None, None, None, None, None), (1, "", "en", "x", 0), (1, "a b", "en", "x", 3), (1, "a b", "en", "x", 3)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("_rank", F.lit(7)).withColumn("doc", F.lit(8))
    out = mix.mix_documents(df)
    assert out.columns == df.columns
    assert all(r["text"] == "a b" and r["_rank"] == 7 and r["doc"] == 8 for r in out.collect())
    assert mix.mix_documents(df.limit(0)).count() == 0


def test_runs_agree(spark, sf_dir):
    def once():
        return sorted(map(tuple, mix.op3_mix(spark, sf_dir).collect()))

    assert once() == once()
