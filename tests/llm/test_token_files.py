from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from intentloom.llm import encode, token_files

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \n b", "a\n\n  b ", "\ta\t b", "it's  don't 'll", "<|endoftext|> x<|endoftext|>y",
    "a  b", "a　 b\x1c c", "é é ́x", "ΣΑΣ ΟΔΟΣ.", "123 45,6 ...  !!! -- a_b", "日本語 テキスト 😀😀 x", "x" * 5000, "ab " * 3000,
    "<|startoftext|>A B", "a\x85 b  c",
]


@pytest.mark.parametrize(("path", "spaced"), [(BYTE, True), (WORD, False)])
def test_cut_texts_have_the_ids_of_whole_texts(path, spaced, spark, sf_dir):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab \n\t.'1é,s!") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    plain = Tokenizer.from_file(path)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    got = list(encode.WordEncoder(path, spaced).ids(texts))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def rows_of(docs, spark, tmp_path, partitions=5):
    token_files.write_token_files(docs, f"file://{tmp_path}/t", BYTE, True, 0, partitions)
    return token_files.read_token_files(
        spark, f"file://{tmp_path}/t", "doc_id long, start long, ids binary", lambda i, at, t: (i, at, t.astype("<u4").tobytes())
    ).collect()


def test_files_hold_every_text_in_order(spark, sf_dir, tmp_path):
    odd = [(10_000 - i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (5, None), (5, "repeated"), (5, "repeated")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "1 as part", "2 as id")
    got = sorted(rows_of(docs, spark, tmp_path), key=lambda r: r["start"])
    plain, at = Tokenizer.from_file(BYTE), 0
    want = sorted((-1 if i is None else i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in odd)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in got] == [w[0] for w in want]
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4


def test_empty_table(spark, tmp_path):
    assert rows_of(spark.createDataFrame([], "doc_id long, text string"), spark, tmp_path) == []


def test_query(spark, sf_dir):
    got = token_files.op6_token_files(spark, sf_dir).orderBy("doc_id").collect()
    plain, at = Tokenizer.from_file(BYTE), 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        ids = np.array([*plain.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


PARTS = [
    "<|endoftext|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endoftext", "|>", "a", "Bc", "7", "77", " ", "  ", "\n", "\t", ".", "=\u0338", "==", "'s", "'LL",
    "H\u0331", "I\u0307", "\u0130", "\u0130.", "\u00d7,", "\u00f7!", "\u00f1,", "\u00e9", "\u017f", "\u212a", "\u03a3.", "\U0001f600.", "\u2026", "(7)", "***", "x$$$", "\x85", "\u3000",
]


@pytest.mark.parametrize(("path", "spaced"), [(BYTE, True), (WORD, False)])
@pytest.mark.parametrize("cached", [encode.CACHED_WORDS, 50])
def test_odd_parts_have_the_ids_of_whole_texts(path, spaced, cached, monkeypatch):
    monkeypatch.setattr(encode, "CACHED_WORDS", cached)
    monkeypatch.setattr(encode, "ENCODED", 5000)
    rng = random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20))) for _ in range(3000)] + [None]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    made = encode.WordEncoder(path, spaced)
    for column in (pa.array(texts), pa.array(["before", *texts], pa.large_string()).slice(1)):
        assert [np.frombuffer(g, "<u4").tolist() for g in made.ids(column)] == want
    assert len(made.words) <= cached


@pytest.mark.parametrize(("path", "spaced"), [(BYTE, True), (WORD, False)])
def test_a_word_with_other_marks_is_not_encoded_again(path, spaced):
    rng, made, given = random.Random(4), encode.WordEncoder(path, spaced), []
    words = list({"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(1000)})
    text = " ".join(w + m for m in ("***", "$$$", ",&&&") for w in words)

    class Counting:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **how)

    plain, made.tokenizer = made.tokenizer, Counting()
    assert np.frombuffer(next(iter(made.ids([text]))), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(given) < 20 and sum(map(len, given)) < 1.2 * sum(len(w) + 1 for w in words)
