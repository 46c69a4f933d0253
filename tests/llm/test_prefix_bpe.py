from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentloom.llm import prefix_bpe

FILE = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdeinrst aaaa'’slléÉİΣſKﬁ́̈1٣²ⅷ-_=!<|>　 \xa0 \x85日本語한국어😀‍👩\x00\x1c\t\r\n"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def code():
    return prefix_bpe.Coder(FILE)


def same(library, code, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(code.encode([text])[0], "<i4")
    assert got.tolist() == want, text[:200]
    assert code.decode(got) == library.decode(want, skip_special_tokens=False), text[:200]


def test_mixed_texts_equal_the_library(library, code):
    rng = random.Random(1)
    for k in range(4000):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(0, 40)))
        if k % 10 == 0:
            text = text[:5] + "<|endoftext|>" + text[5:] + "<|StartOfText|><|startoftext|>"
        same(library, code, text)


def test_every_character_of_the_first_blocks(library, code):
    for c in map(chr, range(0x800)):
        same(library, code, f"x{c}y {c}{c}'s {c}1{c.upper()}")


def test_long_words_of_few_letters(library, code):
    rng = random.Random(2)
    words = ["a" * 1000, "ab" * 500, "=" * 777, "banana" * 300, "the" * 100 + "ing" * 50, "!" * 11, "hahahaha" * 20]
    words += ["".join(rng.choice(letters) for _ in range(300)) for letters in ("ab", "abinto", "theandio", "éèa") for _ in range(150)]
    for word in words:
        same(library, code, word)


def test_small_vocabularies_equal_merging_by_rank():
    """Any order of merges that a training could give, against merging the lowest rank, leftmost first."""
    rng = random.Random(3)
    letters = prefix_bpe.byte_letters()
    for _ in range(60):
        vocab = {t: i for i, t in enumerate([*letters, *[c + "</w>" for c in letters]])}
        tokens, merges = ["a", "b", "a</w>", "b</w>"], []
        while len(merges) < 12:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if not a.endswith("</w>") and a + b not in vocab:
                vocab[a + b] = len(vocab)
                tokens.append(a + b)
                merges.append([a, b])
        known, rank = prefix_bpe.Vocabulary(vocab, merges, "</w>"), {tuple(m): r for r, m in enumerate(merges)}
        for _ in range(40):
            word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
            parts = [*word[:-1], word[-1] + "</w>"]
            while True:
                found = [(rank[pair], k) for k, pair in enumerate(zip(parts, parts[1:])) if pair in rank]
                if not found:
                    break
                k = min(found)[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            assert np.frombuffer(known.encode(word), "<i4").tolist() == [vocab[p] for p in parts]


def test_query_equals_the_library(spark, library, tmp_path):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \n "), (None, "no id"), (None, None), (4, "twice"), (4, "twice"), (5, "ab" * 400_000), (6, "Word, " * 200_000)]
    rows += [(10 + k, "".join(rng.choice(LETTERS) for _ in range(60))) for k in range(200)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).selectExpr("*", "1 as ids", "2 as row").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))))
    got = prefix_bpe.op11_prefix_bpe(spark, str(tmp_path)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_given_documents_equal_the_library(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = {r["doc_id"]: r["ids"] for r in prefix_bpe.encoded(docs, FILE).collect()}
    for r in docs.collect():
        assert made[r["doc_id"]] == library.encode(r["text"], add_special_tokens=False).ids


def test_empty_table_and_null_ids(spark):
    assert prefix_bpe.encoded(spark.createDataFrame([], SCHEMA), FILE).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [3306])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in prefix_bpe.decoded(rows, FILE).select("doc_id", F.col("text")).collect()} == {1: "", 2: "hello</w>"}


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError):
        prefix_bpe.Coder(path("byte_bpe_50k.json"))
