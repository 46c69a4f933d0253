from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from intentloom.llm import repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha256) of each text, from the starts of every string of SPAN bytes."""
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(r[s : s + 400] for r in raws for s in range(len(r) - 399))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, np.int32)
        for s in range(len(r) - 399):
            if count[r[s : s + 400]] > 1:
                gone[s] += 1
                if s + 400 < len(gone):
                    gone[s + 400] -= 1
        cover = np.cumsum(gone)[: len(r)] > 0
        kept = np.frombuffer(r, np.uint8)[~cover].tobytes()
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


def planted(rng):
    texts = [None, "", "short", "x" * 399, "x" * 400, "y" * 401, "z" * 1500, "ab" * 600]
    passage = prose(rng, 700)
    for n in (380, 399, 400, 401, 500, 640):
        p = prose(rng, n).encode()[:n].decode(errors="ignore").ljust(n, "q")
        texts += [prose(rng, rng.randint(0, 300)) + p + prose(rng, rng.randint(0, 300)) for _ in range(rng.randint(2, 4))]
    for _ in range(60):  # parts of one passage, cut anywhere
        a, b = sorted(rng.sample(range(701), 2))
        texts.append(prose(rng, rng.randint(0, 600)) + passage[a:b] + prose(rng, rng.randint(0, 600)))
    base = prose(rng, 3000)
    for _ in range(12):  # copies with a few changes
        chars = list(base)
        for _ in range(rng.randrange(6)):
            chars[rng.randrange(len(chars))] = "Z"
        texts.append("".join(chars))
    copy = prose(rng, 900)
    texts += [copy] * 5 + [copy + copy]
    texts.append(prose(rng, 100) + prose(random.Random(1), 450) + prose(rng, 50) + prose(random.Random(1), 450))
    return texts


def digest(r):
    return r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]


@pytest.mark.parametrize("members", [repeats.MEMBERS, 4])
def test_planted_repeats_equal_brute_force(spark, members, monkeypatch):
    monkeypatch.setattr(repeats, "MEMBERS", members)
    texts = planted(random.Random(17))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r["doc_id"]: digest(r) for r in repeats.without_repeats(df.selectExpr("*", "1 as row", "2 as spans")).collect()}
    want = dict(enumerate(brute(texts)))
    assert [i for i in want if got[i] != want[i]] == [] and len(got) == len(want)


def test_repeated_rows_and_null_ids(spark):
    rng = random.Random(3)
    a, b = prose(rng, 800), prose(rng, 800)
    rows = [(1, a), (1, a), (1, b), (None, a), (None, prose(rng, 500)), (2, prose(rng, 500))]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = collections.Counter((r["doc_id"], *digest(r)) for r in repeats.without_repeats(df).collect())
    assert got == collections.Counter((i, *d) for (i, _), d in zip(rows, brute([t for _, t in rows])))


def test_given_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = dict(zip([r["doc_id"] for r in docs], brute([r["text"] for r in docs])))
    got = {r["doc_id"]: digest(r) for r in repeats.op8_repeats(spark, sf_dir).collect()}
    assert got == want and any(d[1] for d in got.values())


def test_anchors_lie_alike_in_equal_strings():
    rng = random.Random(9)
    p = prose(rng, 500).encode()[:400]
    for _ in range(20):
        left, right = prose(rng, rng.randint(0, 500)).encode(), prose(rng, rng.randint(0, 500)).encode()
        at, _ = repeats.anchors(np.frombuffer(left + p + right, np.uint8))
        inside = {int(x) - len(left) for x in at if len(left) <= x <= len(left) + repeats.REACH}
        alone = {int(x) for x in repeats.anchors(np.frombuffer(p, np.uint8))[0]}
        assert alone and alone <= inside


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_hash_alike_for_all_rows(spark, monkeypatch):
    real = repeats.F.xxhash64
    monkeypatch.setattr(repeats.F, "xxhash64", lambda *c: repeats.F.lit(7).cast("long") if "one" in str(c[0]) else real(*c))
    rng = random.Random(5)
    a = prose(rng, 700)
    rows = [(i, a + prose(rng, 300 + i)) for i in range(6)] + [(9, prose(rng, 600))]
    got = {r["doc_id"]: digest(r) for r in repeats.without_repeats(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)).collect()}
    assert got == dict(zip([i for i, _ in rows], brute([t for _, t in rows])))


def test_long_text_ingested_many_times(spark):
    rng = random.Random(6)
    words = [prose(rng, 6) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(150_000))  # a megabyte
    own = "".join(rng.choice("abcdefghij ") for _ in range(900))
    rows = [(None, long)] * 12 + [(1, own), (2, own[:350])]
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeats.without_repeats(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)).collect())
    size = len(long.encode())
    assert got == collections.Counter({(None, size, size): 12, (1, 900, 0): 1, (2, 350, 0): 1})


def test_passages_are_told_by_bytes_removed_not_by_size(spark):
    """Passages of 51 to 80 words in two documents each: those of 400 bytes or more go, shorter ones and clean documents stay."""
    rng = random.Random(12)

    def words(n, lo, hi):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(lo, hi))) for _ in range(n))

    rows, long, short = [], set(), set()
    for k in range(60):
        passage = words(rng.randint(51, 80), *((2, 5) if k % 2 else (3, 9)))
        for i in (2 * k, 2 * k + 1):
            rows.append((i, f"{words(40, 2, 9)} {passage} {words(40, 2, 9)}"))
            (long if len(passage) >= 400 else short).add(i)
    clean = set(range(1000, 1060))
    rows += [(i, words(180, 2, 9)) for i in sorted(clean)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r for r in repeats.without_repeats(docs).collect()}
    assert len(long) > 20 and len(short) > 20
    assert {i for i, r in got.items() if r["n_removed"]} >= long
    assert not any(got[i]["n_removed"] for i in clean)
    assert {i: digest(r) for i, r in got.items()} == dict(zip([i for i, _ in rows], brute([t for _, t in rows])))
    assert all(got[i]["n_bytes"] == len(t) for i, t in rows)  # what comes in, whatever goes
