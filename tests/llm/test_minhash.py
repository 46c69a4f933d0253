from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from intentloom.llm import blocks, common, minhash, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_groups(rows):
    """(doc_id, n_shingles, component id, component) by comparing all pairs of sets that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    tried = set()
    for who in holders.values():
        for a, i in enumerate(who):
            for j in who[a + 1 :]:
                if (i, j) in tried:
                    continue
                tried.add((i, j))
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    up[root(j)] = root(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(sets[i]), least.get(root(i)), root(i)) for i, (doc, _) in enumerate(rows)]


def brute(rows):
    return [x[:3] for x in brute_groups(rows)]


def staying(rows):
    """Ids of the rows that stay: the least of each component, and of every row without words."""
    found = brute_groups(rows)
    least = {at: c for _, n, c, at in found if n}
    return [*least.values(), *[doc for doc, n, _, _ in found if not n]]


def prose(rng, n, words=4000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def planted():
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (None, "One two"), (7, "ſ K ONE two"), (8, "ſ K one two")]
    shared = prose(rng, 50)
    for g in range(12):
        base = prose(rng, rng.randint(40, 300))
        for k in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = rng.choice(["x", "y", "z"]) + str(rng.randrange(99))
            rows.append((100 + 20 * g + k, " ".join(w)))
    loose = prose(rng, 150)
    for k in range(400):
        w = list(loose)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000 + k, " ".join(shared + prose(rng, rng.randint(20, 200)))) for k in range(150)]
    rows += [(100, rows[9][1]), (100, rows[9][1]), (100, "another text under the same id here"), (None, rows[9][1]), (3000, "long " * 20 + " ".join(prose(rng, 30_000)))]
    return rows


def as_key(row):
    return tuple(-1 if v is None else v for v in row)


def test_planted_groups_equal_brute_force(spark, tmp_path):
    rows = planted()
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = minhash.op9_minhash(spark, str(tmp_path)).collect()
    assert sorted(as_key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(as_key, brute(rows)))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    stay = minhash.distinct_documents(df.selectExpr("*", "1 as row", "2 as gone", "3 as doc"))
    assert stay.columns[-3:] == ["row", "gone", "doc"]
    want = sorted(-1 if d is None else d for d in staying(rows))
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in stay.collect()) == want


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(3)
    a, b, c, d = (" ".join(prose(rng, 60)) for _ in range(4))
    near = a.split(" ")
    near[0] = "changed"
    rows = [(5, a)] * 40 + [(5, a.upper()), (5, " ".join(near)), (7, a), (None, a)] + [(None, b)] * 30 + [(None, c), (None, c + "\n")] + [(9, d), (1, ""), (1, ""), (None, None)]
    df = spark.createDataFrame([(i, t, "en", f"s{k % 3}", k) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(5)
    stay = minhash.distinct_documents(df)
    assert stay.schema == df.schema
    got = collections.Counter((r["doc_id"], (r["text"] or "").lower().strip().split(" ")[-1]) for r in stay.collect())
    last = [x.split(" ")[-1] for x in (a, b, c, d)]
    assert got == {(5, last[0]): 1, (None, last[1]): 1, (None, last[2]): 1, (9, last[3]): 1, (1, ""): 2, (None, ""): 1}
    assert sorted(map(str, stay.collect())) == sorted(map(str, minhash.distinct_documents(df.repartition(3)).collect()))


def test_given_documents_equal_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = minhash.op9_minhash(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(rows))


def test_sets_equal_plain_python():
    rng = random.Random(2)
    texts = [" ".join(prose(rng, n, 30)) for n in range(0, 200, 3)] + ["A\x0bb\x0cc\rd\ne\tf", "é É\xa0x y", "x" * 3_000_000 + " y z"]
    for t in texts:
        assert len(shingles.shingle_set(t)) == len(shingle_set(t))
    assert shingles.set_key(shingles.shingle_set("A b C")) == shingles.set_key(shingles.shingle_set("a  B c\n"))
    long = " ".join(prose(rng, 400_000, 10**6))
    assert len(shingles.shingle_set(long)) == len(shingle_set(long))


def test_forest_takes_the_smallest_row():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n, m = 40, int(rng.integers(0, 40))
        i, j = rng.integers(0, n, m), rng.integers(0, n, m)
        top = list(range(n))
        for _ in range(n):
            for a, b in zip(i, j):
                top[a] = top[b] = min(top[a], top[b])
        assert blocks.forest(n, i, j).tolist() == top


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.distinct_documents(docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5])
def test_lags_give_every_pair_of_a_unit(n):
    units = np.repeat([0, 1, 2], [n, 2, 3])
    pairs = {(int(a), int(b)) for i, j in blocks.lagged(units) for a, b in zip(i, j)}
    assert pairs == {(a, b) for a in range(n + 5) for b in range(a + 1, n + 5) if units[a] == units[b]}


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_in_one_task_and_by_rounds(spark, monkeypatch, few, tmp_path):
    monkeypatch.setattr(common, "FEW_LINKS", few)
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    tables = []
    for k in range(2):
        spark.createDataFrame(links[k::2], "a long, b long").repartition(3).write.parquet(f"{tmp_path}/{k}")
        tables.append(spark.read.parquet(f"{tmp_path}/{k}"))
    sets = common.Forest(500)
    for i, j in links:
        sets.link(i, j)
    want = sorted((i, sets.root(i)) for i in {x for a, b in links if a != b for x in (a, b)})
    assert sorted(map(tuple, common.components(*tables).collect())) == want
    assert common.components(tables[0].limit(0)).count() == 0
    keys = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in [(200, 3), (3, 100), (9, 8)]], "a binary, b binary")
    assert sorted((bytes(n), bytes(r)) for n, r in common.components(keys).collect()) == [(b"\x03", b"\x03"), (b"\x08", b"\x08"), (b"\x09", b"\x08"), (b"d", b"\x03"), (b"\xc8", b"\x03")]
