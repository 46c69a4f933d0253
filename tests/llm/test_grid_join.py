from __future__ import annotations

import math

import numpy as np

from intentloom.llm import grid_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def ok(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v, label) in enumerate(rows) if ok(v, label)]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, i in enumerate(good):
        x = np.array(rows[i][1], np.float32).astype(float)
        for j in good[a + 1 :]:
            if rows[i][2] != rows[j][2] or len(rows[i][1]) != len(rows[j][1]):
                continue
            y = np.array(rows[j][1], np.float32).astype(float)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                links[i] += 1
                links[j] += 1
                up[root(j)] = root(i)
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[root(i)] = min(v, least.get(root(i), v))
    return [(r[0], links[i], least.get(root(i))) for i, r in enumerate(rows)]


def key(r):
    return tuple(-1 if x is None else x for x in r)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(0, None, 1), (1, [], 1), (2, [0.0] * 12, 1), (3, [1.0] * 11 + [None], 1), (4, [1.0] * 11 + [float("nan")], 1), (5, [float("inf")] + [1.0] * 11, 1)]
    n = 10
    centres = rng.normal(size=(12, 12))
    for c in range(12):
        for _ in range(int(rng.integers(1, 60))):
            rows.append((n, (centres[c] + rng.normal(size=12) * rng.choice([0.05, 0.3])).tolist(), int(c % 3)))
            n += 1
    hot = rng.normal(size=12)
    rows += [(n + k, (hot + 0.08 * rng.normal(size=12)).tolist(), 0) for k in range(700)]
    n += 700
    rows += [(n + k, hot.tolist(), 0) for k in range(300)]
    n += 300
    rows += [(n + k, rng.normal(size=12).tolist(), int(k % 4)) for k in range(300)]
    n += 300
    rows += [(n, hot.tolist(), None), (n + 1, hot.tolist()[:5], 0), (n + 2, (hot * 1e-30).tolist(), 0), (None, hot.tolist(), 0), (12, rows[8][1], rows[8][2]), (12, rows[9][1], rows[9][2])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as key", "2 as g", "3 as unit")
    got = grid_join.cosine_links(df).collect()
    assert sorted(key((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == sorted(map(key, brute(rows)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_far_blocks_are_skipped(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(40):  # one tight cluster on each of forty axes, a block or more each
        x = np.zeros(40)
        x[c] = 1
        rows += [(c * 300 + k, (x + 0.01 * rng.normal(size=40)).tolist(), 0) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = grid_join.cosine_links(df).collect()
    assert all(r["n_links"] == 299 and r["component_id"] == r["vec_id"] // 300 * 300 for r in got)


def test_empty_table(spark):
    assert grid_join.cosine_links(spark.createDataFrame([], SCHEMA)).count() == 0
    assert grid_join.cosine_links(spark.createDataFrame([(1, None, None)], SCHEMA)).first()["kept"]


def test_no_step_sends_the_vectors_of_a_large_label_many_times(spark, monkeypatch):
    """250 blocks of one label: as block pairs every vector would be sent 251 times at once."""
    rng, sent = np.random.default_rng(3), []
    centres = rng.normal(size=(60, 6))
    rows = [(i, (centres[i % 60] + 0.25 * rng.normal(size=6)).tolist(), 0) for i in range(2000)]
    rows += [(5000 + i, [float(x) for x in rows[i][1]], 0) for i in range(50)]
    compared = grid_join.compared

    def counted(units, *more):
        sent.append(units.count())
        return compared(units, *more)

    monkeypatch.setattr(grid_join, "BLOCK", 8)
    monkeypatch.setattr(grid_join, "compared", counted)
    got = grid_join.cosine_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute(rows))
    assert len(sent) > 1 and max(sent) <= 4 * 2000


def test_found_rows_are_added_up_between_waves(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, (1 + 0.1 * rng.normal(size=5)).tolist(), i % 2) for i in range(400)]
    for name, value in (("BLOCK", 8), ("WIDEST", 4), ("SHARE", 1), ("HELD", 1), ("RUN", 2)):
        monkeypatch.setattr(grid_join, name, value)
    got = grid_join.cosine_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute(rows))


def test_doubles_keep_their_digits(spark):
    v = [1.0, 1e-9, 0.0]
    rows = [(1, v, 0), (2, [2 * x for x in v], 0), (3, [1.0, 2e-9, 0.0], 0), (4, [0.0, 0.0, 1e-300], 0)]
    got = grid_join.cosine_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]
