"""Expiring de-duplication against a plain simulation of a cache."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from intentloom.operators import dedup

SCHEMA = "prediction_id bigint, text_key string, ts timestamp_ntz, predicted_label int, confidence double, batch boolean"


def simulate(rows, ttl_ms):
    """{id: (hit, computed id)} of a cache with absolute expiry, rows in (time, id) order."""
    cache, out = {}, {}
    for i, key, ms, forced in sorted(rows, key=lambda r: (r[2], r[0])):
        expiry, source = cache.get(key, (None, None))
        hit = expiry is not None and ms < expiry and not forced
        if not hit:
            cache[key] = (ms + ttl_ms, i)
            source = i
        out[i] = (hit, source)
    return out


def random_rows(seed, n, span_ms, forced_share):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    rows = [(i, rng.choice(keys), rng.randrange(span_ms), rng.random() < forced_share) for i in range(n)]
    return rows + [(n, "once", 5, False), (n + 1, "edge", 0, False), (n + 2, "edge", 10_000, False), (n + 3, "edge", 9_999, False)]


@pytest.mark.parametrize("hot_rows", [10_000, 20])
@pytest.mark.parametrize("forced_share", [0.0, 0.1])
@pytest.mark.parametrize("span_ms", [200_000, 2_000_000])
def test_equals_simulation(spark, hot_rows, forced_share, span_ms):
    ttl_ms = 10_000
    rows = random_rows(7, 600, span_ms, forced_share)
    df = spark.createDataFrame(
        [(i, k, ms, i % 5, i / 1000, f) for i, k, ms, f in rows],
        "prediction_id bigint, text_key string, ms bigint, predicted_label int, confidence double, batch boolean",
    ).withColumn("ts", F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, ms / 1000)"))
    out = dedup.ttl_dedup(df, overwrite="batch", ttl_seconds=10, hot_rows=hot_rows).collect()
    want = simulate(rows, ttl_ms)
    assert len(out) == len(rows)
    for r in out:
        assert (r["hit"], r["computed_id"]) == want[r["prediction_id"]], r
        assert r["predicted_label"] == r["computed_id"] % 5
        assert r["confidence"] == r["computed_id"] / 1000


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 400), st.integers(0, 9)), min_size=1, max_size=60, unique_by=lambda x: x[0]),
    st.integers(5, 30),
    st.integers(1, 4),
    st.integers(2, 5),
)
def test_composed_chunks_equal_one_walk(instants, ttl, periods, fan_in):
    """Tables of chunks, composed in any grouping, lead where a walk over all instants leads."""
    instants.sort()
    t = np.array([x[0] for x in instants], dtype="int64")
    forced = np.array([x[1] == 0 for x in instants])
    allowed = dedup.ALWAYS
    for now, force in zip(t, forced):
        if force or now >= allowed:
            allowed = now + ttl
    length = periods * ttl
    tables = []
    for chunk in sorted({int((x - t[0]) // length) for x in t}):
        inside = (t - t[0]) // length == chunk
        reach = int(t[0]) + chunk * length + ttl
        tables.append((chunk, dedup._chunk_table(t[inside], forced[inside], ttl, reach)))
    while len({c for c, _ in tables}) > 1:
        groups: dict[int, list] = {}
        for chunk, table in tables:
            groups.setdefault(chunk // fan_in, []).append(table)
        tables = [(c, dedup._compose(g)) for c, g in sorted(groups.items())]
    end = dedup._apply(tables[0][1], np.array([dedup.ALWAYS]))
    assert int(end[0]) == int(allowed)


def test_period_does_not_slide(spark):
    at = ["00:00:00", "00:50:00", "00:59:59.999", "01:00:00", "01:59:00", "02:00:00"]
    rows = [(i, "k", f"2024-01-01 {t}", 0, 0.5, False) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    hits = {r["prediction_id"]: r["hit"] for r in dedup.ttl_dedup(df).collect()}
    assert hits == {0: False, 1: True, 2: True, 3: False, 4: True, 5: False}


def test_requests_without_a_key_stand_alone(spark):
    from intentloom.operators.dedup import ttl_dedup

    rows = [(1, None, "2024-01-01 00:00:00"), (2, None, "2024-01-01 00:00:01"), (3, "a", "2024-01-01 00:00:00"), (4, "a", "2024-01-01 00:00:01")]
    log = spark.createDataFrame(rows, "prediction_id long, text_key string, ts string").selectExpr(
        "prediction_id", "text_key", "cast(ts as timestamp) ts", "cast(prediction_id as int) predicted_label", "0.5D confidence"
    )
    got = {r["prediction_id"]: (r["hit"], r["computed_id"], r["predicted_label"]) for r in ttl_dedup(log).collect()}
    assert got == {1: (False, 1, 1), 2: (False, 2, 2), 3: (False, 3, 3), 4: (True, 3, 3)}


def as_log(spark, rows):
    df = spark.createDataFrame(
        [(i, k, ms, i % 5, i / 1000, f) for i, k, ms, f in rows],
        "prediction_id bigint, text_key string, ms bigint, predicted_label int, confidence double, batch boolean",
    )
    return df.withColumn("ts", F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, ms / 1000)"))


@pytest.mark.parametrize("batch_rows", [1, 7])
def test_periods_go_on_in_the_next_batch(spark, batch_rows):
    rows = random_rows(11, 300, 100_000, 0.05)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        out = dedup.ttl_dedup(as_log(spark, rows), overwrite="batch", ttl_seconds=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["prediction_id"]: (r["hit"], r["computed_id"]) for r in out} == simulate(rows, 10_000)


def test_crowded_instants_are_cut_by_row_count(spark, monkeypatch):
    """A third of all rows in one millisecond of one key, and more in the period after it."""
    monkeypatch.setattr(dedup, "SLOT_ROWS", 40)
    rng = random.Random(5)
    rows = [(i, "hot", 50_000, i % 97 == 0) for i in range(400)]
    rows += [(1000 + i, "hot", 50_001 + rng.randrange(25_000), False) for i in range(400)]
    rows += [(2000 + i, rng.choice("abc"), rng.randrange(90_000), False) for i in range(400)]
    out = dedup.ttl_dedup(as_log(spark, rows), overwrite="batch", ttl_seconds=10, hot_rows=200).collect()
    assert {r["prediction_id"]: (r["hit"], r["computed_id"]) for r in out} == simulate(rows, 10_000)
    assert all(r["confidence"] == r["computed_id"] / 1000 for r in out)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 200), st.integers(0, 9)), min_size=1, max_size=80),
    st.integers(1, 40),
    st.integers(-50, 250),
    st.sampled_from([0, 1 << 58]),
)
def test_ranked_successors_equal_a_walk(rows, ttl, allowed, far):
    rows.sort(key=lambda r: r[:2])
    keys = sorted({k for k, _, _ in rows})
    run = np.array([keys.index(k) for k, _, _ in rows])
    t = np.array([x + far * k for k, x, _ in rows], dtype="int64") - far * keys[0]
    forced = np.array([f == 0 for _, _, f in rows])
    want, free = [], {0: allowed}
    for k, now, force in zip(run, t, forced):
        made = bool(force) or now >= free.get(k, dedup.ALWAYS)
        if made:
            free[k] = now + ttl
        want.append(made)
    assert dedup.computed_in(run, t, forced, allowed, ttl).tolist() == want


def test_time_grows_with_the_misses():
    """Twice the computations of one key take about twice as long, not four times."""

    def seconds(n):
        t, none = np.arange(n, dtype="int64") * 10, np.zeros(n, bool)
        start = time.perf_counter()
        assert dedup.computed_in(np.zeros(n, "int64"), t, none, dedup.ALWAYS, 10).all()
        return time.perf_counter() - start

    seconds(1000)
    assert min(seconds(800_000) for _ in range(3)) < 3.2 * min(seconds(400_000) for _ in range(3))


def test_requests_without_a_time_stand_alone(spark):
    rows = [(1, "a", None), (2, "a", "2024-01-01 00:00:00"), (3, "a", "2024-01-01 00:00:01"), (4, "a", None)]
    log = spark.createDataFrame(rows, "prediction_id long, text_key string, ts string").selectExpr(
        "prediction_id", "text_key", "cast(ts as timestamp) ts", "cast(prediction_id as int) predicted_label", "0.5D confidence", "1 as key", "2 as us"
    )
    got = {r["prediction_id"]: (r["hit"], r["computed_id"]) for r in dedup.ttl_dedup(log).collect()}
    assert got == {1: (False, 1), 2: (False, 2), 3: (True, 2), 4: (False, 4)}
    assert dedup.ttl_dedup(log.limit(0)).count() == 0
