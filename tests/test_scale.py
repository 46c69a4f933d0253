"""The split-key ranks, cuts and percentiles against the plain built-ins they replace."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions import scale
from intentloom.functions.hashing import hash_unit, row_hash


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows, two thirds of them in one group."""
    g = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
    return spark.range(3_000).select("id", g.alias("g"), row_hash("id").alias("h"))


def test_hash_rank_equals_row_number(skewed):
    plain = skewed.withColumn("want", F.row_number().over(W.partitionBy("g").orderBy("h")))
    got = scale.hash_rank(plain, ["g"], "h")
    assert got.count() == 3_000
    assert got.filter("want <> rn").isEmpty()


def test_hash_cuts_take_exact_counts(skewed):
    cuts = scale.hash_cuts(skewed, ["g"], "h", {"a": F.floor(F.col("_total") / 3), "none": F.lit(0)})
    taken = skewed.join(cuts, "g").groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("h") <= F.col("a")).alias("t"), F.max("none").alias("none")
    )
    for row in taken.collect():
        assert row["t"] == row["n"] // 3
        assert row["none"] is None


def test_hash_cut_over_whole_table(skewed):
    cut = scale.hash_cuts(skewed, [], "h", {"a": F.lit(17)}).first()["a"]
    assert skewed.filter(F.col("h") <= cut).count() == 17


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_exact_percentiles_equal_builtin(spark, buckets):
    rng = random.Random(1)
    values = [("a", rng.lognormvariate(0, 3)) for _ in range(2_000)] + [("b", 5.0)] * 1_000 + [("c", -1.5), ("c", None)]
    df = spark.createDataFrame(values, "g string, v double")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in scale.exact_percentiles(df, ["g"], "v", probs, buckets).collect()}
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()])
    for row in want.collect():
        for name in probs:
            assert got[row["g"]][name] == pytest.approx(row[name], rel=1e-12)


def test_percentile_by_hand(spark):
    df = spark.createDataFrame([(1, float(v)) for v in range(5)], "g int, v double")
    assert scale.exact_percentiles(df, ["g"], "v", {"p": 0.95}).first()["p"] == pytest.approx(3.8)


def test_running_counts_cross_bucket_bounds(spark):
    df = spark.createDataFrame([("x", v % 10, float(v % 10), 1) for v in range(100)], "k string, raw int, v double, n int")
    marked = scale.with_bucket(df, "v", [2.0, 5.0, 8.0], "b")
    rows = scale.running_counts(marked, ["k"], "b", "v", ["n"]).orderBy("v").collect()
    assert [r["cum_n"] for r in rows] == [10 * (i + 1) for i in range(10)]
    assert [r["next_value"] for r in rows] == [float(i + 1) for i in range(9)] + [None]
    assert {r["all_n"] for r in rows} == {100}


def test_broadcast_small_checks_the_size(spark):
    small = scale.broadcast_small(spark.range(10))
    large = scale.broadcast_small(spark.range(1_000), max_rows=100)
    other = spark.range(10_000_000)
    assert "BroadcastHashJoin" in other.join(small, "id")._jdf.queryExecution().executedPlan().toString()
    assert large.count() == 1_000


def test_hash_unit_range(spark):
    stats = spark.range(5_000).select(hash_unit(row_hash("id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.02


def test_intermediate_tables_are_deleted(spark, monkeypatch, tmp_path):
    from intentloom import session

    monkeypatch.setattr(session, "_MADE", [])
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    kept = session.through_table(spark.range(3), "numbers")
    assert kept.count() == 3 and len(list(tmp_path.iterdir())) == 1
    session.drop_scratch(spark)
    assert list(tmp_path.iterdir()) == [] and session._MADE == []
