from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from intentloom.operators import quality as q
from intentloom.operators import sampling as s


@pytest.fixture(scope="module")
def even(spark):
    """1,540 rows, 20 per class."""
    return spark.range(1_540).select(
        F.col("id").alias("sample_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), (F.col("id") % 77).cast("int").alias("label")
    )


def test_clean_table_has_no_violations(even):
    assert q.schema_violations(even, q.full_rules()).isEmpty()
    row = q.class_distribution_check(even).first()
    assert row["passed"] and row["classes_present"] == 77 and row["classes_missing"] == 0


def test_rules_and_their_bounds(spark):
    rows = [(0, None, "0"), (1, "valid", "1"), (2, "", "2"), (3, "x" * 512, "76"), (4, "x" * 513, "77"), (5, "ok", None), (6, "ok", "1.5x"), (7, "ok", "-1")]
    df = spark.createDataFrame(rows, "sample_id long, text string, label string")
    full = {(r["sample_id"], r["rule"]) for r in q.schema_violations(df, q.full_rules()).collect()}
    assert full == {
        (0, "text_null"), (2, "text_length"), (4, "text_length"), (4, "label_range"), (5, "label_null"), (6, "label_type"), (7, "label_range"),
    }
    weak = {(r["sample_id"], r["rule"]) for r in q.schema_violations(df, q.min_rules()).collect()}
    assert (4, "text_length") not in weak and (2, "text_empty") in weak


def test_one_row_per_class_fails(spark):
    df = spark.range(77).select(F.col("id").cast("int").alias("label"))
    assert q.class_distribution_check(df).first()["passed"] is False


def test_missing_classes_do_not_fail(spark):
    df = spark.range(20).select((F.col("id") % 2).cast("int").alias("label"))
    row = q.class_distribution_check(df).first()
    assert row["passed"] and row["classes_missing"] == 75


def test_request_bounds(spark):
    texts = spark.createDataFrame([("a", ""), ("b", "   "), ("c", "x" * 10_000), ("d", "x" * 10_001), ("e", None)], "id string, text string")
    got = {r["request_id"]: r["reason"] for r in q.text_requests(texts, "id").collect()}
    assert got == {"a": "too_short", "b": "ok", "c": "ok", "d": "too_long", "e": "missing"}
    batches = spark.range(301).select(F.when(F.col("id") < 100, "full").when(F.col("id") < 201, "over").otherwise("x").alias("b"), F.lit("t").alias("text"))
    got = {r["request_id"]: r["reason"] for r in q.batch_requests(batches, "b").collect()}
    assert got == {"full": "ok", "over": "too_long", "x": "ok"}


def test_label_lookup_falls_back(spark):
    df = spark.createDataFrame([(0,), (99,)], "label int")
    names = spark.createDataFrame([(0, "activate"), (1, "other")], "label int, label_name string")
    assert {r["label"]: r["label_name"] for r in q.label_lookup(df, names).collect()} == {0: "activate", 99: "class_99"}


def test_nan_check(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([float("nan"), 1.0],)], "logits array<double>")
    assert q.nan_logit_check(df).first().asDict() == {"rows": 2, "nan_rows": 1, "passed": False}


def test_no_shared_columns(spark):
    out = q.shared_columns(spark.range(2).toDF("a"), spark.range(2).toDF("b"))
    assert out.columns == ["error"] and out.first()[0] == "no_shared_columns"


def test_split_is_exact_disjoint_and_complete(even):
    split = s.stratified_split(even)
    assert split.count() == 1_540 and split.select("sample_id").distinct().count() == 1_540
    cells = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert all(cells[label, "train"] == 14 and cells[label, "val"] == 3 and cells[label, "test"] == 3 for label in range(77))
    again = {r["sample_id"]: r["split"] for r in s.stratified_split(even).collect()}
    assert again == {r["sample_id"]: r["split"] for r in split.collect()}
    audit = q.split_audit(split, {"train": 0.7, "val": 0.15, "test": 0.15})
    assert audit.filter("not passed").isEmpty() and audit.count() == 13


def test_audit_sees_a_shared_id(even):
    both = even.limit(10).withColumn("split", F.lit("train")).unionByName(even.limit(3).withColumn("split", F.lit("test")))
    assert q.split_audit(both, {"train": 0.7, "test": 0.3}).filter("check = 'shared_ids'").first()["passed"] is False


def test_few_shot_takes_what_there_is(even):
    assert s.few_shot_sample(even, 8).count() == 8 * 77
    assert s.few_shot_sample(even, 50).count() == 1_540


def test_augment_lifts_to_the_median(spark):
    sizes = {0: 100, 1: 11, 2: 60, 3: 59, 4: 1}
    rows = [(i, f"lost card number {i}", label) for i, label in enumerate(x for x, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "sample_id long, text string, label int")
    for block in (7, 10_000):
        out = s.augment_minority(df, block=block)
        counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
        assert counts == {0: 100, 1: 59, 2: 60, 3: 59, 4: 59}
        made = out.filter("copy_no > 0").collect()
        assert {r["label"] for r in made} == {1, 4}
        assert all(dict((i, label) for i, _, label in rows)[r["source_id"]] == r["label"] for r in made)
        assert out.filter("copy_no = 0").count() == len(rows)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    weights = {r["label"]: r["weight"] for r in s.class_weights(df).collect()}
    assert weights == pytest.approx({0: 8 / 12, 1: 2.0})
    with pytest.raises(ValueError, match="2"):
        s.class_weights(df, expected=[0, 1, 2])


def test_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(100)], "sample_id long, label int")
    split = s.stratified_split(df)
    assert split.count() == 100 and split.filter("label is null and split is null").count() == 20
    assert {r["split"]: r["count"] for r in split.filter("label = 0").groupBy("split").count().collect()} == {"train": 28, "val": 6, "test": 6}
    weighted = s.with_class_weights(df).collect()
    assert len(weighted) == 100
    assert all(r["weight"] == (None if r["label"] is None else 1.0) for r in weighted)
