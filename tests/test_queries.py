"""Every registered query against its SQL check, or for its rows where SQL cannot say it."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(name, spark, sf_dir, duck):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert compare(got, duck.execute(entry.oracle_sql()[name]).fetchdf()) is None


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 89


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


def test_trainer_rows(spark, sf_dir):
    row = entry.queries()["train_logreg"](spark, sf_dir).first()
    assert 0.5 <= row["accuracy"] <= 1.0
    assert row["f1_micro"] == row["accuracy"]
