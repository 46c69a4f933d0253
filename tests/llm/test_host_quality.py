from __future__ import annotations

import collections
import re

import duckdb
import pytest
from check_oracle import compare

from intentloom.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    w = WORDS.findall(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {p for where in at.values() if len(where) > 1 for i in where for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \n\t ", "one", "a b", "a b c", "a b c a b c", "x y z # <b>\nx y z # <b>\n\n",
    "a " * 60, " ".join(f"w{i}" for i in range(60)), "é😀 ß " * 30, "a b c d e a b c f g h d e a " * 40,
    "\x0b\x0cword\r\nword\r\n\r\n  \nlast", " ".join(f"w{i % 4001}" for i in range(20_000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[9], (None, TEXTS[9], None, None, None)], SCHEMA)


def test_measures_equal_plain_python(docs):
    from pyspark.sql import functions as F

    got = quality.document_rules(docs, F.col("text"), F.col("source")).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert tuple(r[m] for m in (*quality.MEASURES, "base_failed")) == brute(r["doc"]["text"])


def test_bad_host_takes_its_documents_along(spark):
    good, bad = TEXTS[9], "short"
    rows = [(i, good, "en", "fine", 0) for i in range(95)] + [(100 + i, bad, "en", "fine", 0) for i in range(5)]
    rows += [(200 + i, bad, "en", "junk", 0) for i in range(90)] + [(300 + i, good, "en", "junk", 0) for i in range(10)]
    rows += [(400, bad, "en", "tiny", 0), (401, good, "en", "tiny", 0), (402, good, "en", None, 0)]
    rows += [(500 + 100 * h + i, good if i > 2 else bad, "en", f"h{h}", 0) for h in range(20) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as host", "2 as kept", "3 as doc")
    out = quality.good_documents(df)
    assert out.columns == df.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert kept == {r[0] for r in rows if r[1] == good and r[3] != "junk"}


def test_prior_of_no_hosts_and_of_equal_hosts(spark):
    none = spark.createDataFrame([], "host string, n long, failed long")
    assert quality.fit_prior(none) == quality.BetaPrior(1.0, 1.0)
    same = spark.createDataFrame([("a", 10, 0), ("b", 5, 0)], none.schema)
    assert quality.fit_prior(same) == quality.BetaPrior(1.0, 1.0)


def test_empty_table(docs):
    assert quality.good_documents(docs.limit(0)).count() == 0


def test_query_equals_sql_on_odd_texts(spark, docs, tmp_path):
    docs.filter("doc_id is not null").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = quality.op4_host_quality(spark, str(tmp_path)).toPandas()
    assert compare(got, con.execute(quality.OP4_SQL).fetchdf()) is None
