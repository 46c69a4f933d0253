"""Run registered queries against their SQL checks: python tests/check_oracle.py <sf_dir> [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns by name; whole floats and ints compare equal."""

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return None
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        if isinstance(v, (int, np.integer)):
            return int(v)
        if isinstance(v, (float, np.floating)):
            return float(v)
        return str(v)

    cols = sorted(df.columns)
    rows = [tuple(cell(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v).__name__), str(v)) for v in r))


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} vs {len(duck_df)}"
    for c in spark_df.columns:
        a, b = spark_df[c].dtype.kind, duck_df[c].dtype.kind
        if a == "f" and b == "i" and duck_df[c].isna().any():
            continue  # pandas holds a Spark integer with nulls as a float
        if a != b and {a, b} - {"i", "u"}:
            return f"type of {c}: {spark_df[c].dtype} vs {duck_df[c].dtype}"
    bad = [(x, y) for x, y in zip(canonical(spark_df), canonical(duck_df)) if x != y]
    if bad:
        return f"{len(bad)} rows differ, e.g. {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from intentloom.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - start
            sql = oracle_sql().get(name)
            why = compare(got, con.execute(sql).fetchdf()) if sql else None
            verdict = f"FAIL {why}" if why else ("ok" if sql else "rows only")
        except Exception as error:  # report and go on with the next query
            took, verdict = time.time() - start, f"ERROR {str(error)[:600]}"
        failed += verdict.startswith(("FAIL", "ERROR"))
        print(f"{name:28s} {took:6.2f}s  {len(got) if 'got' in dir() else 0:7d} rows  {verdict}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
