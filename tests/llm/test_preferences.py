from __future__ import annotations

import duckdb
from check_oracle import compare

from intentloom.llm import preferences

SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [
    (0, 0, "system", "Be brief."), (0, 1, "user", "Hi é😀"), (0, 2, "assistant", "Hello"), (0, 3, "user", "More"), (0, 4, "assistant", "Sure, more."),
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi é😀"), (1, 2, "assistant", "Hello"), (1, 3, "user", "Other"), (1, 4, "assistant", "x"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "same"), (3, 1, "assistant", "same"),
    (4, 0, "user", "alone"), (4, 1, "assistant", "answer"),
    (6, 0, None, None), (6, 1, "assistant", ""), (7, 0, None, None), (7, 1, "assistant", "y" * 50_000),
    (8, 0, "user", "a"), (8, 0, "assistant", "tie"), (8, 0, "assistant", "tie"), (9, None, "user", "a"),
    (10, 0, "user", "p"), (11, 0, "user", "p"), (11, 1, "assistant", "longer"),
    (None, 0, "user", "lost"),
]


def test_prompts_completions_and_masks(spark, tmp_path):
    spark.createDataFrame(TURNS, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    frame = preferences.op2_preferences(spark, str(tmp_path))
    got = {r["pair"]: r for r in frame.collect()}
    first = got[0]
    assert (first["chosen_id"], first["rejected_id"], first["n_prompt_turns"]) == (0, 1, 3)
    assert first["prompt"] == "<|system|>\nBe brief.\n<|user|>\nHi é😀\n<|assistant|>\nHello\n"
    assert first["chosen"] == "<|user|>\nMore\n<|assistant|>\nSure, more.\n"
    (span,) = first["chosen_mask"].split(",")
    a, b = map(int, span.split(":"))
    assert first["chosen"][a:b] == "Sure, more."
    assert (got[1]["chosen_id"], got[1]["chosen"], got[1]["rejected"]) == (2, "", "")
    assert (got[2]["rejected_id"], got[2]["rejected"], got[2]["prompt"]) == (None, None, "")
    assert got[3]["chosen_id"] == 7 and got[3]["n_prompt_turns"] == 1
    assert (got[5]["chosen_id"], got[5]["rejected"], got[5]["rejected_mask"]) == (11, "", "")
    assert set(got) == {0, 1, 2, 3, 4, 5}
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    whole = f"select * from ({preferences.OP2_SQL}) where rejected_id is not null"
    assert compare(frame.filter("rejected_id is not null").toPandas(), con.execute(whole).fetchdf()) is None


def test_clashing_names_and_empty_table(spark):
    turns = spark.createDataFrame([(1, *TURNS[0], 5, 6)], f"pair long, {SCHEMA}, turns int, a int")
    assert preferences.preference_rows(turns).count() == 1
    assert preferences.preference_rows(turns.limit(0)).count() == 0
