"""Preference formatting: one prompt from the turns that two conversations share, and two masked completions.

The chosen and the rejected conversation are compared turn by turn; their longest common prefix is
rendered once as the prompt, and what follows in each is its completion. The mask of a completion lists
the code-point ranges (start:end, end exclusive) of the assistant's texts: only there is a loss taken.

Turns are ordered by number, then role, then text; null roles and texts count as empty. Defined results:
turns without a conversation belong to none and are left out; a conversation without a partner is chosen
and has null in place of the rejected side, its whole text being the completion; repeated turns are
turns; a completion may be empty; an empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read

ASSISTANT = "assistant"


def rendered(turns: Column) -> Column:
    """``<|role|>``, the text and a line end, for each turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))), "")


def loss_mask(turns: Column) -> Column:
    """start:end of each assistant text within the rendered turns, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(t["role"]) + 5
        end = begin + F.length(t["text"])
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(
            (end + 1).alias("at"), F.when(t["role"] == ASSISTANT, F.array_append(s["out"], span)).otherwise(s["out"]).alias("out")
        )

    return F.aggregate(turns, start, step, lambda s: F.array_join(s["out"], ","))


def shared_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    same = F.zip_with(a, b, lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    start = F.struct(F.lit(True).alias("on"), F.lit(0).alias("n"))

    def step(s: Column, ok: Column) -> Column:
        on = s["on"] & F.coalesce(ok, F.lit(False))
        return F.struct(on.alias("on"), (s["n"] + on.cast("int")).alias("n"))

    return F.aggregate(same, start, step, lambda s: s["n"])


def preference_rows(turns: DataFrame) -> DataFrame:
    """``turns`` (pair, conv_id, turn, role, text), two conversations to a pair: one row per pair.

    Chosen is the conversation with more assistant text, the smaller id where that is equal. One shuffle
    by pair; a pair is gathered whole, as its rendered text is.
    """
    turn = F.struct("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = turns.filter("pair is not null and conv_id is not null").groupBy("pair")
    pairs = pairs.agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.min("conv_id").alias("one"), F.max("conv_id").alias("two"))

    def of(member: str) -> Column:
        return F.filter("turns", lambda t: t["conv_id"] == F.col(member))

    pairs = pairs.select("pair", "one", "two", of("one").alias("a"), F.when(F.col("one") != F.col("two"), of("two")).alias("b"))

    def said(side: str) -> Column:
        return F.aggregate(side, F.lit(0), lambda n, t: n + F.when(t["role"] == ASSISTANT, F.length(t["text"])).otherwise(0))

    second = F.coalesce(said("b") > said("a"), F.lit(False))
    pairs = pairs.select(
        "pair",
        F.when(second, F.col("two")).otherwise(F.col("one")).alias("chosen_id"),
        F.when(F.col("b").isNull(), None).when(second, F.col("one")).otherwise(F.col("two")).alias("rejected_id"),
        F.when(second, F.col("b")).otherwise(F.col("a")).alias("c"),
        F.when(second, F.col("a")).otherwise(F.col("b")).alias("r"),
        F.coalesce(shared_turns(F.col("a"), F.col("b")), F.lit(0)).alias("n"),
    )

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))

    pairs = pairs.select(
        "pair", "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_prompt_turns"),
        F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), F.when(F.col("r").isNotNull(), rest("r")).alias("r"),
    )
    return pairs.select(
        "pair", "chosen_id", "rejected_id", "n_prompt_turns", rendered(F.col("p")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"), loss_mask(F.col("c")).alias("chosen_mask"),
        rendered(F.col("r")).alias("rejected"), loss_mask(F.col("r")).alias("rejected_mask"),
    )


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given conversations name no preferences: numbers 2k and 2k + 1 are taken as a pair."""
    turns = read(spark, sf_dir, "conversations")
    return preference_rows(turns.select(F.floor(F.col("conv_id") / 2).alias("pair"), "conv_id", "turn", "role", "text"))


OP2_SQL = r"""
with t as (
  select conv_id, floor(conv_id / 2)::bigint pair, coalesce(role, '') role, coalesce(text, '') text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos
  from conversations where conv_id is not null),
conv as (
  select pair, conv_id, count(*) n, coalesce(sum(length(text)) filter (role = 'assistant'), 0) said from t group by 1, 2),
side as (select *, row_number() over (partition by pair order by said desc, conv_id) k from conv),
p as (
  select c.pair, c.conv_id chosen_id, r.conv_id rejected_id, least(c.n, r.n) most
  from side c left join side r on r.pair = c.pair and r.k = 2 where c.k = 1),
diff as (
  select p.pair, min(a.pos) first
  from p join t a on a.conv_id = p.chosen_id join t b on b.conv_id = p.rejected_id and b.pos = a.pos
  where a.role <> b.role or a.text <> b.text group by 1),
q as (select p.*, coalesce(first - 1, most, 0)::bigint n_prompt_turns from p left join diff using (pair)),
part as (
  select q.pair, case when t.conv_id = chosen_id then 'c' else 'r' end side, pos <= n_prompt_turns shared, pos, role,
    length(text) len, '<|' || role || '|>' || chr(10) || text || chr(10) s
  from q join t on t.conv_id = chosen_id or t.conv_id = rejected_id),
placed as (
  select *, coalesce(sum(length(s)) over (partition by pair, side, shared order by pos
    rows between unbounded preceding and 1 preceding), 0)::bigint before from part),
made as (
  select pair, side, shared, string_agg(s, '' order by pos) s,
    string_agg((before + length(role) + 5)::varchar || ':' || (before + length(role) + 5 + len)::varchar, ',' order by pos)
      filter (role = 'assistant') mask
  from placed group by all)
select q.pair, chosen_id, rejected_id, n_prompt_turns, coalesce(m.s, '') prompt, coalesce(c.s, '') chosen, coalesce(c.mask, '') chosen_mask,
  case when rejected_id is not null then coalesce(r.s, '') end rejected,
  case when rejected_id is not null then coalesce(r.mask, '') end rejected_mask
from q
  left join made m on m.pair = q.pair and m.side = 'c' and m.shared
  left join made c on c.pair = q.pair and c.side = 'c' and not c.shared
  left join made r on r.pair = q.pair and r.side = 'r' and not r.shared
"""
