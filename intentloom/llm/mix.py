"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``rate = target / source size`` times. The expected copies are
summed up along the source, one random offset per source is added, and a document is emitted once for
each integer that its stretch of the sum crosses. Along a source the documents are ordered from long to
short (by size class, then by a seeded hash), so the words taken differ from the target by about one
document of the largest class at most.

Defined results: null or empty text has size 0 and is drawn like any other; a null source is a source
of its own, last in order; a source of size 0 has target and copies 0; repeated rows are drawn each on
their own; an empty table gives an empty result; sources may be as many as documents. The caller's columns travel in one
struct, so no name of theirs can clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import WORD, bucketed_rank, read, sums_before
from intentloom.session import through_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
CAP = 2  # times its size that a source, and so a document, is taken at most
SEED = "mix-1"
OFFSETS = 1024
BUCKET_ROWS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``sizes`` (of, n: one row per source) with ``target``: ``share`` of all words dealt by weight, none above its cap.

    What is above a cap is dealt again by weight among the others until none is above. Filling sources
    in the order of cap / weight gives that state at once: the level is what is left over the weights left
    at the first source that is not filled. Both come from prefix sums, so sources may be as many as rows.
    """
    by_name = F.col("of").asc_nulls_last()
    placed = sums_before(sizes.withColumn("one", F.lit(1)), [by_name], place="one")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    dealt = through_table(placed.select("of", "n", weight.alias("weight"), (CAP * F.col("n")).alias("cap")), "weights")
    words, weigh = dealt.agg(F.sum("n"), F.sum("weight")).first()
    height = (F.col("cap") / F.col("weight")).alias("height")
    filled = sums_before(dealt.select("*", height), [F.col("height"), by_name], caps="cap", weights="weight")
    level = (F.lit(share * (words or 0)) - F.col("caps")) / (F.lit(weigh or 0) - F.col("weights"))
    first = F.min(F.struct("height", F.col("of").isNull(), "of", level.alias("level")))
    stop = filled.filter(F.col("cap") > F.col("weight") * level).agg(first.alias("first")).first()["first"]
    dealt_out = F.col("weight") * F.lit(stop["level"] if stop else math.inf)
    return dealt.select("of", "n", F.least(F.col("cap").cast("double"), dealt_out).alias("target"))


def mix_copies(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """One row per document: ``doc`` (its whole row), size, source_size, target and copies.

    ``docs`` is read three times; what it carries (such as texts) moves through one shuffle.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(source_col).alias("of"), size.alias("size"))
    found = through_table(rows.groupBy("of").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")), "sources")
    total = found.agg(F.sum("rows")).first()[0] or 1
    digits = 1 + max(0, math.ceil(math.log(total / BUCKET_ROWS / 16, 16)))
    known = F.coalesce(F.concat(F.lit("s"), F.col("of")), F.lit("n")).alias("of")
    rate = F.when(F.col("n") > 0, F.col("target") / F.col("n")).otherwise(0.0).alias("rate")
    plan = targets(found.select("of", "n")).select(known, F.col("n").alias("source_size"), "target", rate)
    marked = rows.select(
        "doc", "size", known, F.md5(F.concat_ws("|", F.lit(seed), F.col("id").cast("string"))).alias("key"),
        F.greatest(F.length(F.bin("size")) - 4, F.lit(0)).alias("bits"),
    )
    long_first = F.lpad((1_000_000 - F.expr("bits * 16 + shiftright(size, bits)")).cast("string"), 7, "0")
    marked = marked.withColumn("bucket", F.concat(long_first, F.substring("key", 1, digits)))
    ranked = bucketed_rank(marked, ["of"], "bucket", [F.col("key"), F.col("size")], "rank", plan)
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "of")), 1, 8), 16, 10).cast("long")
    drawn = ranked.withColumn("u", (start % OFFSETS + F.lit(0.5)) / OFFSETS)
    crossed = F.floor(F.expr("rank * rate + u")) - F.floor(F.expr("(rank - 1) * rate + u"))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.least(crossed, F.lit(CAP))).cast("int")
    return drawn.select("doc", "size", "source_size", "target", copies.alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was drawn, with the columns of ``docs``."""
    drawn = mix_copies(docs, word_count(F.col("text"))).filter("copies > 0")
    return drawn.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    drawn = mix_copies(through_table(docs, "sizes"), F.col("size"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return drawn.select("doc.doc_id", "size", "source_size", "target", taken, "copies")


OP3_SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size
  from documents),
s as (select source, cast(sum(size) as bigint) n from d group by 1),
w as (
  select source, n, 2 * n cap,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end wt
  from s),
o as (
  select *, 1.5::double * (sum(n) over ())::double - coalesce((sum(cap) over before)::double, 0) lft,
    (sum(wt) over ())::double - coalesce((sum(wt) over before)::double, 0) rst,
    row_number() over (order by cap::double / wt, source nulls last) pos
  from w
  window before as (order by cap::double / wt, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select arg_min(lft / rst, pos) lvl from o where cap > wt * (lft / rst)),
t as (select source, n, least(cap::double, wt * coalesce(lvl, 'infinity'::double)) target from o, l),
r as (
  select d.*, n, target, case when n > 0 then target / n else 0 end rate,
    row_number() over (partition by d.source order by
      greatest(length(bin(size)) - 4, 0) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) desc,
      md5('mix-1|' || doc_id::varchar), size) k,
    (('0x' || substr(md5('mix-1|' || coalesce('s' || d.source, 'n')), 1, 8))::bigint % 1024 + 0.5::double) / 1024 u
  from d join t on d.source is not distinct from t.source)
select doc_id, size, n source_size, target::double target,
  (size * c)::bigint taken, c::int copies
from (select *, case when size = 0 then 0 else least(floor(k * rate + u) - floor((k - 1) * rate + u), 2) end c from r)
"""
