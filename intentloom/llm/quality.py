"""Quality rules per document and per host.

Per document: too few words, or more than half of the words inside 3-word windows that come twice or
more. Failures are added up per host; a host's failure rate is drawn towards the rate of all hosts with
a beta prior fitted to the hosts' own rates (moments, less the binomial noise), so a host of three pages
is not judged by three pages. A host whose shrunken rate is above the limit is rejected, and its verdict
is joined back to its documents.

Defined results: a null or empty text has no words and fails; a null host is judged as no host, so only
its documents' own rules count; repeated rows are judged each on their own; no rows give no rows; the
caller's columns travel in one struct, so no name of theirs can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read, word_array
from intentloom.session import through_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_LIMIT = 0.5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def document_rules(docs: DataFrame, text: Column, host: Column) -> DataFrame:
    """``doc`` (the whole row), host, the measures, and base_failed.

    Repeated windows are found by sorting (hash, position) pairs inside the row, and only where the
    distinct hashes are fewer than the windows.
    """
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(
        F.struct("*").alias("doc"),
        host.alias("host"),
        word_array(text).alias("words"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).alias("n_symbols"),
        lines.alias("lines"),
    )
    rows = rows.select(
        "doc", "host", "n_symbols", "words", F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(
            F.size("words") >= 3,
            F.expr("transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))"),
        ).alias("windows"),
    )
    rows = rows.withColumn(
        "marked",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = F.expr("filter(marked, (w, k) -> coalesce(w.h = get(marked, k - 1).h, false) or coalesce(w.h = get(marked, k + 1).h, false))")
    covered = F.array_distinct(F.flatten(F.transform(again, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))))
    rows = rows.withColumn("n_repeat_words", F.when(F.col("marked").isNull(), 0).otherwise(F.size(covered)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # generated, so that a filter on the result is not pushed below, where each word would split the text again
    made = F.struct(*[F.col(m).cast("long").alias(m) for m in MEASURES], failed.alias("base_failed"))
    return rows.select("doc", "host", F.inline(F.array(made)))


@dataclass(frozen=True)
class BetaPrior:
    alpha: float
    beta: float

    def rate(self, failed: Column, n: Column) -> Column:
        return (failed + self.alpha) / (n + self.alpha + self.beta)


def fit_prior(hosts: DataFrame) -> BetaPrior:
    """Beta prior whose mean and spread are those of the hosts' failure rates (host, n, failed)."""
    p = F.col("failed") / F.col("n")
    row = hosts.agg(
        F.avg(p).alias("mean"), F.var_pop(p).alias("spread"), F.avg(p * (1 - p) / F.col("n")).alias("noise")
    ).first()
    if row["mean"] is None or row["mean"] in (0.0, 1.0):
        return BetaPrior(1.0, 1.0)
    spread = max(row["spread"] - row["noise"], 1e-6)
    strength = min(max(row["mean"] * (1 - row["mean"]) / spread - 1, 2.0), 1e4)
    return BetaPrior(row["mean"] * strength, (1 - row["mean"]) * strength)


def bad_hosts(rules: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Hosts (host, n, failed, rate) to reject. ``rules`` needs host and base_failed only."""
    hosts = rules.filter("host is not null").groupBy("host")
    hosts = through_table(
        hosts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts"
    )
    prior = fit_prior(hosts)
    judged = hosts.withColumn("rate", prior.rate(F.col("failed"), F.col("n"))).filter(F.col("rate") > limit)
    return through_table(judged, "bad-hosts")


def judged(rules: DataFrame, rejected: DataFrame) -> DataFrame:
    """``rules`` with ``kept``; the few rejected hosts are broadcast only if Spark finds their table small."""
    marks = rejected.select("host", F.lit(True).alias("host_rejected"))
    kept = ~F.col("base_failed") & F.col("host_rejected").isNull()
    return rules.join(marks, "host", "left").withColumn("kept", kept).drop("host_rejected")


def good_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that pass their own rules and their host's verdict, with their columns."""
    rules = document_rules(docs, F.col(text_col), F.col(host_col))
    rejected = bad_hosts(rules.select("host", "base_failed"))
    return judged(rules, rejected).filter("kept").select("doc.*")


def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = document_rules(docs, F.col("text"), F.col("source"))
    rules = through_table(rules.select("doc.doc_id", "host", *MEASURES, "base_failed"), "rules")
    return judged(rules, bad_hosts(rules)).select("doc_id", *MEASURES, "base_failed", "kept")


OP4_SQL = r"""
with d as (
  select row_number() over () rid, doc_id, source, coalesce(text, '') t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) lines
  from documents),
win as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g
  from (select rid, w, unnest(range(1, greatest(len(w) - 1, 1))) i from d)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) c from win) where c > 1),
cov as (select rid, count(distinct p) n from (select rid, unnest([i, i + 1, i + 2]) p from rep) group by rid),
f as (
  select d.rid, doc_id, source, len(w)::bigint n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint n_dup_lines,
    coalesce(n, 0)::bigint n_repeat_words
  from d left join cov using (rid)),
r as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from f),
h as (select source, count(*) n, sum(base_failed::int) b from r where source is not null group by 1),
m as (select avg(b / n) mu, greatest(var_pop(b / n) - avg((b / n) * (1 - b / n) / n), 1e-6) v from h),
s as (select mu, least(greatest(mu * (1 - mu) / v - 1, 2.0), 1e4) k from m),
bad as (
  select source from h, s
  where case when mu = 0 or mu = 1 then (b + 1) / (n + 2) else (b + mu * k) / (n + k) end > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(source not in (select source from bad), true) kept
from r
"""
