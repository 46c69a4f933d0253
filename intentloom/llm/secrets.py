"""Secret scans: fixed patterns, and random-looking strings told apart by two character Markov models.

The patterns give labelled strings: their matches are random, the other identifiers of the same rows are
ordinary. First-order models of both, over character classes, are fitted on a bounded sample of rows
(``TRAIN_DOCS``, chosen by a hash of the id). A long token is cut at the patterns' spans, and each part
left that is still long is added as a secret when its mean log-likelihood ratio per step is above
``MIN_RATIO``. Everything is DataFrame functions: matches come from ``regexp_extract_all``, their places from the lengths of the
pieces that ``split`` leaves between them, and a score is one fold over a token's characters.

Spans count code points from 0, end exclusive. Defined results: a null or empty text has no spans;
repeated rows are scanned each on their own; without any labelled match the random model is uniform and
the ordinary one as fitted; with no rows at all nothing is added; the caller's columns travel in one
struct, so no name of theirs can clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read

#: The patterns and the least lengths of the scan.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 characters or more

KINDS = ("assign", "access", "hex", "random")
LONG = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LONG},}}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{6,}"
CLASSES = 54  # 26 small letters, 26 capitals, digits, the rest
TRAIN_DOCS = 20_000
MIN_RATIO = 0.25
SMOOTHING = 3.0  # counts that every step has from the start
MASK = "[SECRET]"


def char_class(code: int) -> int:
    c = chr(code)
    return code - 97 if "a" <= c <= "z" else 26 + code - 65 if "A" <= c <= "Z" else 52 if "0" <= c <= "9" else 53


def _numbers(values, kind: str) -> Column:
    """A constant array; written as text so that the plan holds one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _class_of(char: Column) -> Column:
    return F.get(_numbers([char_class(i) for i in range(128)], "int"), F.ascii(char))


@dataclass(frozen=True)
class MarkovRatio:
    """log P(next | this, random) - log P(next | this, ordinary) for each pair of character classes."""

    table: tuple[float, ...]

    def mean(self, token: Column) -> Column:
        """Mean ratio per step of a token of two or more characters."""
        start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
        ratios = _numbers(self.table, "double")

        def step(acc: Column, char: Column) -> Column:
            c = _class_of(char)
            more = F.when(acc["last"] < 0, 0.0).otherwise(F.get(ratios, acc["last"] * CLASSES + c))
            return F.struct(c.alias("last"), (acc["sum"] + more).alias("sum"))

        total = F.aggregate(F.split(token, ""), start, step, lambda acc: acc["sum"])
        return total / (F.length(token) - 1)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def drawn_rows(docs: DataFrame, text_col: str, id_col: str, rows: int) -> DataFrame:
    """(h, t): texts of about ``rows`` distinct rows at most, drawn by a hash of id and text.

    Neither missing nor repeated ids move its size, and a repeated row is drawn once.
    """
    marked = docs.select(F.xxhash64(id_col, text_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    n = marked.agg(F.approx_count_distinct("h", 0.01)).first()[0]
    cut = int(2**32 * min(1.0, rows / max(n, 1)))
    return marked.filter(F.pmod("h", F.lit(2**32)) < cut).groupBy("h").agg(F.first("t").alias("t"))


def fit_ratio(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rows: int = TRAIN_DOCS) -> MarkovRatio:
    """Both models, fitted on ``drawn_rows``; every step has ``SMOOTHING`` counts from the start."""
    sample = drawn_rows(docs, text_col, id_col, rows)
    plain = F.col("t")
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    labelled = sample.select(
        F.concat(
            *[F.coalesce(_matches(F.col("t"), p, g), F.array().cast("array<string>")) for p, g in ((ASSIGN, 1), (ACCESS, 0), (HEX, 0))]
        ).alias("random"),
        F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0)).alias("ordinary"),
    )
    tokens = labelled.select(F.explode("random").alias("token"), F.lit(1).alias("label")).unionAll(
        labelled.select(F.explode("ordinary").alias("token"), F.lit(0).alias("label"))
    )
    classes = tokens.select("label", F.transform(F.split("token", ""), _class_of).alias("c"))
    steps = classes.select("label", F.explode(F.expr("transform(slice(c, 2, size(c)), (b, i) -> get(c, i) * 54 + b)")).alias("step"))
    counts = [[SMOOTHING] * CLASSES**2, [SMOOTHING] * CLASSES**2]
    for r in steps.groupBy("label", "step").count().collect():  # two small tables of CLASSES ** 2 numbers at most
        counts[r["label"]][r["step"]] += r["count"]
    table = []
    for a in range(CLASSES):
        ordinary, random = (c[a * CLASSES : (a + 1) * CLASSES] for c in counts)
        so, sr = sum(ordinary), sum(random)
        table += [round(math.log(x / sr) - math.log(y / so), 9) for x, y in zip(random, ordinary)]
    return MarkovRatio(tuple(table))


def _places(found: str, pieces: str, kind: int, keep: str) -> Column:
    """Spans of the matches in ``found``; ``pieces`` is what lies between them, ``keep`` a condition on i."""
    spans = "cast(array() as array<struct<start: int, k: int, end: int>>)"
    return F.expr(
        f"""case when {found} is null then {spans} else aggregate(sequence(0, size({found}) - 1),
            named_struct('at', 0, 'out', {spans}),
            (acc, i) -> named_struct(
                'at', acc.at + length(get({pieces}, i)) + length(get({found}, i)),
                'out', if({keep}, array_append(acc.out, named_struct('start', acc.at + length(get({pieces}, i)),
                    'k', {kind}, 'end', acc.at + length(get({pieces}, i)) + length(get({found}, i)))), acc.out)),
            acc -> acc.out) end"""
    )


def _parts(found: str, places: str, base: str) -> Column:
    """struct(start, end, token) of what the spans of ``base`` (sorted) leave of each token, where it is long."""
    none = "cast(array() as array<struct<start: int, end: int, token: string>>)"

    def added(end: str) -> str:
        cut = f"substring(get({found}, i), acc.at - s.start + 1, {end} - acc.at)"
        return f"if({end} - acc.at >= {LONG}, array_append(acc.out, named_struct('start', acc.at, 'end', {end}, 'token', {cut})), acc.out)"

    return F.expr(
        f"""flatten(transform({places}, (s, i) -> aggregate(
            filter({base}, b -> b.start < s.end and s.start < b.end),
            named_struct('at', s.start, 'out', {none}),
            (acc, b) -> named_struct('at', greatest(acc.at, b.end), 'out', {added("b.start")}),
            acc -> {added("s.end")})))"""
    )


def scan(docs: DataFrame, ratio: MarkovRatio, text_col: str = "text") -> DataFrame:
    """``doc`` (the whole row), ``t`` (its text), and the sorted spans: ``base`` of the patterns, ``spans`` of all."""
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = F.col("t")

    def pieces(pattern: str) -> Column:
        return F.when(t.rlike(pattern), F.split(t, pattern, -1))

    rows = rows.select(
        "doc", "t",
        _matches(t, ASSIGN).alias("m0"), _matches(t, ASSIGN, 1).alias("v0"), pieces(ASSIGN).alias("p0"),
        _matches(t, ACCESS).alias("m1"), pieces(ACCESS).alias("p1"),
        _matches(t, HEX).alias("m2"), pieces(HEX).alias("p2"),
        _matches(t, TOKEN).alias("m3"), pieces(TOKEN).alias("p3"),
    )
    rows = rows.select(
        "doc", "t",
        F.array_sort(F.concat(
            _places("m0", "p0", 0, f"length(get(v0, i)) >= {ASSIGN_VALUE}"),
            _places("m1", "p1", 1, "true"),
            _places("m2", "p2", 2, "true"),
        )).alias("base"),
        _places("m3", "p3", 3, "true").alias("tokens"), "m3",
    )
    rows = rows.select("doc", "t", "base", _parts("m3", "tokens", "base").alias("parts"))
    random = F.filter("parts", lambda p: ratio.mean(p["token"]) > MIN_RATIO)
    added = F.transform(random, lambda p: F.struct(p["start"].alias("start"), F.lit(3).alias("k"), p["end"].alias("end")))
    return rows.select("doc", "t", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every run of overlapping spans replaced by one mask."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(before, F.lit(MASK))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def masked_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """All documents, secrets masked and lengths put right, with their columns; texts without secrets stay as they are."""
    rows = scan(docs, fit_ratio(docs, text_col, id_col), text_col)
    rows = rows.withColumn("clean", masked(F.col("t"), F.col("spans")))
    hit = F.size("spans") > 0
    new = {text_col: F.col("clean"), chars_col: F.length("clean").cast(dict(docs.dtypes).get(chars_col, "long"))}
    return rows.select(
        *[F.when(hit, new[c]).otherwise(F.col(f"doc.{c}")).alias(c) if c in new else F.col(f"doc.{c}") for c in docs.columns]
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scan(docs, fit_ratio(docs))
    counts = [F.expr(f"cast(size(filter(base, s -> s.k = {k})) as long)").alias(f"n_{KINDS[k]}") for k in range(3)]
    return rows.select(
        "doc.doc_id", *counts, F.sha2(span_list(F.col("base")), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )
