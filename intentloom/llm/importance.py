"""Importance resampling towards a target text: hashed word features, log-ratio weights, a noisy top share.

Every text is read once: its words' bucket numbers are stored as an array of two bytes a word. Corpus and
target counts per bucket give one gain per bucket, an array of ``buckets`` numbers that goes to the tasks; a
weight is the sum of the gains at a text's array. Adding Gumbel noise from a hash of seed and id makes the
highest scores a draw without replacement.

The cutoff is found without sorting the scores. A quantile sketch gives a bracket around it; exact counts of
the scores above and inside tell whether the cutoff lies there, else the bracket is widened and counted
again. Only the bracket is sorted. Sorting goes by range partitions of (score, id, ...), so that equal
scores or ids are dealt out too, and a position is its partition's base plus the place inside.

Defined results: a null text has no words; a null id hashes like an empty one and comes last among equal
scores; rows equal in score and id go by weight and word count, and what is equal in all is interchangeable;
empty tables give no rows, an empty target only the smoothing; the caller's other columns are not carried.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm.common import read
from intentloom.llm.encode import pieces, text_bytes
from intentloom.session import through_table

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
SHARE = 10  # percent drawn
SKETCH = 10_000
BRACKET = 0.002  # half of the share of rows that a first bracket spans
SORTED_ROWS = 250_000  # rows that one task sorts
LONG_WORD = 32  # bytes; hashes of longer words are taken one by one

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The crc32 of every data[start:end], a byte of all words at a time, long words by zlib."""
    size = end - start
    order = np.argsort(-np.minimum(size, LONG_WORD + 1).astype(np.int8), kind="stable")
    longer = int((size > LONG_WORD).sum())
    at, size = start[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(LONG_WORD):
        n = int(np.searchsorted(-size, -k, "left"))  # words of more than k bytes come first
        if n <= longer:
            break
        part = crc[longer:n]
        crc[longer:n] = table[(part ^ data[at[longer:n] + k]) & 0xFF] ^ (part >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    raw = memoryview(data)
    for k in range(longer):
        crc[k] = zlib.crc32(raw[at[k] : at[k] + size[k]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and where each word starts and ends; words do not cross the ends of texts."""
    data = np.where(data - np.uint8(65) < 26, data + np.uint8(32), data)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = (data >= 128) | (data - np.uint8(97) < 26) | (data - np.uint8(48) < 10)
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    head = offsets[:-1][offsets[:-1] < len(data)]
    first[head] = inside[head]
    last = inside[:-1] & ~inside[1:]
    tail = offsets[1:][offsets[1:] > 0] - 1
    last[tail] = inside[tail]
    return data, np.flatnonzero(first), np.flatnonzero(last) + 1


def word_buckets(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, words): the bucket of every word of a text in order, as unsigned numbers of two bytes."""

    def rows(batches):
        table = _crc_table()
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in pieces(*text_bytes(batch.column(1))):
                data, start, end = word_places(data, offsets)
                words = (word_hashes(data, start, end, table) % np.uint32(buckets)).astype("<u2")
                at = 2 * np.searchsorted(start, offsets)
                arrays = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(words)])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), arrays.cast(pa.binary())], ["doc_id", "words"])

    if buckets > 1 << 16:
        raise ValueError("buckets are stored in two bytes")
    doc_id = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(rows, "doc_id long, words binary")


def _arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return np.frombuffer(data.tobytes(), "<u2"), offsets // 2


def bucket_counts(words: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many words fall in each bucket: ``buckets`` numbers per task, then ``buckets`` in all."""

    def rows(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_arrays(batch.column(0))[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})

    counted = words.select("words").mapInArrow(rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over its share in the source."""
    n, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (all_s + n)) / ((source + 1.0) * (all_t + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(words: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight) of stored word buckets."""

    def rows(batches):
        for batch in batches:
            values, offsets = _arrays(batch.column(1))
            upto = np.concatenate([[0], np.cumsum(gain[values])])
            weight = upto[offsets[1:]] - upto[offsets[:-1]]
            arrays = [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_features", "weight"])

    return words.mapInArrow(rows, "doc_id long, n_features long, weight long")


def noisy(weight: Column, doc_id: Column, seed: int = SEED) -> Column:
    """The weight plus a Gumbel number drawn by a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return (weight + F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))).cast("long")


def positions(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """``rows`` with ``position`` from 1 in ``order``; about ``SORTED_ROWS`` of the ``n`` rows are sorted in a task."""
    sorted_ = rows.repartitionByRange(max(1, math.ceil(n / SORTED_ROWS)), *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = through_table(sorted_.withColumn("place", F.monotonically_increasing_id()), "positions")
    part, inside = F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    bases = placed.groupBy(part).agg(F.count(F.lit(1)).alias("here"))
    bases = bases.select("part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"))
    placed = placed.select(*rows.columns, part, inside.alias("inside"))
    return placed.join(F.broadcast(bases), "part").select(*rows.columns, (F.col("base") + F.col("inside") + 1).alias("position"))


def bracket(scores: DataFrame, n: int, take: int) -> tuple[int, int, int, int]:
    """(low, high, above, inside): ``above`` scores exceed ``high``, ``inside`` lie in low..high, and the
    ``take``-th highest is one of those."""
    share, width = 1 - take / n, BRACKET
    while True:
        probs = [max(0.0, share - width), min(1.0, share + width)]
        low, high = scores.agg(F.percentile_approx("score", probs, SKETCH)).first()[0]
        low, high = (low if probs[0] > 0 else -(1 << 63)), (high if probs[1] < 1 else (1 << 63) - 1)
        counts = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if counts[0] < take <= counts[0] + counts[1]:
            return low, high, *counts
        width *= 4


def importance_resample(
    docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    ``share`` percent of the texts of ``min_words`` words are drawn; ``rank`` is null for all others.
    """
    words = through_table(word_buckets(docs, id_col, text_col, buckets), "word-buckets")
    gain = gains(bucket_counts(words, buckets), bucket_counts(word_buckets(target, None, target_text_col, buckets), buckets))
    scored = weighted(words, gain)
    scored = through_table(scored.withColumn("score", noisy(F.col("weight"), F.col("doc_id"), seed)), "scores")

    known = scored.filter(F.col("n_features") >= min_words)
    n = known.count()
    take = n * share // 100
    none = F.lit(None).cast("long").alias("rank")
    if not take:
        return scored.select("*", none)
    low, high, above, inside = bracket(known, n, take)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    score = F.col("score")
    top = positions(known.filter(score > high), above, order).withColumnRenamed("position", "rank")
    near = positions(known.filter(score.between(low, high)), inside, order)
    cut = F.when(F.col("position") <= take - above, F.col("position") + above)
    near = near.select(*scored.columns, cut.cast("long").alias("rank"))
    rest = scored.filter((F.col("n_features") < min_words) | (score < low)).select("*", none)
    return top.unionByName(near).unionByName(rest)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: crc32 is spelled out over the bytes of each distinct word.
OP13_SQL = r"""
with t as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) crc),
w as (
  select row_number() over () rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') words
  from documents),
b as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) word
  from benchmark),
f as (select rid, unnest(words) word from w),
v as (
  select word, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(strlen(word)), lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) % 10000 bucket
  from (select word from f union select word from b), t),
s as (select bucket, count(*) s from f join v using (word) group by 1),
g as (select bucket, count(*) t from b join v using (word) group by 1),
k as (select (select count(*) from f) s_all, (select count(*) from b) t_all),
gain as (
  select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000))))::bigint gain
  from s left join g using (bucket), k),
sums as (select rid, sum(gain)::bigint weight from f join v using (word) join gain using (bucket) group by 1),
scored as (
  select w.rid, doc_id, len(words)::bigint n_features, coalesce(weight, 0)::bigint weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double))))::bigint score
  from w left join sums using (rid)),
r as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last, weight, n_features) place,
    count(*) over (partition by n_features >= 20) n
  from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= n * 10 // 100 then place end::bigint rank
from r
"""
