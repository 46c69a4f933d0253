"""Fill-in-the-middle transformation, cut at random units of the text with a wavelet matrix.

A unit is a run of ASCII letters or any other single character. The UTF-8 bytes of a batch fall into four
classes (``OTHER``, ``FIRST`` letter of a run, ``INNER`` letter, ``TAIL`` byte of a character), stored as a
wavelet matrix: one bit vector per bit of the class, the second in the order the first sorts the bytes,
each with counted blocks of 64 bits. A rank costs one look at a block per level. Units that start before
a place are rank(OTHER) + rank(FIRST), characters before it are all bytes less rank(TAIL). The two cuts of
every document are found together, by bisection on the unit ranks.

The random numbers are hashes of seed and id, so reruns agree and a retried task makes the same rows.

Defined results: a null text is empty; an empty text, or one that holds a marker, stays plain, as does
the share ``plain``; a null id hashes like an empty one; repeated rows are transformed alike; an empty table
gives no rows; the caller's other columns are not carried. A batch is taken ``TAKEN`` bytes at a time, a
longer text by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import read
from intentloom.llm.encode import pieces, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OTHER, FIRST, INNER, TAIL = range(4)
BITS = 2


class WaveletMatrix:
    """Ranks of small classes over a sequence: ``rank(c, i)`` counts ``c`` among the first ``i`` places."""

    def __init__(self, classes: np.ndarray, bits: int = BITS) -> None:
        self.levels, self.bits = [], bits
        for level in range(bits - 1, -1, -1):
            ones = (classes >> level & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(packed) // 8 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(ones) - int(before[-1])
            self.levels.append((words, before, zeros))
            if level:
                classes = np.concatenate([classes[~ones], classes[ones]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        words, before, _ = self.levels[level]
        block = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(words[block] & below)

    def rank(self, c: int, i: np.ndarray) -> np.ndarray:
        lo = np.zeros_like(i)
        for level in range(self.bits):
            below, ones = self._ones(level, lo), self._ones(level, i)
            if c >> (self.bits - 1 - level) & 1:
                zeros = self.levels[level][2]
                lo, i = zeros + below, zeros + ones
            else:
                lo, i = lo - below, i - ones
        return i - lo


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte; a letter run does not cross the ``starts`` of texts."""
    letter = (data | 0x20) - np.uint8(97) < 26
    inner = np.zeros(len(data), bool)
    inner[1:] = letter[1:] & letter[:-1]
    inner[starts[starts < len(data)]] = False
    out = np.where(letter, np.uint8(FIRST), np.uint8(OTHER))
    out[inner] = INNER
    out[data & 0xC0 == 0x80] = TAIL
    return out


class Units:
    """The units of several texts laid end to end: counts, cuts and character positions."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.lo, self.hi = offsets[:-1], offsets[1:]
        self.matrix = WaveletMatrix(byte_classes(data, self.lo))
        self.n = self.before(self.hi) - self.before(self.lo)

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that start before each place."""
        return self.matrix.rank(OTHER, at) + self.matrix.rank(FIRST, at)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The place in each text after its first ``units`` units: the last with no more units before it."""
        wanted = self.before(self.lo) + units
        lo, hi = self.lo.copy(), self.hi.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            few = self.before(mid) <= wanted
            lo, hi = np.where(few, mid, lo), np.where(few, hi, mid - 1)
        return lo

    def characters(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (end - start) - (self.matrix.rank(TAIL, end) - self.matrix.rank(TAIL, start))


def transformed(data: bytes, units: Units, first: np.ndarray, second: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> Iterator[tuple]:
    """(form, prefix characters, middle characters, output) of each text."""
    one, two = first % (units.n + 1), second % (units.n + 1)
    a, b = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
    before, middle = units.characters(units.lo, a), units.characters(a, b)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for k, (lo, i, j, hi) in enumerate(zip(units.lo.tolist(), a.tolist(), b.tolist(), units.hi.tolist())):
        text = data[lo:hi]
        if not text or plain[k] or p in text or s in text or m in text:
            yield "plain", None, None, text
            continue
        parts = (s, text[j - lo :], p, text[: i - lo], m) if spm[k] else (p, text[: i - lo], s, text[j - lo :], m)
        yield "spm" if spm[k] else "psm", int(before[k]), int(middle[k]), b"".join(parts) + text[i - lo : j - lo]


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``plain`` percent stay as they are; of the others ``spm`` percent put the suffix first.
    """

    def rows(batches):
        for batch in batches:
            ids, numbers = batch.column(0), [np.asarray(batch.column(k)) for k in range(2, 6)]
            for lo, hi, data, offsets in pieces(*text_bytes(batch.column(1))):
                units = Units(data, offsets)
                h1, h2, h3, h4 = (x[lo:hi] for x in numbers)
                made = transformed(data.tobytes(), units, h1, h2, h3 % 100 >= 100 - plain, h4 % 100 < spm)
                form, before, middle, output = zip(*made)
                arrays = [
                    ids.slice(lo, hi - lo),
                    pa.array(units.n, pa.int64()),
                    pa.array(form),
                    pa.array(before, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    doc_id = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    picked = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(hashes, 1)])
    return picked.mapInArrow(rows, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made of. No text with a cut holds a marker, so the first of each kind is ours."""

    def after(c: Column, marker: str) -> Column:
        return F.substring(c, F.instr(c, marker) + len(marker), F.length(c))

    def upto(c: Column, marker: str) -> Column:
        return F.substring_index(c, marker, 1)

    body = F.substring(output, 4, F.length(output))
    psm = F.concat(upto(body, SUFFIX), after(body, MIDDLE), upto(after(body, SUFFIX), MIDDLE))
    spm = F.concat(upto(after(body, PREFIX), MIDDLE), after(body, MIDDLE), upto(body, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read(spark, sf_dir, "documents"))
    back = restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


OP12_SQL = """
with d as (
  select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(doc_id::varchar, '')) h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') u
  from documents),
r as (
  select *, len(u)::bigint n, ('0x' || h[1:8])::bigint % (len(u) + 1) one, ('0x' || h[9:16])::bigint % (len(u) + 1) two,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 90
      then 'plain' when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end form
  from d),
c as (
  select *, array_to_string(u[1:least(one, two)], '') p, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') m,
    array_to_string(u[greatest(one, two) + 1:], '') s
  from r)
select doc_id, n, form, case when form <> 'plain' then length(p) end::bigint prefix_chars,
  case when form <> 'plain' then length(m) end::bigint middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256
from c
"""
