"""Best-fit packing of tokenised documents into sequences of fixed length.

Only the histogram of piece lengths decides where lengths go, so the plan is made on the driver from
``capacity`` numbers at most, whatever the number of documents:

1. Lengths are rounded to ``BINS`` classes. Patterns of one to three documents whose class sizes fill a
   sequence exactly are enumerated, and their repeat counts are fitted to the histogram by non-negative
   least squares, rounded, and cut to what is there. A ``COMMIT`` share of each opens sequences with
   all but the pattern's shortest document: what is free of rounding errors then is that document's place.
2. The residual, longest first, goes by best fit into the tightest open sequence: those of the patterns,
   then new ones. Sequences that look alike are kept as one group with a count, and a run of equal
   lengths is placed group by group, so the work follows the number of distinct lengths.

The plan says, for ranks lo..hi of the pieces of one length, which sequence and offset they get. Pieces
are ranked within their length by counted buckets and joined to the plan on (length, block of ranks).

Defined results: a null or empty text is its end id alone; repeated rows are packed each on their own;
an empty table gives no rows; the caller's other columns are not carried.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.common import bucketed_rank, read
from intentloom.llm.encode import encoder
from intentloom.session import through_table

CAPACITY = 4096
BINS = 64
COMMIT = 0.8
BLOCK = 32  # ranks of one length that share a join key
BUCKET_ROWS = 1 << 17
END_ID = 1


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 with least |a x - b|: active sets, letting in the steepest column and out what turns negative."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        inside[best] = True
        while True:
            z = np.zeros_like(x)
            z[inside] = np.linalg.lstsq(a[:, inside], b, rcond=None)[0]
            low = inside & (z <= 1e-12)
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - z[low], 1e-30)).min()
            x = x + step * (z - x)
            inside &= x > 1e-12
            x[~inside] = 0
        x = z
    return x


def length_patterns(bins: int = BINS) -> list[tuple[int, ...]]:
    """Class sizes 1..bins of one, two or three documents that fill a sequence exactly."""
    pairs = [(a, bins - a) for a in range((bins + 1) // 2, bins)]
    triples = [(a, b, bins - a - b) for a in range(1, bins) for b in range(1, a + 1) if 1 <= bins - a - b <= b]
    return [(bins,), *pairs, *triples]


@dataclass
class Group:
    """``count`` sequences from number ``first`` on that hold the same lengths. An entry (length, lo, times)
    says that sequence j of the group holds the pieces of that length with ranks lo + j * times on."""

    first: int
    count: int
    room: int
    entries: list[tuple[int, int, int]]

    def split(self, n: int) -> Group:
        """Cuts the first ``n`` sequences off and returns them."""
        head = Group(self.first, n, self.room, list(self.entries))
        self.first, self.count = self.first + n, self.count - n
        self.entries = [(length, lo + n * times, times) for length, lo, times in self.entries]
        return head


class Rooms:
    """Open groups by room; the tightest that holds a length is found in the sorted list of rooms."""

    def __init__(self) -> None:
        self.by, self.order = {}, []

    def add(self, group: Group) -> None:
        if group.room not in self.by:
            self.by[group.room] = []
            insort(self.order, group.room)
        self.by[group.room].append(group)

    def take(self, length: int) -> Group | None:
        at = bisect_left(self.order, length)
        if at == len(self.order):
            return None
        room = self.order[at]
        group = self.by[room].pop()
        if not self.by[room]:
            del self.by[room], self.order[at]
        return group


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS) -> tuple[list[tuple], int]:
    """Rows (length, lo, n, times, first, offset) and the number of sequences.

    The pieces of ``length`` with ranks lo .. lo + n - 1 lie ``times`` in a sequence from number ``first``
    on, each sequence's from ``offset`` on.
    """
    width = -(-capacity // bins)
    used = dict.fromkeys(histogram, 0)
    by_class: dict[int, list[int]] = {}
    for length in sorted(histogram, reverse=True):
        by_class.setdefault((length + width // 2) // width, []).append(length)
    patterns = [p for p in length_patterns(bins) if all(c in by_class for c in p)]
    rooms, sequences = Rooms(), 0
    if patterns:
        classes = sorted(by_class)
        a = np.array([[p.count(c) for p in patterns] for c in classes], float)
        b = np.array([sum(histogram[x] for x in by_class[c]) for c in classes], float)
        weight = np.array(classes, float)[:, None]
        fitted = nonnegative_least_squares(a * weight, b * weight[:, 0])
        left = dict(zip(classes, b.astype(int)))
        for i in np.argsort(-fitted, kind="stable"):
            p = patterns[i]
            repeats = min([round(COMMIT * float(fitted[i])), *(left[c] // p.count(c) for c in p)])
            if repeats <= 0:
                continue
            slots = []
            for c in p[:-1] or p:
                left[c] -= repeats
                slots.append(_runs(by_class[c], histogram, used, repeats))
            for count, entries in _aligned(slots):
                room = capacity - sum(e[0] for e in entries)
                rooms.add(Group(sequences, count, room, [(length, lo, 1) for length, lo in entries]))
                sequences += count
    done = []
    for length in sorted(histogram, reverse=True):
        lo, n = used[length], histogram[length] - used[length]
        while n:
            group = rooms.take(length)
            if group is None:
                fit = capacity // length
                group = Group(sequences, max(n // fit, 1), capacity, [])
                sequences += group.count
            times = min(group.room // length, n)
            count = min(group.count, n // times)
            if count < group.count:
                rest, group = group, group.split(count)
                rooms.add(rest)
            group.entries.append((length, lo, times))
            group.room -= length * times
            lo, n = lo + count * times, n - count * times
            rooms.add(group)
    for group in itertools.chain.from_iterable(rooms.by.values()):
        offset = 0
        for length, lo, times in group.entries:
            done.append((length, lo, group.count * times, times, group.first, offset))
            offset += length * times
    return done, sequences


def _runs(lengths: list[int], histogram: dict[int, int], used: dict[int, int], n: int) -> list[tuple[int, int, int]]:
    """The next ``n`` pieces of a class, longest first, as (length, lo, count); marks them used."""
    runs = []
    while n:
        while used[lengths[0]] == histogram[lengths[0]]:
            lengths.pop(0)
        length = lengths[0]
        take = min(n, histogram[length] - used[length])
        runs.append((length, used[length], take))
        used[length] += take
        n -= take
    return runs


def _aligned(slots: list[list[tuple[int, int, int]]]):
    """Cuts the slots' runs at each other's ends: (count, [(length, lo) of each slot])."""
    runs = [list(s) for s in slots]
    while runs[0]:
        count = min(r[0][2] for r in runs)
        yield count, [(r[0][0], r[0][1]) for r in runs]
        for r in runs:
            length, lo, n = r[0]
            r[:1] = [(length, lo + count, n - count)] if n > count else []


def pieces(
    docs: DataFrame, tokenizer: str, spaced: bool, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids with the end id, cut at ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def cut(batches):
        encode = encoder(tokenizer, spaced)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode.ids(batch.column(1))):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    row = (doc, at // (4 * capacity), at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if keep_ids else row)
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * keep_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a stored table of pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # ``capacity`` rows at most
    rows, _ = plan(histogram, capacity)
    placed = pd.DataFrame(rows, columns=["length", "lo", "n", "times", "first", "place"], dtype="int64")
    placed = spark.createDataFrame(placed, "length long, lo long, n long, times long, first long, place long")
    blocks = F.sequence(F.floor(F.col("lo") / BLOCK), F.floor((F.col("lo") + F.col("n") - 1) / BLOCK))
    placed = placed.withColumn("block", F.explode(blocks))
    buckets = 16 * (1 + max(histogram.values(), default=0) // (16 * BUCKET_ROWS))
    ranked = bucketed_rank(
        cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))), ["length"], "bucket",
        [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "rank",
    )
    ranked = ranked.withColumn("rank", F.col("rank") - 1).withColumn("block", F.floor(F.col("rank") / BLOCK))
    within = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + F.col("n"))
    nth = F.col("rank") - F.col("lo")
    return (
        ranked.join(placed, ["length", "block"])
        .filter(within)
        .withColumn("sequence_id", F.col("first") + F.floor(nth / F.col("times")))
        .withColumn("offset", F.col("place") + nth % F.col("times") * F.col("length"))
        .select(*cut.columns, "sequence_id", "offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids themselves; ``packed`` needs ids. A sequence holds ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def packed_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(through_table(pieces(docs, public_tokenizers.path("word_bpe_49k.json"), False), "pieces"))


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))
