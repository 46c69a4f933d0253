"""Removal of long repeats by a suffix array over sampled suffixes.

Texts are UTF-8 bytes. A byte goes if a string of ``SPAN`` bytes that covers it starts anywhere else too.

1. Anchors. Every window of ``SPAN - GRAM + 1`` starts gives the starts of its least hash of ``GRAM``
   bytes, so equal strings of ``SPAN`` bytes have anchors at equal places: each repeat is seen from an
   anchor, and about one suffix in 140 is kept. An anchor has a context, the bytes that strings of
   ``SPAN`` bytes through its gram can reach.
2. Equal contexts are counted, not gathered: if one comes twice, all its strings are repeats. Only the
   distinct contexts of grams that come with several go on, one row each, however many copies there are.
3. A task sorts the contexts of a gram by what follows it: an enhanced suffix array with the common
   prefix lengths of neighbours. A stack scan closes its intervals one by one; in each, the members'
   left extensions are sorted, and where they differ (left diversity) each member's longest left match
   with another member and the interval's length give a maximal repeat. All occurrences of the interval
   take part, not just neighbours. The strings a member shares become covered starts.
4. A gram with more than ``MEMBERS`` distinct contexts is not scanned in one task. Its strings are
   split by start into ``PARTS``, whose strings share a longer core; rows are dealt by the core's hash and
   counted again. Splitting ends with single strings, where equal ones are equal contexts.

Results go back to the occurrences by joins on hashes (two of 64 bits), and covered starts are united per
document. Defined results: null and empty texts have no bytes; a null id is an id like others; rows that
repeat id and text are documents that repeat each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.blocks import whole_units
from intentloom.llm.common import discard, read, stored, union_all
from intentloom.llm.minhash import same_row
from intentloom.llm.shingles import mixed

SPAN = 400
GRAM = 128
MEMBERS = 128
REACH = SPAN - GRAM  # bytes that a string through a gram can start before it

PARTS = 3  # of a range of starts, where a group is too large for one task

_BYTE = np.random.default_rng(99).integers(1, 2**63, 256, dtype=np.uint64)
_LEVEL = np.random.default_rng(98).integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def gram_hashes(a: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ``GRAM`` (a power of two) bytes, by doubling."""
    h, width, k = _BYTE[a], 1, 0
    while width < GRAM:
        h = h[:-width] * _LEVEL[k] + h[width:]
        width, k = 2 * width, k + 1
    return mixed(h)


def anchors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text of bytes."""
    if len(a) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, window = gram_hashes(a), REACH + 1
    least, width = h, 1
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    # a start is an anchor if some window that holds it has it as its least
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    most, width = padded, 1
    while width < window:
        step = min(width, window - width)
        most = np.maximum(most[:-step], most[step:])
        width += step
    at = np.flatnonzero(most == h)
    return at, h[at]


def _hash2(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, row): ``row`` is 128 bits that rows of equal id and text share."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.withColumn("row", same_row("doc_id", "text"))


def occurrences(rows: DataFrame) -> DataFrame:
    """(row, gram, context, at, before, after) of every anchor: hashes, place, and bytes of context each way."""

    def found(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                at, h = anchors(np.frombuffer(raw, np.uint8))
                for p, g in zip(at.tolist(), h.view(np.int64).tolist()):
                    lo, hi = max(p - REACH, 0), min(p + SPAN, len(raw))
                    values = (row, g, _hash2(b"%d|" % (p - lo) + raw[lo:hi]), p, p - lo, hi - p)
                    for c, v in zip(out, values):
                        c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.binary())] + [pa.array(c, pa.int64()) for c in out[1:4]] + [pa.array(c, pa.int32()) for c in out[4:]],
                    ["row", "gram", "context", "at", "before", "after"],
                )

    return rows.select("row", "text").mapInArrow(found, "row binary, gram long, context long, at long, before int, after int")


PIECE = "key long, sub long, gram long, context long, a0 int, a1 int, o int, ctx binary"


def contexts(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """``PIECE`` rows of ``wanted`` (gram, context, row, at), with the bytes cut from the texts of ``rows``."""

    def cut(batches):
        for batch in batches:
            out = [[], [], [], []]
            for spots, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                for spot in spots:
                    p = spot["at"]
                    lo = max(p - REACH, 0)
                    for c, v in zip(out, (spot["gram"], spot["context"], p - lo, raw[lo : p + SPAN])):
                        c.append(v)
            n = len(out[0])
            if n:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                gram, context, o, ctx = (pa.array(c, k) for c, k in zip(out, kinds))
                ends = [pa.array(np.full(n, a, np.int32)) for a in (0, REACH)]
                names = ["key", "sub", "gram", "context", "a0", "a1", "o", "ctx"]
                yield pa.RecordBatch.from_arrays([gram, context, gram, context, *ends, o, ctx], names)

    spots = wanted.groupBy("row").agg(F.collect_list(F.struct("gram", "context", "at")).alias("spots"))
    texts = rows.groupBy("row").agg(F.first("text").alias("text"))  # of equal rows one moves per task
    return spots.join(texts, "row").select("spots", "text").mapInArrow(cut, PIECE)


def split(pieces: DataFrame) -> DataFrame:
    """Each piece's range of starts in ``PARTS``; a part is left out where the text has no such string."""

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(8)]
            for r in batch.to_pylist():
                size = -(-(r["a1"] - r["a0"] + 1) // PARTS)
                for a0 in range(r["a0"], r["a1"] + 1, size):
                    a1 = min(a0 + size - 1, r["a1"])
                    o, ctx = r["o"], r["ctx"]
                    if o < a0 or len(ctx) - o < SPAN - a1:
                        continue
                    lo = max(o - a1, 0)
                    part = ctx[lo : o - a0 + SPAN]
                    key = _hash2(b"%d|%d|" % (r["key"], a0) + ctx[o - a0 : o - a1 + SPAN])
                    values = (key, _hash2(b"%d|" % (o - lo) + part), r["gram"], r["context"], a0, a1, o - lo, part)
                    for c, v in zip(out, values):
                        c.append(v)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
            names = ["key", "sub", "gram", "context", "a0", "a1", "o", "ctx"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return pieces.mapInArrow(cut, PIECE)


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n  # x[:lo] equal, x[:hi] not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def repeat_intervals(lefts: list[bytes], rights: list[bytes]) -> dict[int, list[tuple[int, int]]]:
    """For each suffix the maximal repeats through its anchor of ``SPAN`` bytes or more: (left, right) lengths.

    ``rights`` are the suffixes, ``lefts`` what stands before them, backwards.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    best = dict.fromkeys(order, -1)
    found: dict[int, list[tuple[int, int]]] = {}
    stack: list[tuple[int, int]] = []  # open intervals: (length, first place)

    def close(length: int, first: int, last: int) -> None:
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        if lefts[members[0]] == lefts[members[-1]]:  # no left diversity: all extend alike
            shared = [len(lefts[members[0]])] * (len(members) - 1)
        else:
            shared = [common_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for k, i in enumerate(members):
            left = max(shared[max(k - 1, 0) : k + 1])
            if left > best[i]:
                best[i] = left
                if left + length >= SPAN:
                    found.setdefault(i, []).append((left, length))

    for place, length in enumerate([*lcp, 0], 1):
        first = place - 1
        while stack and stack[-1][0] > length:
            top, first = stack.pop()
            close(top, first, place - 1)
        if length and (not stack or stack[-1][0] < length):
            stack.append((length, first))
    return found


def scanned(pieces: DataFrame) -> DataFrame:
    """(key, sub, lo, hi): starts that each distinct piece shares with another one of its key."""

    def scan(batches):
        for table, number in whole_units(batches, 1):
            subs, offsets, raw = (table.column(c).to_pylist() for c in ("sub", "o", "ctx"))
            keys = table.column("key").to_pylist()
            out = [[], [], [], []]
            for lo, hi in zip(*(np.searchsorted(number, np.unique(number), s) for s in ("left", "right"))):
                lefts = [raw[i][: offsets[i]][::-1] for i in range(lo, hi)]
                rights = [raw[i][offsets[i] :] for i in range(lo, hi)]
                for i, spans in repeat_intervals(lefts, rights).items():
                    for left, right in spans:
                        for c, v in zip(out, (keys[lo], subs[lo + i], SPAN - right, left)):
                            c.append(v)
            if out[0]:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["key", "sub", "lo", "hi"])

    dealt = pieces.select("key", "sub", "o", "ctx").repartition("key").sortWithinPartitions("key", "sub")
    return dealt.mapInArrow(scan, "key long, sub long, lo int, hi int")


def shared_anchors(found: DataFrame) -> DataFrame:
    """The anchors whose gram comes twice or more; most grams come once and go no further."""
    several = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    out = stored(found.join(stored(several, "shared-grams"), "gram"), "shared-anchors")
    discard(found)
    return out


def covered_starts(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(gram, context, lo, hi): an anchor at ``at`` with this context has repeated strings from at - hi to at - lo."""
    spot = F.min(F.struct("row", "at")).alias("spot")
    kinds = found.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), spot, F.first("before").alias("before"), F.first("after").alias("after")
    )
    kinds = stored(kinds, "contexts")
    low = F.greatest(SPAN - F.col("after"), F.lit(0))
    copies = kinds.filter((F.col("n") > 1) & (low <= F.col("before")))
    parts = [stored(copies.select("gram", "context", low.alias("lo"), F.col("before").alias("hi")), "copied-starts")]
    several = stored(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "grams")
    wanted = kinds.join(several, "gram").select("gram", "context", "spot.row", "spot.at", "members")
    pieces = contexts(wanted.select("gram", "context", "row", "at"), rows).join(several.withColumnRenamed("gram", "key"), "key")
    pieces = stored(pieces, "pieces")
    whole = ["gram", "context", "lo", "hi"]
    discard(kinds)
    done = scanned(pieces.filter(F.col("members") <= MEMBERS))
    done = done.select(F.col("key").alias("gram"), F.col("sub").alias("context"), "lo", "hi")
    parts.append(stored(done, "scanned-starts"))
    crowded = pieces.filter(F.col("members") > MEMBERS)
    while not crowded.isEmpty():
        smaller = stored(split(crowded.drop("members")), "parts")
        discard(crowded)
        same = smaller.groupBy("key", "sub").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("gram", "context", "a0", "a1", "o", "ctx")]
        )
        same = stored(same, "distinct-parts")
        low = F.greatest(SPAN - (F.length("ctx") - F.col("o")), F.col("a0"))
        high = F.least(F.col("o"), F.col("a1"))
        shared = same.filter("n > 1").select("key", "sub", low.alias("lo"), high.alias("hi"))
        several = stored(same.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "cores")
        left = stored(same.drop("n").join(several, "key"), "pieces")
        shared = stored(shared.unionByName(scanned(left.filter(F.col("members") <= MEMBERS))), "shared")
        told = smaller.select("key", "sub", "gram", "context").join(shared, ["key", "sub"])
        parts.append(stored(told.select(*whole).distinct(), "part-starts"))
        discard(smaller, same)
        # of equal parts one goes on as a partner; all of them have their starts already
        crowded = left.filter(F.col("members") > MEMBERS)
    return stored(union_all(parts).filter("lo <= hi").distinct(), "starts")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans): the byte ranges of every document that repeats of ``SPAN`` bytes or more cover."""
    rows = documents(docs, id_col, text_col)
    found = shared_anchors(stored(occurrences(rows), "anchors"))
    starts = covered_starts(found, rows)
    hits = found.select("row", "gram", "context", "at").join(starts, ["gram", "context"])
    span = F.struct((F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + SPAN).alias("end"))
    spans = stored(hits.groupBy("row").agg(F.collect_set(span).alias("spans")), "spans")
    return rows.join(spans, "row", "left").select("doc_id", "text", F.sort_array("spans").alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of sorted ranges."""
    runs: list[tuple[int, int]] = []
    for s in spans or []:
        if runs and s["start"] <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], s["end"]))
        else:
            runs.append((s["start"], s["end"]))
    return runs


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(e for _, e in runs)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(raw)]))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every document; ``kept`` are its remaining bytes."""

    def cut(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, runs = text.encode(), merged(spans)
                kept = kept_bytes(raw, runs)
                for c, v in zip(out, (len(raw), len(raw) - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return repeats(docs, id_col, text_col).mapInArrow(cut, schema)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents")).drop("kept")
