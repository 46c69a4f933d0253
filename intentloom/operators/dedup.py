"""Expiring de-duplication of repeated requests: which requests a result cache would have served.

Per key, the first request is computed and cached; requests within ``ttl`` of that computation
are served from it; the first request after that is computed again. The period does not slide.
Each computation thus depends on the one before it.

*Ordinary keys* are sorted together, many keys to a partition, and read as a stream of Arrow batches. Inside
a batch every request has a successor, the request computed next if this one is; the computed ones are
those reached from the first of each key, ranked by doubling the successor arrays. The open period of the last
key is carried into the next batch, so a task holds one batch, and time grows with the rows alone.

*Hot keys* may hold a third of all rows. Their time line is cut into chunks:
each chunk is reduced to a table "earliest allowed time in -> earliest allowed time out", tables
are composed level by level up to the whole time line, and the true entry times are handed back
down. A chunk holds at most one row per millisecond. Their requests then meet the computations in sorted
slots of equal row counts, however many fall in one period or one millisecond: a slot takes the last
computation before each request from its own rows, or from the slots before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.session import through_table
from intentloom.sources.tables import MICROS, micros

TTL_SECONDS = 3600
HOT_ROWS = 200_000
SLOT_ROWS = 500_000  # entries of hot keys that one task sorts
FAN_IN = 4
CHUNK_PERIODS = 4  # least length of a chunk, in periods of the ttl
NEVER, ALWAYS = np.iinfo(np.int64).max, np.iinfo(np.int64).min


# --- one chunk of one key, as sorted arrays (milliseconds, overwrite flag) -------------------------


def _first_after(t: np.ndarray, forced: np.ndarray, ttl: int) -> np.ndarray:
    """Per instant, the position of the next computation if this instant was computed."""
    n = len(t)
    nxt = np.searchsorted(t, t + ttl, side="left")
    marks = np.where(forced, np.arange(n), n)
    upcoming = np.append(np.minimum.accumulate(marks[::-1])[::-1], n)
    return np.minimum(nxt, upcoming[1 : n + 1])


def _entry(t: np.ndarray, forced: np.ndarray, allowed: int) -> int:
    first_forced = int(np.argmax(forced)) if forced.any() else len(t)
    return min(int(np.searchsorted(t, allowed, side="left")), first_forced)


def _chunk_table(t: np.ndarray, forced: np.ndarray, ttl: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunk leads: instants that may be computed first, and the allowed time after the chunk.

    ``reach`` is the latest allowed time with which the chunk can be entered.
    """
    n = len(t)
    nxt = _first_after(t, forced, ttl)
    last = np.where(nxt < n, nxt, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    out = t[last] + ttl
    stop = min(_entry(t, forced, reach), n - 1) + 1
    start = t[:stop].copy()
    if forced[stop - 1]:
        start[-1] = NEVER  # an overwrite is computed whatever the allowed time
    return start, out[:stop]


def _apply(table: tuple[np.ndarray, np.ndarray], allowed: np.ndarray) -> np.ndarray:
    start, out = table
    at = np.searchsorted(start, allowed, side="left")
    return np.where(at < len(start), out[np.minimum(at, len(out) - 1)], allowed)


def _compose(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    start, out = tables[0]
    if len(tables) > 1 and start[-1] != NEVER:
        # entered after its last instant, the first chunk passes the time on to the second
        second_start, second_out = tables[1]
        out = np.append(_apply(tables[1], out), second_out[0])
        start = np.append(start, second_start[0])
        tables = tables[1:]
    for table in tables[1:]:
        out = _apply(table, out)
    return start, out


def _split(pdf: pd.DataFrame) -> list[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    pdf = pdf.sort_values(["chunk", "start"], kind="stable")
    return [(int(c), (g["start"].to_numpy(), g["out"].to_numpy())) for c, g in pdf.groupby("chunk", sort=True)]


def _hot_misses(instants: DataFrame, most_chunks: int, ttl: int) -> DataFrame:
    """(k, t) of the computed instants of hot keys.

    ``instants`` is a written table of k, chunk, reach (the latest allowed time with which the chunk
    can be entered), t, forced; chunks of a key have one length and count from 0.
    """

    def first_level(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        first = pdf.iloc[0]
        start, out = _chunk_table(pdf["t"].to_numpy(), pdf["forced"].to_numpy(dtype=bool), ttl, int(first["reach"]))
        return pd.DataFrame({"k": first["k"], "chunk": first["chunk"], "start": start, "out": out})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = _split(pdf)
        start, out = _compose([table for _, table in parts])
        return pd.DataFrame({"k": pdf["k"].iloc[0], "chunk": parts[0][0] // FAN_IN, "start": start, "out": out})

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        allowed, rows = np.array([pdf["allowed"].iloc[0]]), []
        for chunk, table in _split(pdf):
            rows.append((pdf["k"].iloc[0], chunk, int(allowed[0])))
            allowed = _apply(table, allowed)
        return pd.DataFrame(rows, columns=["k", "chunk", "allowed"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        t, forced = pdf["t"].to_numpy(), pdf["forced"].to_numpy(dtype=bool)
        nxt = _first_after(t, forced, ttl)
        allowed, found = int(pdf["allowed"].iloc[0]), []
        at = _entry(t, forced, allowed)
        while at < len(t):
            if t[at] >= allowed:
                found.append(t[at])
            allowed = t[at] + ttl
            at = nxt[at]
        return pd.DataFrame({"k": pdf["k"].iloc[0], "t": np.array(found, dtype="int64")})

    table_schema, parent = "k long, chunk long, start long, out long", F.floor(F.col("chunk") / FAN_IN)
    levels = [through_table(instants.groupBy("k", "chunk").applyInPandas(first_level, table_schema), "ttl")]
    while most_chunks > 1:
        most_chunks = -(-most_chunks // FAN_IN)
        levels.append(through_table(levels[-1].groupBy("k", parent).applyInPandas(merge, table_schema), "ttl"))
    entries = levels[-1].select("k", "chunk").distinct().withColumn("allowed", F.lit(int(ALWAYS)))
    for level in reversed(levels[:-1]):
        above = entries.withColumnRenamed("chunk", "up")
        tables = level.withColumn("up", parent).join(above, ["k", "up"])
        entries = tables.groupBy("k", "up").applyInPandas(hand_down, "k long, chunk long, allowed long")
    return instants.join(entries, ["k", "chunk"]).groupBy("k", "chunk").applyInPandas(walk, "k long, t long")


# --- ordinary keys: a stream of batches sorted by key and time ---------------------------------------


def computed_in(run: np.ndarray, t: np.ndarray, forced: np.ndarray, allowed: int, ttl: int) -> np.ndarray:
    """Which requests are computed, several keys one after the other.

    ``run`` numbers the keys from 0, ``t`` rises within a key; key 0 was last computed such that it may be
    again from ``allowed`` on.
    """
    n = len(t)
    span = int(t.max()) - int(t.min()) + ttl + 1
    if n > 1 and (int(run[-1]) + 1) * span >= 1 << 62:  # places would not fit a number: take the halves
        first = computed_in(run[: n // 2], t[: n // 2], forced[: n // 2], allowed, ttl)
        rest, done = run[n // 2 :], np.flatnonzero(first)
        if run[n // 2 - 1] != rest[0]:
            allowed = ALWAYS
        elif len(done) and run[done[-1]] == rest[0]:
            allowed = int(t[done[-1]]) + ttl
        return np.concatenate([first, computed_in(rest - rest[0], t[n // 2 :], forced[n // 2 :], allowed, ttl)])
    place = run * span + (t - t.min())  # rises over all keys
    end = np.searchsorted(run, run, side="right")
    upcoming = np.minimum.accumulate(np.where(forced, np.arange(n), n)[::-1])[::-1]
    following = np.minimum(np.searchsorted(place, place + ttl, side="left"), np.append(upcoming, n)[1:])
    following = np.append(np.where(following < end, following, n), n)  # n: no more of this key
    heads = np.flatnonzero(np.diff(run, prepend=-1))
    able = forced[: end[0]] | (t[: end[0]] >= allowed)
    heads[0] = int(np.argmax(able)) if able.any() else n
    done = np.zeros(n + 1, bool)
    done[heads] = True
    while True:
        reached = following[np.flatnonzero(done)]
        if done[reached].all():
            return done[:n]
        done[reached] = True
        following = following[following]


class _Served:
    """Requests of sorted batches with the computation each is served from; the last one is carried on."""

    def __init__(self, ttl: int) -> None:
        self.ttl = ttl
        self.key, self.allowed = None, int(ALWAYS)
        self.last: pa.RecordBatch | None = None  # the row that was computed last

    def batch(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """``rows`` has key, t, forced, id, payload; returns key, id, hit, computed_id, payload."""
        keys = rows.column(0)
        change = np.ones(len(keys), bool)
        if len(keys) > 1:
            change[1:] = ~np.asarray(pa.compute.equal(keys.slice(1), keys.slice(0, len(keys) - 1)))
        run = np.cumsum(change) - 1
        goes_on = self.last is not None and keys[0].as_py() == self.key
        t, forced = np.asarray(rows.column(1)), np.asarray(rows.column(2)).astype(bool)
        done = computed_in(run, t, forced, self.allowed if goes_on else int(ALWAYS), self.ttl)
        # what serves each row: the last computed row before it, or the carried one, put in front
        source = np.maximum.accumulate(np.where(done, np.arange(len(t)), -1))
        both = rows if self.last is None else pa.concat_batches([self.last, rows])
        source = source + (0 if self.last is None else 1)
        by = both.take(pa.array(source))
        out = pa.RecordBatch.from_arrays(
            [keys, rows.column(3), pa.array(~done), by.column(3), by.column(4)], ["key", "id", "hit", "computed_id", "own"]
        )
        self.last = both.slice(int(source[-1]), 1)
        self.key, self.allowed = keys[-1].as_py(), int(self.last.column(1)[0].as_py()) + self.ttl
        return out


def _serve_ordinary(rows: DataFrame, ttl: int) -> DataFrame:
    """(key, id, hit, computed_id, own) of requests (key, us, t, forced, id, own)."""

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Served(ttl)
        for batch in batches:
            if len(batch):
                yield state.batch(batch)

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"key {types['key']}, id {types['id']}, hit boolean, computed_id {types['id']}, own {types['own']}"
    ordered = rows.repartition("key").sortWithinPartitions("key", "us", "id")
    return ordered.select("key", "t", "forced", "id", "own").mapInArrow(serve, schema)


# --- hot keys: computations by chunks, requests by slots of equal row counts --------------------------


def _serve_hot(rows: DataFrame, hot: DataFrame, most_chunks: int, ttl: int) -> DataFrame:
    """(key, id, hit, computed_id, own) of the requests of hot keys; ``hot`` has key, k, _from, _length."""
    chunk = F.floor((F.col("t") - F.col("_from")) / F.col("_length"))
    numbered = rows.join(hot, "key").withColumn("chunk", chunk)
    request = F.struct("us", "id", "own")
    # one row per key and millisecond: the first request, and whether any overwrites
    instants = numbered.groupBy("k", "chunk", "t", (F.col("_from") + F.col("chunk") * F.col("_length") + ttl).alias("reach")).agg(
        F.min(request).alias("head"), F.max("forced").alias("forced")
    )
    instants = through_table(instants, "hot")
    found = _hot_misses(instants.select("k", "chunk", "reach", "t", "forced"), most_chunks, ttl)
    made = instants.join(found, ["k", "t"]).select("k", F.col("head").alias("made"))
    made = made.unionByName(numbered.filter("forced").select("k", request.alias("made"))).distinct()

    asked = numbered.select("k", "key", "us", "id", F.lit(True).alias("asks"), F.lit(None).cast(made.schema["made"].dataType).alias("made"))
    entries = asked.unionByName(
        made.select("k", F.lit(None).cast(rows.schema["key"].dataType).alias("key"), "made.us", "made.id", F.lit(False).alias("asks"), "made")
    )
    entries = through_table(entries, "entries")
    order = ["k", "us", "id", "asks"]  # a computation comes just before the request it is made for
    slots = max(1, math.ceil(entries.count() / SLOT_ROWS))
    placed = entries.repartitionByRange(slots, *order).withColumn("slot", F.spark_partition_id())
    placed = through_table(placed, "slots")
    inside = W.partitionBy("slot", "k").orderBy("us", "id", "asks").rowsBetween(W.unboundedPreceding, W.currentRow)
    served = placed.withColumn("by", F.last("made", ignorenulls=True).over(inside))
    # a row per slot and key: what the slots before it leave
    last = placed.groupBy("slot", "k").agg(F.max_by("made", F.when(F.col("made").isNotNull(), F.struct("us", "id"))).alias("made"))
    before = W.partitionBy("k").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    last = last.select("slot", "k", F.last("made", ignorenulls=True).over(before).alias("earlier"))
    by = F.coalesce("by", "earlier")
    return served.filter("asks").join(last, ["slot", "k"]).select(
        "key", "id", (by["id"] != F.col("id")).alias("hit"), by["id"].alias("computed_id"), by["own"].alias("own")
    )


def _hot_keys(rows: DataFrame, ttl: int, hot_rows: int) -> tuple[DataFrame | None, int]:
    """Keys over ``hot_rows`` requests with a number, their first instant and chunk length.

    A chunk spans about ``hot_rows`` requests, and at least a few periods. The second result is the
    largest number of chunks of a key; no hot key gives (None, 0).
    """
    busy = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.min("t").alias("_from"), F.max("t").alias("_to"))
    busy = busy.filter(F.col("_n") > hot_rows)
    periods = F.floor((F.col("_to") - F.col("_from")) / ttl) + 1
    length = F.greatest(F.lit(CHUNK_PERIODS), F.ceil(periods * hot_rows / F.col("_n"))).cast("long") * ttl
    chunks = F.floor((F.col("_to") - F.col("_from")) / F.col("_length")) + 1
    seed = 0
    while True:
        number = F.xxhash64(F.lit(seed), "key").alias("k")
        hot = broadcast_small(busy.select("key", number, "_from", length.alias("_length"), "_to"))
        row = hot.agg(F.count("k"), F.countDistinct("k"), F.max(chunks)).first()
        if row[0] == row[1]:  # numbers are unique; if not, number again
            return (hot.drop("_to"), row[2]) if row[0] else (None, 0)
        seed += 1


def ttl_dedup(
    log: DataFrame,
    key: str = "text_key",
    ts: str = "ts",
    id_col: str = "prediction_id",
    payload: Sequence[str] = ("predicted_label", "confidence"),
    overwrite: str | None = None,
    ttl_seconds: int = TTL_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every request with ``hit``, the id that was computed for it and the payload it is served.

    ``overwrite`` names a flag of requests that skip the cache read and always write it. Periods
    are compared in milliseconds; order within one is by (ts, id); ids are unique. A null key
    matches nothing: its requests are computed each on their own, and so is a request without a time.
    Keys with more than ``hot_rows`` requests go by chunks; the result is the same.
    """
    ttl = ttl_seconds * 1_000
    at = micros(ts) if dict(log.dtypes)[ts] == "timestamp_ntz" else F.unix_micros(ts)
    forced = F.coalesce(F.col(overwrite), F.lit(False)) if overwrite else F.lit(False)
    rows = log.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("key"),
        at.alias("us"),
        F.floor(at / 1_000).alias("t"),
        forced.alias("forced"),
        F.col(id_col).alias("id"),
        F.struct(*payload).alias("own"),
    )
    hot, most_chunks = _hot_keys(rows, ttl, hot_rows)
    if hot is None:
        served = _serve_ordinary(rows, ttl)
    else:
        served = _serve_ordinary(rows.join(hot.select("key"), "key", "left_anti"), ttl)
        served = served.unionByName(_serve_hot(rows, hot, most_chunks, ttl))
    alone = log.filter(F.col(key).isNull() | F.col(ts).isNull()).select(
        id_col, key, F.lit(False).alias("hit"), F.col(id_col).alias("computed_id"), *payload
    )
    served = served.select(
        F.col("id").alias(id_col), F.col("key").alias(key), "hit", "computed_id", *[F.col(f"own.{c}").alias(c) for c in payload]
    )
    return served.unionByName(alone)
