"""MinHash near-duplicates by a signature-coordinate inverted join.

Equal shingle sets are one node. Each node's signature has ``COORDINATES`` minima, and the node is posted
under each (coordinate, value) pair. Two sets of similarity 0.75 share 48 of the 64 on average; a pair is
retained if ``MATCHES`` agree, which misses such a pair with probability 4e-6. Postings are counted, and
a node keeps only its shared ones, rarest first: of nodes that agree in ``MATCHES`` places, each has one
of them among its first shared - MATCHES + 1, so the frequent rest (passages that many documents hold)
is skipped. Inside the posting lists left, agreements are counted in numpy and lists of any length are
compared block by block (``blocks``), which gives clusters that no retained pair crosses. Inside the
clusters, links are confirmed on the full shingle sets.

Defined results: a text without words has an empty set and is linked with nothing; a component's id is
its smallest non-null document id (null if it has none), and a row is kept if its id equals that, so rows
that repeat the kept id with an equal set all stay; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.blocks import lagged, linked
from intentloom.llm.common import WORD, read
from intentloom.llm.shingles import mixed, set_key, shingle_set
from intentloom.session import through_table

COORDINATES = 64
MATCHES = 33
STEP = 16  # coordinates counted at a time
PERCENT = 75
COLUMNS = 1 << 13  # shingles compared at a time

_MULTIPLY = np.random.default_rng(77).integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least high half of each coordinate's hash, as int32."""
    least = np.full(COORDINATES, 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), 4096):
        hashed = mixed(shingles[at : at + 4096, None] * _MULTIPLY[None, :]) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=0))
    return least.astype(np.uint32).view(np.int32)


def same_row(id_col: str, text_col: str) -> Column:
    """128 bits that rows of equal id and text share: two hashes with unlike beginnings."""
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), id_col, text_col)), 16, "0") for seed in ("one", "two")]
    return F.unhex(F.concat(*halves))


def shingled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n, key, sig) of every row; key and sig are null where the set is empty."""

    def rows(batches):
        for batch in batches:
            n, keys, sigs = [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                sigs.append(signature(s) if len(s) else None)
            arrays = [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "row", "n", "key", "sig"])

    picked = docs.select(F.col(id_col).cast("long"), same_row(id_col, text_col), F.col(text_col))
    return picked.mapInArrow(rows, "doc_id long, row binary, n long, key binary, sig array<int>")


def posting_lists(nodes: DataFrame) -> DataFrame:
    """(g, node, n): the postings to compare, n the length of the whole list."""
    postings = nodes.select("node", F.posexplode("sig").alias("c", "value"))
    postings = postings.select("node", F.expr("shiftleft(cast(c as long), 32) + value").alias("g"))
    shared = through_table(postings.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "frequencies")
    held = postings.join(shared, "g").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "g"))).alias("held"))
    first = F.slice("held", 1, F.size("held") - (MATCHES - 1))
    held = held.filter(F.size("held") >= MATCHES).select("node", F.explode(first).alias("p"))
    return through_table(held.select(F.col("p.g").alias("g"), "node", F.col("p.n").alias("n")), "lists")


def agreeing(units: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one unit that collide under ``MATCHES`` coordinates or more.

    Collisions are counted ``STEP`` coordinates at a time; a pair that cannot reach the threshold with the
    coordinates left is skipped from there on.
    """
    sig = np.asarray(table.column("sig").combine_chunks().flatten()).reshape(-1, COORDINATES)
    i, j = [], []
    for a, b in lagged(units):
        count = np.zeros(len(a), np.int64)
        for c in range(0, COORDINATES, STEP):
            count += (sig[a, c : c + STEP] == sig[b, c : c + STEP]).sum(axis=1)
            on = count + (COORDINATES - c - STEP) >= MATCHES
            a, b, count = a[on], b[on], count[on]
        i.append(a)
        j.append(b)
    return np.concatenate([*i, np.zeros(0, int)]), np.concatenate([*j, np.zeros(0, int)])


def similar(units: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one unit that share ``PERCENT`` of their shingles, counted on the full sets."""
    texts = table.column("text").to_pylist()
    i, j = [], []
    for lo, hi in zip(*(np.searchsorted(units, np.unique(units), s) for s in ("left", "right"))):
        if hi - lo < 2:
            continue
        sets = [shingle_set(t) for t in texts[lo:hi]]
        size = np.array([len(s) for s in sets])
        distinct, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner, shared = np.repeat(np.arange(hi - lo), size), count[at] > 1
        owner, at = owner[shared], (np.cumsum(count > 1) - 1)[at[shared]]
        both = np.zeros((hi - lo, hi - lo), np.float32)
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        for c in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
            part = slice(*np.searchsorted(at, [c, c + COLUMNS]))
            held = np.zeros((hi - lo, COLUMNS), np.float32)
            held[owner[part], at[part] - c] = 1
            both += held @ held.T
        linked_ = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
        a, b = np.nonzero(np.triu(linked_, 1))
        i.append(lo + a)
        j.append(lo + b)
    return np.concatenate([*i, np.zeros(0, int)]), np.concatenate([*j, np.zeros(0, int)])


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, component_id, component) for every row of ``docs``.

    ``component`` tells components apart that have no id; it is null where the set is empty.
    """
    rows = through_table(shingled(docs, id_col, text_col), "shingled")
    sets = rows.filter("key is not null").groupBy(F.col("key").alias("node"))
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("one")
    nodes = sets.agg(one, F.first("sig").alias("sig"), F.max("n").alias("size"))
    nodes = through_table(nodes.select("node", "one.doc_id", "one.row", "sig", "size"), "sets")

    clusters = linked(posting_lists(nodes), nodes.select("node", "sig"), agreeing)
    counted = through_table(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "clusters")
    members = clusters.join(counted, "root").select(F.col("root").alias("g"), "node", "n")
    members = through_table(members, "members")
    wanted = members.select("node").join(nodes.select("node", "row"), "node")
    texts = docs.select(same_row(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    texts = wanted.join(texts, "row").groupBy("row").agg(F.first("node").alias("node"), F.first("text").alias("text"))
    same = linked(members, through_table(texts.select("node", "text"), "texts"), similar)

    ids = nodes.select("node", "doc_id")
    least = same.join(ids, "node").groupBy("root").agg(F.min("doc_id").alias("least"))
    least = through_table(same.join(least, "root").select("node", "root", "least"), "least")
    ids = ids.join(least.withColumn("linked", F.lit(True)), "node", "left")
    ids = ids.select(
        F.col("node").alias("key"),
        F.when(F.col("linked"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("root", "node").alias("component"),
    )
    known = rows.select("doc_id", "row", "n", "key").join(through_table(ids, "component-ids"), "key", "left")
    component_id = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return known.select("doc_id", "row", F.col("n").alias("n_shingles"), component_id.alias("component_id"), "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) for every row of ``docs``."""
    known = grouped(docs, id_col, text_col).drop("component")
    return known.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each component, with the columns of ``docs``, and all rows without words.

    The row of the smallest id stays, null last; of rows with that id the one of the smallest hash of id and
    text, and of rows equal in both the one of the smallest hash of all columns. Equal rows are reduced to
    one before they are shuffled, so a hot group costs a row per task.
    """
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least")
    stays = grouped(docs, id_col, text_col).filter("component is not null").groupBy("component").agg(least)
    stays = through_table(stays.select("least.row"), "kept-rows")
    packed = docs.select(F.struct("*").alias("doc"), same_row(id_col, text_col).alias("row"), F.coalesce(F.col(text_col).rlike(WORD), F.lit(False)).alias("words"))
    single = packed.filter("words").groupBy("row").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    single = single.join(stays, "row", "left_semi")
    return single.select("doc").unionAll(packed.filter(~F.col("words")).select("doc")).select("doc.*")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
