"""Cosine links between vectors of one label by an epsilon grid order join.

Vectors are scaled to length one, where cosine >= c means distance <= eps = sqrt(2 - 2 c). All of them
give the principal axes. Each label's vectors are put in order of their grid cells (side eps) along the
leading axes, and the order is cut into blocks. Blocks form a tree of intervals with a bounding box each
(leading coordinates, and the length of what is left). From the root, interval pairs are joined
recursively, a level per step: pairs whose boxes are further apart than eps are skipped, the others are
replaced by the pairs of their parts. What is left are pairs of blocks, which tasks compare in numpy.

A vector is in as many block pairs as its label has blocks, so pairs are not sent one by one: up to
``WIDEST`` neighbouring blocks are a tile, and a pair of tiles goes to one task, with the list of its block
pairs. Tiles widen with the number of pairs; where even the widest send a vector more than ``SHARE`` times,
tile pairs go in rounds, and a round's shuffle is let go of before the next. Vectors are moved as they came
(four bytes a float) and scaled where they are read; tables that no later step reads are deleted.

Equal vectors are one node with a count, so copies are never expanded; a task returns for each of its
rows at most a number of links and one edge of a spanning forest, never pairs. Defined results: vectors
that are null, empty, zero or hold null or non-finite components, or whose label is null, link with
nothing; vectors of different lengths do not link; a component's id is its smallest non-null id; repeated
rows are vectors of their own that link with each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentloom.functions.scale import broadcast_small
from intentloom.llm.blocks import forest, whole_units
from intentloom.llm.common import bucketed_rank, components, discard, read, stored, union_all
from intentloom.session import through_table

COSINE = 0.93
GRID_AXES = 4
BOX_AXES = 8
BLOCK = 256  # vectors
FAN = 8  # parts of an interval
SPREAD = 16  # buckets of one cell, so that a crowded cell is sorted in parts
WIDEST = 64  # blocks of a tile: bits of a long
TILE_BYTES = 1 << 22
SHARE = 2  # times that a round may send the vectors
RUN = 16  # blocks that one block is compared with at once
HELD = 4  # times the nodes: so many found rows are added up


def _rows(batch: pa.RecordBatch, column: int) -> list:
    return batch.column(column).to_pylist()


def unit_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, dim, key, raw) of every row; key and raw (see ``packed``) null if it links with nothing."""
    kind = packed(table, vector_col)

    def unit(v: list | None) -> np.ndarray | None:
        if not v or any(x is None for x in v):
            return None
        a = np.array(v, np.float64)
        top = np.abs(a).max()
        if not np.isfinite(top) or top == 0 or np.isnan(a).any():
            return None
        a /= top
        return a / np.sqrt(a @ a)

    def rows(batches):
        for batch in batches:
            dims, keys, raws = [], [], []
            for v, label in zip(_rows(batch, 1), _rows(batch, 2)):
                u = unit(v) if label is not None else None
                dims.append(None if u is None else len(u))
                raws.append(None if u is None else np.array(v, kind).tobytes())
                keys.append(None if u is None else hashlib.blake2b((u + 0.0).astype("<f8").tobytes() + str(label).encode(), digest_size=16).digest())
            arrays = [pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], ["vec_id", "label", "dim", "key", "raw"])

    picked = table.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>"), F.col(label_col).cast("string"))
    return picked.mapInArrow(rows, "vec_id long, label string, dim int, key binary, raw binary")


def packed(table: DataFrame, vector_col: str) -> str:
    """The little-endian form that holds a component of the column as it is."""
    kind = table.schema[vector_col].dataType
    return "<f4" if isinstance(getattr(kind, "elementType", None), T.FloatType) else "<f8"


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind: str) -> np.ndarray:
    """Packed vectors as rows of length one."""
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, initial=0)[:, None]
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def principal_axes(nodes: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """For each vector length the axes of largest spread, from sums over all nodes.

    Tasks return their sums of products; they are added in Spark, and one square matrix per length
    (bounded by the vectors' own length) comes to the driver.
    """

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column(0))
            for d in np.unique(dims):
                x = _matrix(batch.column(1).filter(pa.array(dims == d)), int(d), kind)
                x = np.hstack([x, np.ones((len(x), 1))])
                total[int(d)] = total.get(int(d), 0) + x.T @ x
        for d, m in total.items():
            flat = m.ravel()
            yield pa.RecordBatch.from_pydict({"dim": np.full(len(flat), d, np.int32), "cell": np.arange(len(flat)), "value": flat})

    parts = nodes.select("dim", "raw").mapInArrow(sums, "dim int, cell long, value double")
    summed = parts.groupBy("dim", "cell").agg(F.sum("value").alias("value")).toPandas()
    axes = {}
    for d, part in summed.groupby("dim"):
        m = part.sort_values("cell")["value"].to_numpy().reshape(d + 1, d + 1)
        mean = m[d, :d] / m[d, d]
        spread, axis = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))
        axes[int(d)] = axis[:, np.argsort(-spread)[:BOX_AXES]]
    return axes


def placed(nodes: DataFrame, axes: dict[int, np.ndarray], eps: float, kind: str) -> DataFrame:
    """(node, vec_id, copies, g, raw, x, bucket): the group compared within, the box coordinates and the grid cell of each node."""

    def rows(batches):
        for batch in batches:
            names = ["node", "vec_id", "copies", "g", "raw", "cell", "x"]
            dims = np.asarray(batch.column(3))
            for d in np.unique(dims):
                pick = pa.array(dims == d)
                part = batch.filter(pick)
                x = _matrix(part.column(5), int(d), kind) @ axes[int(d)]
                rest = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
                cells = np.floor(x[:, :GRID_AXES] / eps).astype(int) + 100
                cell = ["".join(f"{c:03d}" for c in row) for row in cells]
                box = np.hstack([x, np.zeros((len(x), BOX_AXES - x.shape[1])), rest[:, None]])
                group = pa.array([f"{d}|{g}" for g in part.column(4).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:3], group, part.column(5), pa.array(cell), pa.array(list(box))], names)

    schema = "node binary, vec_id long, copies long, g string, raw binary, cell string, x array<double>"
    out = nodes.select("node", "vec_id", "copies", "dim", "label", "raw").mapInArrow(rows, schema)
    spread = F.lpad(F.pmod(F.xxhash64("node"), F.lit(SPREAD)).cast("string"), 2, "0")
    return out.withColumn("bucket", F.concat("cell", spread)).drop("cell")


def joined_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """(g, u, v), u <= v: the block pairs whose boxes come within eps, found from the root down.

    ``blocks`` (g, block, lo, hi) is a stored table.
    """
    top = blocks.agg(F.max("block")).first()[0] or 0
    levels, boxes = [], blocks
    while True:
        levels.append(boxes)
        if top == 0:
            break
        top //= FAN
        wide = [F.array(*[F.min(F.col("lo")[i]) for i in range(BOX_AXES + 1)]).alias("lo"), F.array(*[F.max(F.col("hi")[i]) for i in range(BOX_AXES + 1)]).alias("hi")]
        boxes = through_table(boxes.groupBy("g", F.floor(F.col("block") / FAN).alias("block")).agg(*wide), "boxes")
    pairs = levels.pop().select("g", F.col("block").alias("u"), F.col("block").alias("v"))
    limit = (eps * (1 + 1e-9)) ** 2 + 1e-12
    while levels:
        boxes = levels.pop().withColumn("up", F.floor(F.col("block") / FAN))
        a = boxes.select("g", F.col("up").alias("u"), F.col("block").alias("cu"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        b = boxes.select("g", F.col("up").alias("v"), F.col("block").alias("cv"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        gap = sum((F.pow(F.greatest(F.col("alo")[i] - F.col("bhi")[i], F.col("blo")[i] - F.col("ahi")[i], F.lit(0.0)), 2) for i in range(BOX_AXES + 1)), F.lit(0.0))
        pairs = pairs.join(a, ["g", "u"]).join(b, ["g", "v"]).filter((F.col("cu") <= F.col("cv")) & (gap <= limit))
        pairs = through_table(pairs.select("g", F.col("cu").alias("u"), F.col("cv").alias("v")), "block-pairs")
    return pairs


def tiled(pairs: DataFrame, n_blocks: int, block_bytes: int) -> tuple[DataFrame, int]:
    """(g, u, v, base, block, mates, wave) of the blocks that each pair of tiles (u, v) needs, from a stored table, and the number of waves.

    Bit k of ``mates`` tells that the block is to be compared with block ``base`` + k, of tile v. A wave has about ``SHARE`` times the blocks.
    """
    each, width = 2 * pairs.count() / max(n_blocks, 1), 1
    while width < WIDEST and each / width > SHARE + 1 and 2 * width * block_bytes <= TILE_BYTES:
        width *= 2
    tile = pairs.select("g", "u", "v", F.floor(F.col("u") / width).alias("tu"), F.floor(F.col("v") / width).alias("tv"))
    bit = F.expr(f"shiftleft(1L, cast(v % {width} as int))")
    sides = [tile.select("g", "tu", "tv", F.col("u").alias("block"), bit.alias("bit")), tile.select("g", "tu", "tv", F.col("v").alias("block"), F.lit(0).cast("long").alias("bit"))]
    needed = union_all(sides).groupBy("g", F.col("tu").alias("u"), F.col("tv").alias("v"), "block").agg(F.bit_or("bit").alias("mates"))
    needed = through_table(needed.withColumn("base", F.col("v") * width), "tiles")
    waves = max(1, math.ceil(needed.count() / (SHARE * max(n_blocks, 1))))
    return needed.withColumn("wave", F.pmod(F.xxhash64("g", "u", "v"), F.lit(waves))), waves


def compared(units: DataFrame, cosine: float, tasks: int, kind: str) -> DataFrame:
    """``units`` (g, u, v, base, block, mates, node, copies, raw): (node, links, other), one row for each row with a link."""

    def links(batches):
        for table, number in whole_units(batches, 3):
            for lo, hi in zip(*(np.searchsorted(number, np.unique(number), s) for s in ("left", "right"))):
                part = table.slice(lo, hi - lo)
                base, block, mates, copies = (np.asarray(part.column(c)) for c in ("base", "block", "mates", "copies"))
                x = _matrix(part.column("raw"), len(part.column("raw")[0].as_py()) // np.dtype(kind).itemsize, kind)
                count, top = unit_links(x, block - base, mates, copies, cosine)
                rows = np.flatnonzero(count)
                if len(rows):
                    node = part.column("node").combine_chunks()
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(rows)), pa.array(count[rows]), node.take(pa.array(top[rows]))], ["node", "links", "other"])

    dealt = units.repartition(tasks, "g", "u", "v").sortWithinPartitions("g", "u", "v", "block")
    return dealt.select("g", "u", "v", "base", "block", "mates", "node", "copies", "raw").mapInArrow(links, "node binary, links long, other binary")


def unit_links(x: np.ndarray, block: np.ndarray, mates: np.ndarray, copies: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row of a pair of tiles, and the smallest row that it reaches. Rows are sorted by ``block``, counted from ``base``."""
    count, top = np.zeros(len(x), np.int64), np.arange(len(x))
    numbers, first = np.unique(block, return_index=True)
    rows = {int(b): np.arange(s, e) for b, s, e in zip(numbers, first, np.append(first[1:], len(x)))}
    for b, mine in rows.items():
        wanted = [k for k in range(WIDEST) if int(mates[mine[0]]) >> k & 1]
        for r in range(0, len(wanted), RUN):
            theirs = np.concatenate([rows[k] for k in wanted[r : r + RUN]])
            hit = x[mine] @ x[theirs].T >= cosine
            if b in wanted[r : r + RUN]:  # a pair of its own once, and no row with itself
                own = np.flatnonzero((theirs >= mine[0]) & (theirs <= mine[-1]))
                hit[:, own] = np.triu(hit[:, own], 1)
            i, j = (ends[at] for ends, at in zip((mine, theirs), np.nonzero(hit)))
            if len(i):
                count += np.bincount(i, copies[j], len(x)).astype(np.int64) + np.bincount(j, copies[i], len(x)).astype(np.int64)
                apart = top[i] != top[j]
                if apart.any():
                    top = forest(len(x), top[i[apart]], top[j[apart]])[top]
    return count, top


def added_up(found: list[DataFrame]) -> DataFrame:
    """(node, links, other) of stored tables of such rows, one row a node: all its links, and its component's smallest node."""
    rows = union_all(found)
    roots = components(*[f.select(F.col("node").alias("a"), F.col("other").alias("b")) for f in found])
    linked = rows.groupBy("node").agg(F.sum("links").alias("links"))
    out = stored(linked.join(roots.withColumnRenamed("root", "other"), "node"), "found")
    discard(*found)
    return out


def cosine_links(
    table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``."""
    eps, kind = math.sqrt(2 - 2 * cosine), packed(table, vector_col)
    rows = stored(unit_vectors(table, id_col, vector_col, label_col), "units")
    nodes = rows.filter("key is not null").groupBy(F.col("key").alias("node"))
    nodes = nodes.agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("raw").alias("raw")
    )
    nodes = stored(nodes, "vectors")
    keys = stored(rows.select("vec_id", "key"), "keys")
    discard(rows)
    axes = principal_axes(nodes, kind)
    spots = stored(placed(nodes, axes, eps, kind), "places")
    discard(nodes)
    ranked = bucketed_rank(spots, ["g"], "bucket", [F.col("x")[0], F.col("node")], "rank")
    ranked = stored(ranked.withColumn("block", F.floor((F.col("rank") - 1) / BLOCK)).drop("bucket", "rank"), "order")
    discard(spots)
    ends = [F.array(*[f(F.col("x")[i]) for i in range(BOX_AXES + 1)]).alias(n) for n, f in (("lo", F.min), ("hi", F.max))]
    blocks = through_table(ranked.groupBy("g", "block").agg(*ends), "boxes")
    n_blocks, n_nodes = blocks.count(), ranked.count()
    block_bytes = BLOCK * max(axes, default=0) * np.dtype(kind).itemsize
    needed, waves = tiled(joined_blocks(blocks, eps), n_blocks, block_bytes)
    tasks = 4 * table.sparkSession.sparkContext.defaultParallelism
    found, size = [], 0
    for wave in range(waves):
        sides = broadcast_small(needed.filter(F.col("wave") == wave).drop("wave"))
        units = ranked.select("g", "block", "node", "copies", "raw").join(sides, ["g", "block"])
        found.append(stored(compared(units, cosine, tasks, kind), "found"))
        size += found[-1].count()
        if size > HELD * n_nodes:
            found = [added_up(found)]
            size = found[0].count()
    nodes = stored(ranked.select("node", "vec_id", "copies"), "nodes")
    discard(ranked)

    found = added_up(found)
    ids = nodes.join(found, "node", "left")
    ids = through_table(ids.select("node", "vec_id", "copies", "links", F.coalesce("other", "node").alias("root")), "linked")
    least = through_table(ids.groupBy("root").agg(F.min("vec_id").alias("component_id")), "component-ids")
    ids = ids.join(least, "root").select(
        F.col("node").alias("key"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = keys.join(through_table(ids, "ids"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_links(read(spark, sf_dir, "embeddings"))


OP5_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) b from reach group by 1),
n as (select a, count(*) n from links group by 1)
select vec_id, coalesce(n, 0)::bigint n_links, least(vec_id, coalesce(b, vec_id)) component_id,
  vec_id <= coalesce(b, vec_id) kept
from embeddings left join n on n.a = vec_id left join least on least.a = vec_id
"""
