"""Links inside groups of any size, compared block by block and returned as spanning forests.

A group (the holders of a common value, or a cluster) is cut into blocks of bounded size. First block 0
meets every block: linear in the group, and enough where the group is one cluster. Only members of large
groups that are then outside their group's largest component meet all blocks. No pair is ever a row: a
task compares one bounded unit in numpy and returns at most one edge for each of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.common import components
from intentloom.session import through_table

BLOCK = 128
HELD_ROWS, HELD_BYTES = 1 << 15, 1 << 25

#: (unit number of each row, the rows' payload) -> index arrays (i, j) of linked rows, i < j, of one unit
Compare = Callable[[np.ndarray, pa.Table], tuple[np.ndarray, np.ndarray]]


def whole_units(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that never cut a unit (equal first ``keys`` columns), with unit numbers."""
    held, rows, size = [], 0, 0

    def numbered(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for k in range(keys):
            c = t.column(k).combine_chunks()
            new[1:] |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)))
        return np.cumsum(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
        if rows >= HELD_ROWS or size >= HELD_BYTES:
            t = pa.Table.from_batches(held).combine_chunks()
            units = numbered(t)
            cut = int(np.searchsorted(units, units[-1]))
            if cut:
                yield t.slice(0, cut), units[:cut]
            held = t.slice(cut).to_batches()
            rows, size = t.num_rows - cut, sum(b.nbytes for b in held)
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, numbered(t)


def lagged(units: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one unit, by distance: (i, i + 1), then (i, i + 2) ..."""
    at, lag = np.arange(len(units)), 1
    while len(at := at[at + lag < len(units)]) and len(at := at[units[at] == units[at + lag]]):
        yield at, at + lag
        lag += 1


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches over the links (i, j)."""
    top = np.arange(n)
    while len(i):
        a, b = top[i], top[j]
        low = np.minimum(a, b)
        np.minimum.at(top, a, low)
        np.minimum.at(top, b, low)
        top = top[top]
        if (top[i] == top[j]).all():
            while (top != top[top]).any():
                top = top[top]
            break
    return top


def _compared(units: DataFrame, compare: Compare) -> DataFrame:
    """``units`` (g, u, v, node, payload...): edges (a, b) between nodes."""
    kind = dict(units.dtypes)["node"]

    def links(batches):
        for table, number in whole_units(batches, 3):
            top = forest(table.num_rows, *compare(number, table))
            low = np.flatnonzero(top != np.arange(len(top)))
            if len(low):
                node = table.column("node").combine_chunks()
                yield pa.RecordBatch.from_arrays([node.take(pa.array(low)), node.take(pa.array(top[low]))], ["a", "b"])

    dealt = units.repartition("g", "u", "v").sortWithinPartitions("g", "u", "v")
    return dealt.mapInArrow(links, f"a {kind}, b {kind}").filter("a <> b").distinct()


def _blocks(n: Column) -> Column:
    return F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("long")


def _payload(units: DataFrame, payload: DataFrame) -> DataFrame:
    return units.join(payload, "node").select("g", "u", "v", "node", *[c for c in payload.columns if c != "node"])


def linked(members: DataFrame, payload: DataFrame, compare: Compare) -> DataFrame:
    """Components (node, root) of the links that ``compare`` finds inside groups.

    ``members`` (g, node, n) is a stored table with ``n`` at least the group's size (more makes smaller blocks), ``payload`` (node, ...)
    a stored table. Nodes without a link are left out.
    """
    block = F.pmod(F.xxhash64("node", "g"), _blocks(F.col("n")))
    blocked = members.withColumn("k", _blocks(F.col("n"))).withColumn("v", block)
    every = F.when(F.col("v") == 0, F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).otherwise(F.array("v"))
    star = blocked.select("g", F.lit(0).cast("long").alias("u"), F.explode(every).alias("v"), "node")
    edges = through_table(_compared(_payload(star, payload), compare), "links")
    found = through_table(components(edges), "components")
    large = through_table(members.filter(F.col("n") > BLOCK), "large")
    if large.isEmpty():
        return found

    label = F.coalesce("root", "node").alias("label")
    seen = through_table(large.join(found, "node", "left").select("g", "node", "n", label), "labels")
    sizes = seen.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c"))
    most = sizes.groupBy("g").agg(F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("all"))
    most = through_table(most.select("g", F.col("most.label").alias("top"), (F.col("all") - F.col("most.c")).alias("out")), "most")
    seen = seen.join(most.filter("out > 0"), "g")
    seen = seen.withColumn("k", _blocks(F.col("n"))).withColumn("o", _blocks(F.col("out")))
    sides = seen.select(
        "g", "node",
        F.when(F.col("label") != F.col("top"), F.pmod(F.xxhash64("node", "g"), F.col("o"))).alias("mine"),
        F.pmod(F.xxhash64("g", "node"), F.col("k")).alias("v"), "k", "o",
    )
    zero = F.lit(0).cast("long")
    rows = sides.filter("mine is not null")
    rows = rows.select("g", F.col("mine").alias("u"), F.explode(F.sequence(zero, F.col("k") - 1)).alias("v"), "node")
    cols = sides.select("g", F.explode(F.sequence(zero, F.col("o") - 1)).alias("u"), "v", "node")
    rest = _compared(_payload(rows.unionByName(cols).distinct(), payload), compare)
    first = found.select(F.col("node").alias("a"), F.col("root").alias("b"))  # says what the first links said
    return through_table(components(first, through_table(rest, "links")), "components")
