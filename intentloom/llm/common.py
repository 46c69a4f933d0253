"""What the operators of this subpackage share: words, ranks that split hot groups, connected components."""

from __future__ import annotations

import gc
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.session import through_table

#: White space that separates words: ASCII only, so that other spaces stay inside words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_array(text: Column) -> Column:
    """Words of a text in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bucketed_rank(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], out: str, about: DataFrame | None = None
) -> DataFrame:
    """1-based rank of each row within ``group``, by (bucket, order), without sorting a group in one task.

    Buckets are counted, the counts are summed up within the group, and only rows of one bucket are
    sorted together. ``df`` is read twice, so it should be cheap to read; group and bucket hold no nulls.
    Columns of ``about``, a row per group, come along with the counts: no row is dealt by its group alone.
    """
    group = list(group)
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    upto = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = counts.select(*group, bucket, (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"))
    if about is not None:
        before = before.join(about, group)
    inside = W.partitionBy(*group, bucket).orderBy(*order)
    return (
        df.join(before, [*group, bucket])
        .withColumn(out, F.col("_before") + F.row_number().over(inside))
        .drop("_before")
    )


def sums_before(df: DataFrame, order: Sequence[Column], **sums: str) -> DataFrame:
    """``df`` with, for each ``name=column``, the sum of that column over all rows before it in ``order``.

    Rows are dealt to tasks by ranges of ``order``; a range adds up its own rows, and the totals of the
    ranges, one row each, are added up among themselves. ``order`` leaves no ties.
    """
    part, first = free_name(df, "part"), W.unboundedPreceding
    dealt = through_table(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    upto = W.orderBy(part).rowsBetween(first, -1)  # over one row per task
    totals = dealt.groupBy(part).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    totals = totals.select(part, *[F.coalesce(F.sum(f"_{n}").over(upto), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = W.partitionBy(part).orderBy(*order).rowsBetween(first, -1)
    added = [(F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()]
    return dealt.join(F.broadcast(totals), part).select(*df.columns, *added)


#: Links that one task joins up by itself: some megabytes, whatever the corpus. More go by rounds.
FEW_LINKS = 100_000


def _joined_up(batches):
    """(node, root) of all links (a, b) of one task."""
    parts = [batch for batch in batches if batch.num_rows]
    if parts:
        links = pa.Table.from_batches(parts)
        a, b = (links.column(k).combine_chunks() for k in (0, 1))
        nodes = pc.unique(pa.concat_arrays([a, b]))
        nodes = nodes.take(pc.sort_indices(nodes))
        sets = Forest(len(nodes))
        for i, j in zip(pc.index_in(a, nodes).to_pylist(), pc.index_in(b, nodes).to_pylist()):
            sets.link(i, j)
        roots = pa.array([sets.root(i) for i in range(len(nodes))], pa.int64())
        yield pa.RecordBatch.from_arrays([nodes, nodes.take(roots)], ["node", "root"])


def components(*links: DataFrame) -> DataFrame:
    """Connected components of stored tables of links (a, b): one row (node, root) per node of a link.

    The root is the smallest node of the component. Up to ``FEW_LINKS`` links are joined up in one task.
    More go by rounds: each points every node at its smallest
    neighbour, links its other smaller neighbours to that one, and then jumps one pointer ahead, so
    the depth halves. Rounds end in written tables: a lost executor costs a read. No node's
    neighbours are gathered; the joins are on keys that Spark can split where a hub is hot. Both ways give the same rows.
    """
    a, b = F.col("a"), F.col("b")
    edges = union_all([t.select("a", "b") for t in links]).filter(a != b)
    kind = dict(edges.dtypes)["a"]
    if sum(t.count() for t in links) <= FEW_LINKS:
        return edges.coalesce(1).mapInArrow(_joined_up, f"node {kind}, root {kind}")
    now = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct()
    now = through_table(now, "links")
    while True:
        least = through_table(now.groupBy("x").agg(F.min("y").alias("m")), "least")
        up = least.select(F.col("x").alias("m"), F.col("m").alias("top"))
        jumped = least.join(up, "m", "left").select(
            "x", F.coalesce("top", "m").alias("y"), F.col("top").isNotNull().cast("int").alias("moved")
        )
        rest = (
            now.join(least, "x")
            .filter(F.col("y") != F.col("m"))
            .select(F.col("y").alias("x"), F.col("m").alias("y"), F.lit(1).alias("moved"))
        )
        step = stored(jumped.unionByName(rest).groupBy("x", "y").agg(F.max("moved").alias("moved")), "links")
        discard(now, least)
        now = step.select("x", "y")
        if step.filter("moved = 1").isEmpty():
            break
    roots = now.select(F.col("y").alias("x")).distinct().select("x", F.col("x").alias("y"))
    return now.unionByName(roots).select(F.col("x").alias("node"), F.col("y").alias("root"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``through_table``, then let go of shuffles that no frame refers to any more.

    Spark deletes the files of a shuffle when the driver collects the objects that stand for it, which
    on a roomy driver may never happen while a query of many steps runs.
    """
    out = through_table(df, purpose)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


class Forest:
    """Disjoint sets over 0..n-1 with the smallest member as root, for links found inside one task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
