"""Ranks, cuts and order statistics that never put one group, or one key, into one task.

A class, a client or a source may hold a third of all rows. A window partitioned by such a key
sorts that third in a single task, so everything here first splits the key into buckets, counts
the buckets (partial aggregation, a few thousand rows), and then either

* ranks inside the bucket and adds the bucket's offset, or
* finds the one bucket that holds a wanted rank and looks only there.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.session import through_table

SMALL_ROWS = 200_000
RANGE_ROWS = 250_000  # distinct values that one task cumulates
RANK_DIGITS = 3  # 4,096 hash buckets per group
CUT_DIGITS = 4  # 65,536


def broadcast_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` if a count proves it has at most ``max_rows`` rows, else leave it alone.

    The small result is fetched once and handed back as a local table, so the step that made it
    is not run again. Past the bound the join stays a shuffle join, where adaptive execution
    splits skewed keys.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema))


def _bucket_counts(df: DataFrame, by: Sequence[str], bucket: Column) -> DataFrame:
    counts = df.groupBy(*by, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    group = W.partitionBy(*by)
    upto = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.select(
        *by,
        "_bucket",
        "_rows",
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(group).alias("_total"),
    )


def hash_rank(df: DataFrame, by: Sequence[str], hash_col: str, out: str = "rn") -> DataFrame:
    """1-based position of each row in its ``by`` group, ordered by ``hash_col``.

    Same result as ``row_number() over (partition by <by> order by <hash_col>)``, but a sort
    never spans more than one hash bucket of a group.
    """
    by, bucket = list(by), F.substring(hash_col, 1, RANK_DIGITS)
    before = _bucket_counts(df, by, bucket).select(*by, "_bucket", "_before")
    within = W.partitionBy(*by, "_bucket").orderBy(hash_col)
    return (
        df.withColumn("_bucket", bucket)
        .join(broadcast_small(before), [*by, "_bucket"])
        .withColumn(out, F.row_number().over(within) + F.col("_before"))
        .drop("_bucket", "_before")
    )


def hash_cuts(df: DataFrame, by: Sequence[str], hash_col: str, targets: Mapping[str, Column]) -> DataFrame:
    """Per ``by`` group and target, the hash of the row with that rank: the last one to take.

    ``targets`` maps an output name to a rank, written in terms of ``_total`` (rows in the
    group). ``hash_col <= cut`` then selects exactly that many rows in a map-only pass; a rank
    below 1 gives a null cut. Only the buckets that hold a wanted rank are sorted.
    """
    by, bucket = list(by), F.substring(hash_col, 1, CUT_DIGITS)
    counts = _bucket_counts(df, by, bucket)
    wanted = F.array(*[F.struct(F.lit(n).alias("_target"), k.cast("long").alias("_rank")) for n, k in targets.items()])
    holding = (
        counts.select("*", F.inline(wanted))
        .filter("_rank > _before and _rank <= _before + _rows")
        .select(*by, "_bucket", "_target", (F.col("_rank") - F.col("_before")).alias("_local"))
    )
    within = W.partitionBy(*by, "_target").orderBy(hash_col)
    hits = (
        df.select(*by, hash_col, bucket.alias("_bucket"))
        .join(broadcast_small(holding), [*by, "_bucket"])
        .withColumn("_rn", F.row_number().over(within))
        .filter("_rn = _local")
    )
    picks = [F.max(F.when(F.col("_target") == n, F.col(hash_col))).alias(n) for n in targets]
    return hits.groupBy(*by).agg(*picks)


def cut_points(
    df: DataFrame, cols: Sequence[str], buckets: int, also: Sequence[Column] = ()
) -> tuple[dict[str, list[float]], list]:
    """About ``buckets - 1`` values per column that split it into parts of similar size.

    One pass with a mergeable sketch; the answer (a few hundred numbers) comes to the driver
    and goes into later plans as literals, so every branch and every retry buckets alike.
    ``also`` are further aggregates to take in the same pass, returned as the second result.
    """
    probs = [i / buckets for i in range(1, buckets)]
    sketches = [F.percentile_approx(c, probs, 20 * buckets).alias(f"_{i}") for i, c in enumerate(cols)]
    row = df.agg(*sketches, *also).first()
    return {c: sorted({float(v) for v in row[i] or []}) for i, c in enumerate(cols)}, list(row[len(cols) :])


def with_bucket(df: DataFrame, col: str, cuts: Sequence[float], out: str) -> DataFrame:
    splits = [-float("inf"), *(cuts or [0.0]), float("inf")]
    marked = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)
    return marked.withColumn(out, F.col(out).cast("int"))


def running_counts(df: DataFrame, keys: Sequence[str], bucket: str, value: str, counts: Sequence[str]) -> DataFrame:
    """Distinct values in order with running totals over the whole group.

    Returns keys, value, the ``counts`` columns summed per value, ``cum_<count>`` (inclusive),
    ``all_<count>`` (group total) and ``next_value``. Rows are first collapsed to one per
    distinct value, then cumulated per bucket. The bucket totals meet the values in the shuffle
    that the cumulation needs anyway.
    """
    keys = list(keys)
    # stated here, so that both readers of the collapsed rows plan, and share, the same shuffle
    for c in [*keys, bucket, value]:
        df = df.filter(F.col(c).isNotNull())
    per_value = df.groupBy(*keys, bucket, value).agg(*[F.sum(c).alias(c) for c in counts])
    group = W.partitionBy(*keys)
    ordered = group.orderBy(bucket)
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    totals = (
        per_value.groupBy(*keys, bucket)
        .agg(*[F.sum(c).alias(c) for c in counts], F.min(value).alias("_first"))
        .select(
            *keys,
            bucket,
            F.lead("_first").over(ordered).alias("_after"),
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_pre_{c}") for c in counts],
            *[F.sum(c).over(group).alias(f"all_{c}") for c in counts],
        )
    )
    inside = W.partitionBy(*keys, bucket).orderBy(value)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_value.join(totals.hint("shuffle_hash"), [*keys, bucket]).select(
        *keys,
        value,
        *counts,
        *[(F.col(f"_pre_{c}") + F.sum(c).over(upto)).alias(f"cum_{c}") for c in counts],
        *[f"all_{c}" for c in counts],
        F.coalesce(F.lead(value).over(inside), F.col("_after")).alias("next_value"),
    )


def ranged(per_value: DataFrame, keys: Sequence[str], value: str, out: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``per_value`` (one row per keys and value) with the number of the value range a row is in.

    There are as many ranges as the rows need, and Spark cuts them where the rows are: by a sample of
    (keys, value), so neither a crowded stretch of values nor a group with most of them makes a range long.
    The result is a written table, so every reader sees the same ranges.
    """
    collapsed = through_table(per_value, "values")
    ranges = max(1, math.ceil(collapsed.count() / range_rows))
    cut = collapsed.repartitionByRange(ranges, *keys, value).withColumn(out, F.spark_partition_id())
    return through_table(cut, "ranges")


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], buckets: int = 256, weight: str | None = None
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group.

    Equal to the built-in ``percentile``, whose buffer holds every distinct value of a group in
    one task; here the group is spread over value ranges. ``weight`` names a column that tells
    how often a row's value counts.
    """
    keys = list(keys)
    times = F.col(weight) if weight else F.lit(1)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"), times.cast("long").alias("n"))
    rows = rows.filter("_v is not null")
    cuts = cut_points(rows, ["_v"], buckets)[0]["_v"]
    ranked = running_counts(with_bucket(rows, "_v", cuts, "_b"), keys, "_b", "_v", ["n"])
    picks = []
    for i, p in enumerate(probs.values()):
        spot = F.lit(float(p)) * (F.col("all_n") - 1)
        for side, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            here = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
    found = ranked.groupBy(*keys).agg(F.max("all_n").alias("_n"), *picks)
    values = []
    for i, (name, p) in enumerate(probs.items()):
        spot = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        values.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return found.select(*keys, *values)
