"""Splits, samples, augmentation and weights; every draw is keyed by (seed, row id)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.hashing import SEED, hash_int, row_hash
from intentloom.functions.scale import broadcast_small, hash_cuts, hash_rank
from intentloom.functions.text import random_swap, synonym_replace

SPLITS = {"train": 70, "val": 15, "test": 15}


def stratified_split(
    df: DataFrame,
    label: str = "label",
    id_col: str = "sample_id",
    percent: Mapping[str, int] = SPLITS,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``: per class, exact shares in whole percent, each row in one split.

    The class cuts are two hash values per class; the rows themselves are never shuffled. Rows
    without a label belong to no class and get a null split.
    """
    hashed = df.withColumn("_hash", row_hash(id_col, seed=seed))
    names, upto, targets = list(percent), 0, {}
    for name in names[:-1]:
        upto += percent[name]
        targets[f"_cut_{name}"] = F.floor(F.col("_total") * upto / 100)
    cuts = hash_cuts(hashed.filter(F.col(label).isNotNull()), [label], "_hash", targets)
    joined = hashed.join(broadcast_small(cuts), label, "left")
    split = F.lit(names[-1])
    for name in reversed(names[:-1]):
        split = F.when(F.col("_hash") <= F.col(f"_cut_{name}"), name).otherwise(split)
    return joined.withColumn("split", F.when(F.col(label).isNotNull(), split)).drop("_hash", *targets)


def few_shot_sample(
    df: DataFrame, shots: int, label: str = "label", id_col: str = "sample_id", seed: int = SEED
) -> DataFrame:
    """min(shots, class size) rows per class.

    Ids are ranked without their texts; the rank filter is planned as a group limit before the
    shuffle, so only ``shots`` ids per class and input partition travel.
    """
    order = W.partitionBy(label).orderBy(row_hash(id_col, seed=seed))
    ranked = df.select(label, id_col).withColumn("_rn", F.row_number().over(order))
    drawn = ranked.filter(F.col("_rn") <= shots).drop("_rn")
    return df.join(broadcast_small(drawn), [label, id_col], "left_semi")


def first_per_class(df: DataFrame, n: int = 8, label: str = "label", id_col: str = "sample_id") -> DataFrame:
    """The first row of each class in id order, for the first ``n`` classes.

    The ids are found from two narrow columns; the texts of the ``n`` winners are fetched after.
    """
    firsts = df.groupBy(label).agg(F.min(id_col).alias(id_col)).orderBy(label).limit(n)
    return df.join(F.broadcast(firsts), [label, id_col])


def class_samples(
    df: DataFrame, classes: int = 5, rows: int = 3, label: str = "label_name", id_col: str = "sample_id", seed: int = SEED
) -> DataFrame:
    """``rows`` drawn rows from each of ``classes`` drawn classes."""
    chosen = df.select(label).distinct().orderBy(row_hash(label, seed=seed)).limit(classes)
    # the limit bounds this side
    return few_shot_sample(df.join(F.broadcast(chosen), label, "left_semi"), rows, label, id_col, seed)


def bounded_sample(df: DataFrame, n: int = 200, id_col: str = "sample_id", seed: int = SEED) -> DataFrame:
    """At most ``n`` drawn rows."""
    return df.orderBy(row_hash(id_col, seed=seed)).limit(n)


def first_rows(df: DataFrame, n: int = 100, id_col: str = "sample_id") -> DataFrame:
    return df.orderBy(id_col).limit(n)


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def augment_minority(
    df: DataFrame, label: str = "label", id_col: str = "sample_id", seed: int = SEED, block: int = 10_000
) -> DataFrame:
    """Lift every class below the median class size to it; returns old rows and new ones.

    A new row takes a drawn row of its class (with replacement) and, on a drawn coin, replaces
    one word by a synonym or swaps two words. Columns: label, text, source_id, copy_no (0 for
    the old rows). The new row numbers are laid out in blocks, so that one class's new rows are
    made by many tasks, and meet their source rows on (label, position).
    """
    counts = class_counts(df, label)
    # one count per class goes into this percentile
    median = F.floor(counts.agg(F.percentile("n", F.lit(0.5))).scalar())
    short = broadcast_small(counts.filter(F.col("n") < median).withColumn("needed", median - F.col("n")))
    block_numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("needed") - 1) / block))
    blocks = short.select(label, "n", "needed", F.explode(block_numbers).alias("_block"))
    low = F.col("_block") * block + 1
    new_rows = (
        blocks.repartition(label, "_block")
        .select(label, "n", F.explode(F.sequence(low, F.least(low + (block - 1), F.col("needed")))).alias("copy_no"))
        .withColumn("rn", F.pmod(hash_int(row_hash(label, "copy_no", seed=f"{seed}pick")), F.col("n")) + 1)
        .drop("n")
    )
    minority = df.join(short.select(label), label, "left_semi").select(label, id_col, "text")
    ranked = hash_rank(minority.withColumn("_hash", row_hash(id_col, seed=seed)), [label], "_hash").drop("_hash")
    drawn = new_rows.join(ranked, [label, "rn"])
    coin = F.pmod(hash_int(row_hash(label, "copy_no", seed=f"{seed}coin")), F.lit(2))
    changed = F.when(coin == 0, synonym_replace("text")).otherwise(random_swap("text", [label, "copy_no"]))
    source = F.col(id_col).alias("source_id")
    made = drawn.select(label, changed.alias("text"), source, F.col("copy_no").cast("long").alias("copy_no"))
    kept = df.select(label, "text", source, F.lit(0).cast("long").alias("copy_no"))
    return kept.unionByName(made)


def class_weights(
    df: DataFrame, label: str = "label", expected: Sequence[int] | None = None, decimals: int | None = None
) -> DataFrame:
    """Balanced weight N / (k * n_c) per class, with the smallest and largest weight.

    Raises when an ``expected`` class has no rows.
    """
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    if expected is not None:
        present = {r[0] for r in counts.filter(F.col(label).isin(list(expected))).select(label).collect()}
        absent = sorted(set(expected) - present)
        if absent:
            raise ValueError(f"classes without rows: {absent}")
    # windows over one row per class
    over_all = W.partitionBy()
    weight = F.sum("n").over(over_all) / (F.count(F.lit(1)).over(over_all) * F.col("n"))
    weighted = counts.withColumn("weight", weight)
    shown = {
        "weight": F.col("weight"),
        "min_weight": F.min("weight").over(over_all),
        "max_weight": F.max("weight").over(over_all),
    }
    if decimals is not None:
        shown = {name: F.round(c, decimals) for name, c in shown.items()}
    return weighted.select(label, "n", *[c.alias(name) for name, c in shown.items()])


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Every row with the balanced weight of its class; null where the label is."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(broadcast_small(weights), label, "left")
