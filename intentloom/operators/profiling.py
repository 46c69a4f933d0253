"""Text and class profile: lengths, histograms, frequent words, keys, text drift descriptors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.functions.text import STOPWORDS, text_key, tokens, words
from intentloom.operators.sampling import class_counts


def text_lengths(df: DataFrame) -> DataFrame:
    return df.select("*", F.length("text").alias("text_length"), F.size(words("text")).alias("word_count"))


def length_stats(df: DataFrame, label: str = "label") -> DataFrame:
    sized = text_lengths(df.select(label, "text"))
    return sized.agg(
        F.countDistinct(label).alias("num_classes"),
        F.round(F.avg("text_length"), 6).alias("chars_mean"),
        F.min("text_length").cast("long").alias("chars_min"),
        F.max("text_length").cast("long").alias("chars_max"),
        F.round(F.stddev_samp("text_length"), 6).alias("chars_std"),
        F.round(F.avg("word_count"), 6).alias("words_mean"),
        F.min("word_count").cast("long").alias("words_min"),
        F.max("word_count").cast("long").alias("words_max"),
    )


def class_count_stats(df: DataFrame, label: str = "label_name") -> DataFrame:
    """Mean, smallest and largest class; on equal counts the first name in order is shown."""
    n, name = F.col("n"), F.col(label)
    return class_counts(df, label).agg(
        F.round(F.avg("n"), 6).alias("mean_count"),
        F.min("n").alias("min_count"),
        F.min_by(label, F.struct(n, name)).alias("min_class"),
        F.max("n").alias("max_count"),
        F.min_by(label, F.struct(-n, name)).alias("max_class"),
        F.round(F.max("n") / F.min("n"), 6).alias("imbalance_ratio"),
    )


def underrepresented_classes(df: DataFrame, label: str = "label_name", share: float = 0.8) -> DataFrame:
    """Class counts, a flag below ``share`` of the mean count, and how many are flagged."""
    over_all = W.partitionBy()  # one row per class
    flagged = class_counts(df, label).withColumn("underrepresented", F.col("n") < F.avg("n").over(over_all) * F.lit(share))
    return flagged.withColumn("n_flagged", F.count_if("underrepresented").over(over_all)).orderBy("n", label)


def length_histograms(df: DataFrame, char_bins: int = 50, word_bins: int = 30) -> DataFrame:
    """Equal-width histograms of characters and words, empty bins included, last bin closed."""
    measures = (("chars", "text_length", char_bins), ("words", "word_count", word_bins))
    entries = [F.struct(F.lit(m).alias("measure"), F.col(c).alias("x"), F.lit(b).alias("bins")) for m, c, b in measures]
    sized = text_lengths(df.select("text")).select(F.inline(F.array(*entries))).filter("x is not null")
    spans = sized.groupBy("measure", "bins").agg(
        F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi"), F.avg("x").alias("mean")
    )
    # two rows, one per measure; a single value gets a bin of width one around it
    flat = F.col("lo") == F.col("hi")
    spans = broadcast_small(
        spans.select(
            "measure", "bins", "mean",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            (F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / F.col("bins")).alias("width"),
        )
    )
    binned = (
        sized.drop("bins")
        .join(spans, "measure")
        .select("measure", F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.col("bins") - 1).alias("bin"))
        .groupBy("measure", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbers = F.sequence(F.lit(0).cast("long"), F.col("bins").cast("long") - 1)
    grid = spans.select("measure", "lo", "width", "mean", F.explode(numbers).alias("bin"))
    return grid.join(binned, ["measure", "bin"], "left").select(
        "measure",
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
        F.round(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 6).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.round("mean", 6).alias("mean"),
    )


def top_words(df: DataFrame, n: int = 30, stopwords: Sequence[str] = STOPWORDS, min_length: int = 3) -> DataFrame:
    """Most frequent lower-case words, punctuation kept; ties in word order."""
    return (
        df.select(F.explode(words(F.lower("text"))).alias("word"))
        .filter(~F.col("word").isin(list(stopwords)) & (F.length("word") >= min_length))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(n)
    )


def class_documents(
    df: DataFrame, label: str = "label_name", id_col: str = "sample_id", rows_per_part: int = 1_000
) -> DataFrame:
    """All texts of a class joined by spaces, in id order, as numbered parts.

    A class may hold a third of the data, so its document comes in parts of at most
    ``rows_per_part`` consecutive ids; joining the parts of a class by spaces gives it whole.
    """
    part = F.floor(F.col(id_col) / rows_per_part)
    ordered = F.sort_array(F.collect_list(F.struct(id_col, "text")))
    return df.groupBy(label, part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(ordered, lambda r: r["text"]), " ").alias("text"),
    )


def text_keys(df: DataFrame, id_col: str = "sample_id") -> DataFrame:
    return df.select(id_col, text_key("text").alias("text_key"))


def text_key_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct keys and duplicates."""
    copies = df.groupBy(text_key("text").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"),
    )


def text_overview(df: DataFrame, side: str = "side") -> DataFrame:
    """Mean text length, share of non-letters, and share of words the reference side never uses.

    A row's word share is additive over its words, so the words are summed per (side, word)
    before they meet the reference vocabulary: a word that fills a third of all texts is one row
    per side by then.
    """
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]", ""))
    size = F.length("text")
    basics = df.groupBy(side).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(size), 6).alias("mean_length"),
        F.round(F.avg(F.coalesce(F.try_divide(size - letters, size), F.lit(0.0))), 6).alias("mean_non_letter_share"),
    )
    # The share is made before the explosion, so that no word carries its whole text along; the outer
    # form keeps the optimizer from tokenising once more for a filter.
    toks = df.select(side, tokens("text").alias("t"))
    per_word = (
        toks.select(side, "t", F.try_divide(F.lit(1.0), F.size("t")).alias("share"))
        .select(side, "share", F.explode_outer("t").alias("word"))
        .filter("word is not null")
        .groupBy(side, "word")
        .agg(F.sum("share").alias("share"))
    )
    known = F.max(F.when(F.col(side) == "ref", True)).over(W.partitionBy("word"))  # one row per word and side
    unseen = per_word.withColumn("_known", known).filter("_known is null").groupBy(side).agg(F.sum("share").alias("s"))
    return basics.join(unseen, side, "left").select(
        side,
        "rows",
        "mean_length",
        "mean_non_letter_share",
        F.round(F.coalesce(F.col("s") / F.col("rows"), F.lit(0.0)), 6).alias("mean_oov_share"),
    )
