"""Row rules, class counts and request bounds: violations come back as rows, never as exceptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.functions.scoring import fallback_name

NUM_CLASSES = 77
MIN_SAMPLES_PER_CLASS = 10
MAX_TEXT = 512


def full_rules(num_classes: int = NUM_CLASSES, max_text: int = MAX_TEXT) -> dict[str, Column]:
    """Rules of the data-set check; each is true where a row breaks it."""
    text, label = F.col("text"), F.expr("try_cast(label as int)")
    return {
        "text_null": text.isNull(),
        "text_length": ~F.length(text).between(1, max_text),
        "label_null": F.col("label").isNull(),
        "label_type": F.col("label").isNotNull() & label.isNull(),
        "label_range": ~label.between(0, num_classes - 1),
    }


def min_rules(num_classes: int = NUM_CLASSES) -> dict[str, Column]:
    """Weaker rules of the training step: no upper bound on the text length."""
    text, label = F.col("text"), F.expr("try_cast(label as int)")
    return {
        "text_null": text.isNull(),
        "text_empty": F.length(text) < 1,
        "label_null": F.col("label").isNull(),
        "label_type": F.col("label").isNotNull() & label.isNull(),
        "label_range": ~label.between(0, num_classes - 1),
    }


def schema_violations(df: DataFrame, rules: Mapping[str, Column], id_col: str = "sample_id") -> DataFrame:
    """One row per broken rule. Labels are coerced to int; other columns are ignored."""
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return df.select(id_col, F.explode(broken).alias("rule"))


def class_distribution_check(
    df: DataFrame, min_samples: int = MIN_SAMPLES_PER_CLASS, expected: int = NUM_CLASSES
) -> DataFrame:
    """One row: classes present and missing, smallest and largest, classes that are too small.

    Missing classes are reported but do not fail the check.
    """
    counts = df.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    low = F.count_if(F.col("n") < min_samples)
    return counts.agg(
        F.count(F.lit(1)).alias("classes_present"),
        F.greatest(F.lit(expected) - F.count(F.lit(1)), F.lit(0)).cast("long").alias("classes_missing"),
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
        low.alias("low_classes"),
        (low == 0).alias("passed"),
    )


def validate_split(df: DataFrame, split_name: str, rules: Mapping[str, Column], **dist) -> DataFrame:
    """Both checks in one row; a weak class distribution is reported but does not fail the split."""
    bad_rows = F.coalesce(F.array_max(F.array(*[bad.cast("int") for bad in rules.values()])), F.lit(0))
    schema = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(bad_rows).cast("long").alias("bad_rows"))
    spread = class_distribution_check(df, **dist).select(F.col("passed").alias("d"))
    return schema.select(
        F.lit(split_name).alias("split"),
        "rows",
        F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"),
        (F.coalesce("bad_rows", F.lit(0)) == 0).alias("schema_passed"),
        spread.scalar().alias("distribution_passed"),
    )


def text_requests(df: DataFrame, id_col: str, max_text: int = 10_000) -> DataFrame:
    """Single requests: text of 1..max_text characters, white space only included."""
    size = F.length("text")
    reason = (
        F.when(size.isNull(), "missing").when(size < 1, "too_short").when(size > max_text, "too_long").otherwise("ok")
    )
    return df.select(F.col(id_col).cast("string").alias("request_id"), reason.alias("reason"))


def batch_requests(df: DataFrame, batch_col: str, max_batch: int = 100) -> DataFrame:
    """Batch requests: 1..max_batch texts; the texts themselves are not bounded."""
    sizes = df.groupBy(batch_col).agg(F.count("text").alias("n"))
    reason = F.when(F.col("n") < 1, "too_short").when(F.col("n") > max_batch, "too_long").otherwise("ok")
    return sizes.select(F.col(batch_col).cast("string").alias("request_id"), reason.alias("reason"))


def feedback_requests(df: DataFrame, id_col: str, max_comment: int = 1_000) -> DataFrame:
    """Corrections: label >= 0, comment of at most max_comment characters if there is one."""
    reason = (
        F.when(F.coalesce(F.col("correct_label") < 0, F.lit(True)), "bad_label")
        .when(F.length("comment") > max_comment, "too_long")
        .otherwise("ok")
    )
    return df.select(F.col(id_col).cast("string").alias("request_id"), reason.alias("reason"))


def request_bounds(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """Accept or reject every request, with the reason."""
    parts = [
        df.select(F.lit(kind).alias("kind"), "request_id", (F.col("reason") == "ok").alias("accepted"), "reason")
        for kind, df in kinds.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def split_audit(
    df: DataFrame, shares: Mapping[str, float], num_classes: int = NUM_CLASSES, tolerance: float = 0.05
) -> DataFrame:
    """Checks on a split table (sample_id, text, label, split): one row per check.

    Shares near their targets, no id in two splits, every class in every split, no empty text,
    labels in range. Two aggregations: one by id (uniform), one by (split, label).
    """
    total = F.sum("n").over(W.partitionBy())  # one row per split
    cells = df.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.length("text"), F.lit(0)) < 1).alias("empty"),
    )
    by_split = cells.groupBy("split").agg(
        F.sum("n").alias("n"),
        F.sum("empty").alias("empty"),
        F.count("label").alias("classes"),
        F.count_if(~F.col("label").between(0, num_classes - 1) | F.col("label").isNull()).alias("out_of_range"),
    )
    classes = cells.agg(F.countDistinct("label")).scalar()
    target = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("split"))
    by_split = by_split.withColumn("gap", F.abs(F.col("n") / total - target))
    gap = F.col("gap")

    def check(name: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.concat(F.lit(name + ":"), F.col("split")).alias("check"),
            value.cast("double").alias("value"),
            passed.alias("passed"),
        )

    per_split = by_split.select(
        F.inline(
            F.array(
                check("share_gap", F.round(gap, 6), F.coalesce(gap <= tolerance, F.lit(False))),
                check("missing_classes", classes - F.col("classes"), classes == F.col("classes")),
                check("empty_texts", F.col("empty"), F.col("empty") == 0),
                check("labels_out_of_range", F.col("out_of_range"), F.col("out_of_range") == 0),
            )
        )
    )
    shared = (
        df.select("sample_id", "split")
        .repartition("sample_id")  # both groupings below stay in place
        .groupBy("sample_id", "split")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("splits"))
        .agg(F.count_if(F.col("splits") > 1).alias("ids"))
        .select(
            F.lit("shared_ids").alias("check"),
            F.col("ids").cast("double").alias("value"),
            (F.col("ids") == 0).alias("passed"),
        )
    )
    return per_split.unionByName(shared)


def label_lookup(df: DataFrame, dictionary: DataFrame, label_col: str = "label", out: str = "label_name") -> DataFrame:
    """Attach the class name; ``class_<n>`` where the dictionary has none."""
    names = dictionary.select(F.col("label").alias(label_col), F.col("label_name").alias("_name"))
    return (
        df.join(broadcast_small(names), label_col, "left")
        .withColumn(out, fallback_name("_name", label_col))
        .drop("_name")
    )


def name_lookup(df: DataFrame, dictionary: DataFrame, name_col: str = "label_name", out: str = "label") -> DataFrame:
    """The inverse map: class number for a name, null for an unknown one."""
    numbers = dictionary.select(F.col("label_name").alias(name_col), F.col("label").alias(out))
    return df.join(broadcast_small(numbers), name_col, "left")


def min_samples_guard(df: DataFrame, min_samples: int = 50) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("rows"), F.lit(min_samples).cast("long").alias("min_samples"), (n < min_samples).alias("too_few"))


def nan_logit_check(df: DataFrame, logits: str = "logits") -> DataFrame:
    """True when no score of any row is NaN (or null)."""
    bad = F.exists(logits, lambda v: F.isnan(v) | v.isNull())
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("nan_rows"),
        (F.count_if(bad) == 0).alias("passed"),
    )


def shared_columns(reference: DataFrame, current: DataFrame, skip: Sequence[str] = ("created_at",)) -> DataFrame:
    """Both tables cut to the columns they share (sorted, without ``skip``), marked by side.

    With no shared column, one row that says so.
    """
    common = sorted((set(reference.columns) & set(current.columns)) - set(skip))
    if not common:
        return reference.sparkSession.range(1).select(F.lit("no_shared_columns").alias("error"))
    return reference.select(*common, F.lit("ref").alias("side")).unionByName(
        current.select(*common, F.lit("cur").alias("side"))
    )


def history_series(history: DataFrame, series: Sequence[str], best_by: str) -> DataFrame:
    """(series, epoch, value) of the non-null points, and whether the epoch is the best by ``best_by``."""
    # one row per epoch: tiny next to the data the run was trained on
    best = history.filter(F.col(best_by).isNotNull()).agg(F.max_by("epoch", F.struct(best_by, -F.col("epoch")))).scalar()
    points = F.array(*[F.struct(F.lit(s).alias("series"), F.col(s).cast("double").alias("value")) for s in series])
    return (
        history.select("epoch", F.inline(points))
        .filter("value is not null")
        .select("series", "epoch", "value", (F.col("epoch") == best).alias("best_epoch"))
    )
