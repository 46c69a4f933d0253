"""Confusion counts, per-class and averaged metrics, model ranking and release gates.

Everything after the (true, predicted) count works on at most classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small

AVERAGES = ("macro", "micro", "weighted")
METRICS = ["accuracy"] + [f"{m}_{a}" for a in AVERAGES for m in ("precision", "recall", "f1")]


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(pairs: DataFrame, true: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (true, predicted) label; pairs without either label are no evaluation."""
    labelled = pairs.filter(F.col(true).isNotNull() & F.col(pred).isNotNull())
    return labelled.groupBy(*by, F.col(true).alias("true_label"), F.col(pred).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(pairs: DataFrame, true: str = "label", pred: str = "predicted_label") -> DataFrame:
    """One row per cell over the labels seen on either side, empty cells included."""
    counts = broadcast_small(confusion_counts(pairs, true, pred))  # the pairs are scored once
    seen = counts.select(F.explode(F.array("true_label", "predicted_label")).alias("l"))
    labels = seen.agg(F.collect_set("l").alias("labels"))  # one entry per class
    grid = labels.select("labels", F.explode("labels").alias("true_label")).select(
        "true_label", F.explode("labels").alias("predicted_label")
    )
    return grid.join(counts, ["true_label", "predicted_label"], "left").select(
        "true_label", "predicted_label", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_wide(matrix: DataFrame, labels: Sequence[int]) -> DataFrame:
    """The matrix with one column per predicted label."""
    return matrix.groupBy("true_label").pivot("predicted_label", list(labels)).agg(F.first("n")).orderBy("true_label")


def per_class_report(
    pairs: DataFrame, true: str = "label", pred: str = "predicted_label", by: Sequence[str] = (), decimals: int | None = 6
) -> DataFrame:
    """Precision, recall, F1 and support per label seen on either side; 0 on zero division."""
    counts = confusion_counts(pairs, true, pred, by)
    hit = F.col("true_label") == F.col("predicted_label")
    zero = F.lit(0).cast("long")

    def role(label: Column, tp: Column, support: Column, predicted: Column) -> Column:
        return F.struct(label.alias("label"), tp.alias("tp"), support.alias("support"), predicted.alias("predicted"))

    n = F.col("n")
    roles = F.array(
        role(F.col("true_label"), F.when(hit, n).otherwise(zero), n, zero), role(F.col("predicted_label"), zero, zero, n)
    )
    sums = counts.select(*by, F.inline(roles)).groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )
    shown = (lambda c: c) if decimals is None else (lambda c: F.round(c, decimals))
    return sums.select(
        *by,
        "label",
        shown(ratio(F.col("tp"), F.col("predicted"))).alias("precision"),
        shown(ratio(F.col("tp"), F.col("support"))).alias("recall"),
        shown(ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))).alias("f1_score"),
        "support",
        "tp",
        "predicted",
    )


def classification_metrics(
    pairs: DataFrame, true: str = "label", pred: str = "predicted_label", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, and precision, recall and F1 as macro, micro and support-weighted averages."""
    report = per_class_report(pairs, true, pred, by, decimals=None)
    tp, support, predicted = F.sum("tp"), F.sum("support"), F.sum("predicted")
    micro = {"precision": ratio(tp, predicted), "recall": ratio(tp, support), "f1": ratio(2 * tp, predicted + support)}
    cols = [ratio(tp, support).alias("accuracy")]
    for avg in AVERAGES:
        for metric, source in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score")):
            if avg == "macro":
                value = F.avg(source)
            elif avg == "micro":
                value = micro[metric]
            else:
                value = ratio(F.sum(F.col(source) * F.col("support")), support)
            cols.append(value.alias(f"{metric}_{avg}"))
    aggregated = report.groupBy(*by).agg(*cols)
    return aggregated.select(*by, *[F.round(c, 6).alias(c) for c in METRICS])


def metrics_long(metrics: DataFrame, by: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Wide metrics as (metric, value) rows, names with an optional prefix."""
    names = [c for c in metrics.columns if c not in by]
    long = metrics.unpivot(list(by), names, "metric", "value")
    return long.withColumn("metric", F.concat(F.lit(prefix), F.col("metric")))


def model_comparison(metrics: DataFrame, model: str = "model") -> DataFrame:
    """Models ranked by macro F1, best first."""
    best_first = W.orderBy(F.desc("f1_macro"), model)  # one row per model
    return metrics.select(F.row_number().over(best_first).alias("rank"), model, *METRICS)


def macro_f1_from_report(report: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Macro F1 recomputed as the mean of per-class F1."""
    return report.groupBy(*by).agg(F.round(F.avg("f1_score"), 9).alias("f1_macro"))


def best_run(runs: DataFrame, run_name: str | None = None) -> DataFrame:
    """Per experiment the run with the highest macro F1, of one run name if given; ties by run id."""
    chosen = runs if run_name is None else runs.filter(F.col("run_name") == run_name)
    rest = [c for c in runs.columns if c != "experiment"]
    # the winner's row is carried through the partial aggregation: no sort, no window
    return (
        chosen.filter("f1_macro is not null")
        .groupBy("experiment")
        .agg(F.min_by(F.struct(*rest), F.struct(-F.col("f1_macro"), F.col("run_id"))).alias("r"))
        .select("experiment", "r.*")
    )


def variant_latency(log: DataFrame, base: str, variant: str = "variant", latency: str = "latency_ms") -> DataFrame:
    """Mean latency per variant and the speed-up against the base variant, to 2 decimals."""
    means = log.groupBy(variant).agg(F.avg(latency).alias("m"), F.count(latency).alias("n_samples"))
    base_mean = F.max(F.when(F.col(variant) == base, F.col("m"))).over(W.partitionBy())  # one row per variant
    return means.select(
        variant,
        "n_samples",
        F.round("m", 6).alias("mean_latency_ms"),
        F.round(F.try_divide(base_mean, F.col("m")), 2).alias("speedup"),
    )


def validation_gate(
    metrics: DataFrame,
    latency: DataFrame,
    nan_check: DataFrame,
    min_accuracy: float = 0.90,
    min_f1: float = 0.90,
    max_latency_ms: float = 100.0,
) -> DataFrame:
    """One row per check with its pass flag, and whether all passed.

    ``metrics`` and ``nan_check`` are one-row tables; ``latency`` is a log (no rows counts as 0 ms).
    """
    mean_latency = F.lit(latency.agg(F.coalesce(F.avg("latency_ms"), F.lit(0.0))).first()[0])
    clean = F.lit(float(nan_check.select("passed").first()[0]))

    def check(name: str, actual: Column, limit: float, sign: str) -> Column:
        passed = actual >= limit if sign == ">=" else actual <= limit
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.round(actual, 6).alias("actual_value"),
            F.lit(limit).alias("threshold"),
            F.lit(sign).alias("comparison"),
            passed.alias("passed"),
        )

    checks = F.array(
        check("accuracy", F.col("accuracy"), min_accuracy, ">="),
        check("f1_score", F.col("f1_weighted"), min_f1, ">="),
        check("latency_ms", mean_latency, max_latency_ms, "<="),
        check("no_nan_predictions", clean, 1.0, ">="),
    )
    listed = metrics.select(checks.alias("checks"))
    return listed.select(F.forall("checks", lambda c: c["passed"]).alias("all_passed"), F.inline("checks"))


def promotion_gate(metrics: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Promote at or above the threshold of weighted F1."""
    f1 = F.coalesce("f1_weighted", F.lit(0.0))
    status = F.when(f1 < threshold, "NOT_REGISTERED").otherwise("REGISTERED")
    return metrics.select(f1.alias("f1_weighted"), F.lit(threshold).alias("threshold"), status.alias("status"))
