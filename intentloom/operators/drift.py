"""Distribution drift between a reference side and a current side, alerts and the retrain decision."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.functions.scale import RANGE_ROWS, ranged, running_counts

DRIFT_SHARE_ALERT = 0.15
CONFIDENCE_DROP_ALERT = 0.05
LABEL_SHIFT_ALERT = 0.10



def _sides() -> tuple[Column, Column]:
    ref = (F.col("side") == "ref").cast("long")
    return ref.alias("ref"), (1 - ref).alias("cur")


def number_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, v, ref, cur): how often each number occurs on each side. Null and NaN are no values."""
    ref, cur = _sides()
    entries = [F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")) for c in cols]
    long = df.select("side", F.inline(F.array(*entries))).filter("v is not null")
    return long.groupBy("column", "v").agg(F.sum(ref).alias("ref"), F.sum(cur).alias("cur"))


def numeric_drift(
    df: DataFrame,
    cols: Sequence[str],
    p_limit: float = 0.05,
    distance_limit: float = 0.1,
    rule: str = "distance",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per numeric column: Kolmogorov-Smirnov statistic and p-value, Wasserstein-1 / std(reference).

    Drift rule, whatever the number of rows: normalised distance >= ``distance_limit``, or with
    ``rule="p"`` p < ``p_limit``. Null and NaN are no values: ``n_ref`` and ``n_cur`` count the
    rest. With an empty side the statistics are null and nothing drifted.
    """
    return drift_of_numbers(number_counts(df, cols), p_limit, distance_limit, rule, range_rows)


def drift_of_numbers(
    counts: DataFrame, p_limit: float = 0.05, distance_limit: float = 0.1, rule: str = "distance", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``numeric_drift`` from counted values (column, v, ref, cur).

    Both statistics come from one pass over the distinct values in order, in ranges of about
    ``range_rows`` of them.
    """
    counts = ranged(counts.select("column", "v", "ref", "cur"), ["column"], "v", "b", range_rows)
    counted = running_counts(counts, ["column"], "b", "v", ["ref", "cur"])
    means = counts.groupBy("column").agg(F.try_divide(F.sum(F.col("v") * F.col("ref")), F.sum("ref")).alias("mean"), F.sum("ref").alias("n"))
    off = F.col("v") - F.col("mean")
    spreads = counts.join(F.broadcast(means), "column").groupBy("column")  # one row per column
    spreads = spreads.agg(F.sqrt(F.try_divide(F.sum(off * off * F.col("ref")), F.max("n"))).alias("std_ref"))
    gap = F.abs(F.try_divide("cum_ref", "all_ref") - F.try_divide("cum_cur", "all_cur"))
    stats = counted.groupBy("column").agg(
        F.max("all_ref").alias("n_ref"),
        F.max("all_cur").alias("n_cur"),
        F.max(gap).alias("ks"),
        F.sum(gap * (F.col("next_value") - F.col("v"))).alias("w1"),
    )
    joined = stats.join(F.broadcast(spreads), "column")
    n = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    lam = F.sqrt(n) * F.col("ks")
    # asymptotic p-value: 2 * sum over j of (-1)^(j-1) exp(-2 j^2 lambda^2)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0).cast("double"),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.col("_e") * j * j),
    )
    tested = joined.withColumn("_e", -2.0 * lam * lam).withColumn(
        "p",
        F.when(lam < 0.04, F.lit(1.0)).when(lam.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
    )
    distance = F.try_divide(F.col("w1"), F.col("std_ref"))
    drifted = {"p": F.col("p") < p_limit, "distance": distance >= distance_limit}[rule]
    return tested.select(
        "column",
        "n_ref",
        "n_cur",
        F.round("ks", 6).alias("ks_statistic"),
        F.round("p", 6).alias("ks_p_value"),
        F.round(distance, 6).alias("wasserstein_norm"),
        F.coalesce(drifted, F.lit(False)).alias("drifted"),
    )


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, v, ref, cur): how often each value occurs on each side. Null is no value."""
    ref, cur = _sides()
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols]
    long = df.select("side", F.inline(F.array(*entries))).filter("v is not null")
    return long.groupBy("column", "v").agg(F.sum(ref).alias("ref"), F.sum(cur).alias("cur"))


def categorical_drift(df: DataFrame, cols: Sequence[str], js_limit: float = 0.1, floor: float = 1e-4) -> DataFrame:
    """Per categorical column over the union of values: Jensen-Shannon distance, chi-square, PSI.

    Natural logarithm; an empty share counts as ``floor`` in the PSI. With an empty side all three
    are null and nothing drifted. Counting both sides in one
    grouped pass makes the union; no side is joined to the other.
    """
    return drift_of_categories(category_counts(df, cols), js_limit, floor)


def drift_of_categories(counts: DataFrame, js_limit: float = 0.1, floor: float = 1e-4) -> DataFrame:
    """``categorical_drift`` from counted values (column, v, ref, cur)."""
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    joined = counts.join(F.broadcast(totals), "column")  # one row per column
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")
    m = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / m)).otherwise(0.0)

    fp, fq = F.greatest(p, F.lit(floor)), F.greatest(q, F.lit(floor))
    expected_ref = (F.col("ref") + F.col("cur")) * F.col("n_ref") / (F.col("n_ref") + F.col("n_cur"))
    expected_cur = (F.col("ref") + F.col("cur")) * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
    chi = F.try_divide(F.pow(F.col("ref") - expected_ref, 2), expected_ref) + F.try_divide(
        F.pow(F.col("cur") - expected_cur, 2), expected_cur
    )
    stats = joined.groupBy("column", "n_ref", "n_cur").agg(
        F.count(F.lit(1)).alias("categories"),
        F.sqrt(F.greatest(F.sum((part(p) + part(q)) / 2), F.lit(0.0))).alias("js"),
        F.sum(chi).alias("chi"),
        F.sum((fq - fp) * F.log(fq / fp)).alias("psi"),
    )
    comparable = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return stats.select(
        "column",
        "n_ref",
        "n_cur",
        "categories",
        F.when(comparable, F.round("js", 6)).alias("js_distance"),
        F.when(comparable, F.round("chi", 6)).alias("chi_square"),
        F.when(comparable, F.round("psi", 6)).alias("psi"),
        (comparable & (F.col("js") >= js_limit)).alias("drifted"),
    )


def drift_summary(*per_column: DataFrame, share_limit: float = 0.5) -> DataFrame:
    """One row: columns, drifted columns and their share, the data-set flag and the sorted names."""
    flags = reduce(DataFrame.unionByName, [part.select("column", "drifted") for part in per_column])
    hit = F.count_if("drifted")
    share = F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(0.0))
    return flags.agg(
        F.count(F.lit(1)).alias("number_of_columns"),
        hit.alias("number_of_drifted_columns"),
        F.round(share, 6).alias("share_of_drifted_columns"),
        (share >= share_limit).alias("drift_detected"),
        F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_columns"),
    )


def confidence_drop(df: DataFrame, limit: float = CONFIDENCE_DROP_ALERT) -> DataFrame:
    """Mean confidence per side, the drop, and whether it is over the limit."""
    ref = F.avg(F.when(F.col("side") == "ref", F.col("confidence")))
    cur = F.avg(F.when(F.col("side") == "cur", F.col("confidence")))
    return df.agg(
        ref.alias("ref_confidence"),
        cur.alias("cur_confidence"),
        (ref - cur).alias("drop"),
        F.coalesce(ref - cur > limit, F.lit(False)).alias("alert"),
    )


def drop_of_confidence(counts: DataFrame, limit: float = CONFIDENCE_DROP_ALERT) -> DataFrame:
    """``confidence_drop`` from the counted values (v, ref, cur) of one column."""
    ref, cur = (F.try_divide(F.sum(F.col("v") * F.col(s)), F.sum(s)) for s in ("ref", "cur"))
    both = counts.agg(ref.alias("ref_confidence"), cur.alias("cur_confidence"))
    drop = F.col("ref_confidence") - F.col("cur_confidence")
    return both.select("ref_confidence", "cur_confidence", drop.alias("drop"), F.coalesce(drop > limit, F.lit(False)).alias("alert"))


def label_distribution(df: DataFrame, label: str = "predicted_label") -> DataFrame:
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (F.col("n") / total).alias("share"))


def label_shift(df: DataFrame, label: str = "predicted_label", limit: float = LABEL_SHIFT_ALERT) -> DataFrame:
    """Largest change of a label's share between the sides, over all labels of either side."""
    return shift_of_labels(category_counts(df, [label]), limit)


def shift_of_labels(counts: DataFrame, limit: float = LABEL_SHIFT_ALERT) -> DataFrame:
    """``label_shift`` from the counted values of one column."""
    totals = counts.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    shares = counts.join(F.broadcast(totals), "column")
    ref, cur = (F.coalesce(F.try_divide(s, f"n_{s}"), F.lit(0.0)) for s in ("ref", "cur"))
    gap = F.abs(ref - cur)
    return shares.agg(F.max(gap).alias("max_shift"), F.coalesce(F.max(gap) > limit, F.lit(False)).alias("alert"))


def _percent(x: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", x * 100)


def alert_check(
    summary: DataFrame,
    drop: DataFrame | None,
    shift: DataFrame | None,
    drift_limit: float = DRIFT_SHARE_ALERT,
    drop_limit: float = CONFIDENCE_DROP_ALERT,
    shift_limit: float = LABEL_SHIFT_ALERT,
) -> DataFrame:
    """One row: triggered alerts (code, value, message) in fixed order, their count, a flag.

    ``drop`` or ``shift`` is None where the tables lack the column.
    """
    shape = "struct<ref_confidence:double,cur_confidence:double,drop:double>"
    drop_row, shift_row = F.lit(None).cast(shape), F.lit(None).cast("double")
    if drop is not None:
        drop_row = drop.select(F.struct("ref_confidence", "cur_confidence", "drop")).scalar()
    if shift is not None:
        shift_row = shift.select("max_shift").scalar()
    base = summary.select(
        F.col("share_of_drifted_columns").alias("share"),
        "drift_detected",
        drop_row.alias("d"),
        shift_row.alias("shift"),
    )

    def alert(code: str, value: Column, limit: float, message: Column) -> Column:
        return F.when(
            value > limit, F.struct(F.lit(code).alias("code"), value.alias("value"), message.alias("message"))
        )

    d = F.col("d")
    alerts = F.array_compact(
        F.array(
            alert(
                "DATA_DRIFT",
                F.col("share"),
                drift_limit,
                F.concat(
                    F.lit("DATA_DRIFT: "),
                    _percent(F.col("share")),
                    F.lit(f" columns drifted (threshold: {drift_limit:.2%})"),
                ),
            ),
            alert(
                "CONFIDENCE_DROP",
                d["drop"],
                drop_limit,
                F.format_string(
                    f"CONFIDENCE_DROP: %.4f (ref=%.4f, cur=%.4f, threshold={drop_limit})",
                    d["drop"], d["ref_confidence"], d["cur_confidence"],
                ),
            ),
            alert(
                "LABEL_SHIFT",
                F.col("shift"),
                shift_limit,
                F.concat(F.lit("LABEL_SHIFT: max single-label shift "), _percent(F.col("shift"))),
            ),
        )
    )
    return base.select("drift_detected", alerts.alias("alerts")).select(
        "drift_detected",
        "alerts",
        F.size("alerts").alias("alert_count"),
        (F.size("alerts") > 0).alias("needs_attention"),
    )


def retrain_trigger(checked: DataFrame) -> DataFrame:
    """Retrain when the data set drifted or any alert fired, with the reasons in order."""
    drifted = F.coalesce("drift_detected", F.lit(False))
    first = F.when(drifted, F.array(F.lit("dataset_drift_detected"))).otherwise(F.array().cast("array<string>"))
    return checked.select(
        (drifted | F.col("needs_attention")).alias("should_retrain"),
        F.concat(first, F.transform("alerts", lambda a: a["message"])).alias("reasons"),
        drifted.alias("drift_detected"),
        "alert_count",
    )
