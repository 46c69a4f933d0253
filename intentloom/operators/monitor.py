"""Service metrics over the request log: windows, rates, histograms, alerts, corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.functions.scale import exact_percentiles
from intentloom.functions.scoring import fallback_name

# Trailing windows in seconds.
WINDOWS = {"1min": 60, "5min": 300, "1hour": 3600}

# Alert limits.
CONFIDENCE_LIMIT = 0.7
LATENCY_P95_LIMIT = 100.0
ERROR_RATE_LIMIT = 0.05

LATENCY_BOUNDS = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0)
CONFIDENCE_BOUNDS = tuple(i / 10 for i in range(1, 11))


def seconds_before(ts: Column, seconds: int) -> Column:
    return ts - F.expr(f"interval {seconds} seconds")


def latest(log: DataFrame, ts: str = "ts") -> Column:
    """The newest instant of the log, as a literal, so that filters on it reach the scan."""
    newest = log.agg(F.max(ts).cast("string")).first()[0]
    return F.lit(newest).cast(dict(log.dtypes)[ts])


def retention_trim(log: DataFrame, seconds: int = WINDOWS["1hour"], as_of: Column | None = None) -> DataFrame:
    """Rows no older than ``seconds`` before ``as_of`` (default: the newest row)."""
    now = latest(log) if as_of is None else as_of
    return log.filter(F.col("ts") >= seconds_before(now, seconds))


def window_summary(log: DataFrame, windows: Mapping[str, int] = WINDOWS, as_of: Column | None = None) -> DataFrame:
    """Latency and confidence over trailing windows ending at ``as_of``; zeros for an empty window."""
    now = latest(log) if as_of is None else as_of
    spark = log.sparkSession
    recent = retention_trim(log.select("ts", "latency_ms", "confidence"), max(windows.values()), now)
    inside = F.array_compact(
        F.array(*[F.when(F.col("ts") >= seconds_before(now, s), F.lit(w)) for w, s in windows.items()])
    )
    rows = recent.select(F.explode(inside).alias("window"), "latency_ms", "confidence")
    basics = rows.groupBy("window").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("latency_ms").alias("latency_mean"),
        F.avg("confidence").alias("confidence_mean"),
        F.min("confidence").alias("confidence_min"),
    )
    spots = exact_percentiles(rows, ["window"], "latency_ms", {"latency_p50": 0.5, "latency_p95": 0.95})
    names = spark.createDataFrame(list(windows.items()), "window string, seconds int")
    joined = names.join(basics, "window", "left").join(spots, "window", "left")

    def shown(c: str) -> Column:
        return F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c)

    return joined.select(
        "window",
        F.coalesce("count", F.lit(0)).alias("count"),
        *[shown(c) for c in ("latency_mean", "latency_p50", "latency_p95", "confidence_mean", "confidence_min")],
        F.round(F.coalesce("count", F.lit(0)) / F.col("seconds"), 6).alias("throughput_per_sec"),
    )


def threshold_alerts(
    metrics: DataFrame,
    carry: Sequence[str] = (),
    confidence_limit: float = CONFIDENCE_LIMIT,
    latency_limit: float = LATENCY_P95_LIMIT,
    error_limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    """Alerts of each metrics row (drift_detected, mean_confidence, error_rate, latency_p95).

    A missing column or null metric raises no alert; the limits themselves do not either.
    """

    def metric(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in metrics.columns else F.lit(None).cast(kind)

    drift, confidence = metric("drift_detected", "boolean"), metric("mean_confidence", "double")
    errors, p95 = metric("error_rate", "double"), metric("latency_p95", "double")

    def alert(hit: Column, kind: str, severity: str, message: Column, value: Column, limit: float) -> Column:
        return F.when(
            hit,
            F.struct(
                F.lit(kind).alias("type"),
                F.lit(severity).alias("severity"),
                message.alias("message"),
                value.alias("value"),
                F.lit(limit).alias("threshold"),
            ),
        )

    alerts = F.array(
        alert(drift, "drift_detected", "critical", F.lit("Data drift detected in production predictions."), F.lit(1.0), 0.0),
        alert(
            confidence < confidence_limit, "confidence_drop", "warning",
            F.format_string(f"Mean confidence %.3f below threshold {confidence_limit}.", confidence),
            confidence, confidence_limit,
        ),
        alert(
            errors > error_limit, "error_rate_spike", "critical",
            F.format_string(f"Error rate %.3f%% exceeds threshold {error_limit * 100:.3f}%%.", errors * 100),
            errors, error_limit,
        ),
        alert(
            p95 > latency_limit, "latency_spike", "warning",
            F.format_string(f"P95 latency %.1fms exceeds threshold {latency_limit:.1f}ms.", p95),
            p95, latency_limit,
        ),
    )
    return metrics.select(*carry, F.inline(F.array_compact(alerts)))


def feedback_stats(feedback: DataFrame, top: int = 10) -> DataFrame:
    """The most corrected classes with the total number of corrections; ties by label."""
    counts = feedback.groupBy("correct_label", "correct_label_name").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    name = fallback_name(F.nullif(F.col("correct_label_name"), F.lit("")), "correct_label")
    return (
        counts.orderBy(F.desc("n"), "correct_label", "correct_label_name")
        .limit(top)
        .select(
            F.col("correct_label").alias("label"),
            name.alias("label_name"),
            F.col("n").alias("count"),
            total.alias("total_corrections"),
        )
    )


def recent_audit(audit: DataFrame, limit: int = 50) -> DataFrame:
    """The newest audit rows, ISO time."""
    iso = F.coalesce(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(""))
    return audit.orderBy(F.desc("id")).limit(limit).select("id", "action", "details", iso.alias("created_at"))


def tumbling(minutes: int, ts: str = "ts") -> Column:
    return F.window(ts, f"{minutes} minutes")["start"]


def request_rate(log: DataFrame, minutes: int = 1) -> DataFrame:
    """Requests per second per window, in total (method null) and by method."""
    counts = log.groupBy(tumbling(minutes).alias("window_start"), "method").agg(F.count(F.lit(1)).alias("n"))
    both = counts.groupingSets(
        [("window_start",), ("window_start", "method")], "window_start", "method"
    ).agg(F.sum("n").alias("requests"), F.grouping("method").alias("total"))
    return both.select(
        "window_start", "method", (F.col("total") == 1).alias("is_total"), "requests",
        F.round(F.col("requests") / (60.0 * minutes), 6).alias("per_second"),
    )


def error_rate(log: DataFrame, minutes: int = 1) -> DataFrame:
    """Share of requests with status 4xx or 5xx per window."""
    bad = F.col("status").between(400, 599).cast("double")
    return log.groupBy(tumbling(minutes).alias("window_start")).agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.avg(bad), 6).alias("error_rate")
    )


def request_counter(log: DataFrame) -> DataFrame:
    return log.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def cumulative_buckets(log: DataFrame, by: Sequence[Column | str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Wide cumulative histogram: ``le_0..`` count values up to each bound, ``total`` all of them."""
    counts = [F.count_if(F.col(value) <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return log.groupBy(*by).agg(*counts, F.count(value).alias("total"), F.avg(value).alias("mean"))


def request_histogram(log: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative latency buckets per method and endpoint; the last bound is +Inf."""
    wide = cumulative_buckets(log, ["method", "endpoint"], "latency_ms", bounds)
    cells = [F.struct(F.lit(str(b)).alias("le"), F.col(f"le_{i}").alias("n")) for i, b in enumerate(bounds)]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("n")))
    return wide.select("method", "endpoint", F.inline(F.array(*cells)))


def bucket_quantile(q: float, bounds: Sequence[float]) -> Column:
    """Quantile from cumulative buckets, linear inside the bucket; the last bound beyond it."""
    rank = F.lit(q) * F.col("total")
    value = F.lit(float(bounds[-1]))
    for i in range(len(bounds) - 1, -1, -1):
        upto = F.col(f"le_{i}")
        before = F.col(f"le_{i - 1}") if i else F.lit(0)
        low = float(bounds[i - 1]) if i else 0.0
        inside = F.lit(low) + (float(bounds[i]) - low) * F.coalesce(F.try_divide(rank - before, upto - before), F.lit(0.0))
        value = F.when(upto >= rank, inside).otherwise(value)
    return F.when(F.col("total") > 0, value)


def bucket_quantiles(
    log: DataFrame,
    value: str = "latency_ms",
    bounds: Sequence[float] = LATENCY_BOUNDS,
    quantiles: Sequence[float] = (0.5, 0.95, 0.99),
    minutes: int = 5,
) -> DataFrame:
    """Estimated quantiles and the mean per window, from one map-side-combined histogram."""
    wide = cumulative_buckets(log, [tumbling(minutes).alias("window_start")], value, bounds)
    picks = [F.round(bucket_quantile(q, bounds), 6).alias(f"p{int(q * 100)}") for q in quantiles]
    return wide.select("window_start", F.col("total").alias("n"), *picks, F.round("mean", 6).alias("mean"))


def confidence_windows(log: DataFrame, bounds: Sequence[float] = CONFIDENCE_BOUNDS, minutes: int = 5) -> DataFrame:
    return bucket_quantiles(log, "confidence", bounds, (0.5, 0.95), minutes)


def rate_limit_audit(log: DataFrame, limit: int = 100, client: str = "client_id", minutes: int = 1) -> DataFrame:
    """Clients over their limit, per fixed window."""
    counts = log.groupBy(client, tumbling(minutes).alias("window_start")).agg(F.count(F.lit(1)).alias("requests"))
    return counts.filter(F.col("requests") > limit)
