"""Drift, alerts and service metrics over the request log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from intentloom.functions.scale import exact_percentiles
from intentloom.functions.text import text_key
from intentloom.operators import dedup, drift, monitor
from intentloom.plans.fixtures import with_views
from intentloom.sources import io
from intentloom.sources import tables as t

NUMERIC = ["confidence", "latency_ms"]
CATEGORICAL = ["predicted_label_name", "method", "endpoint"]


def at(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def numeric_drift(spark, d):
    return drift.numeric_drift(t.ref_cur(spark, d), NUMERIC)


def categorical_drift(spark, d):
    return drift.categorical_drift(t.ref_cur(spark, d), CATEGORICAL)


def shifted(spark, d):
    """The whole log with a current side that did move: values of all its rows are changed, none is left out."""
    return moved(t.ref_cur(spark, d), F.col("side") == "cur")


def moved(log, rows: Column):
    """In ``rows``: confidences halved, latencies doubled, clicks called errors and sign-ups purchases."""
    label = F.when(F.col("predicted_label") == 0, 1).when(F.col("predicted_label") == 3, 2).otherwise(F.col("predicted_label"))
    name = F.when(F.col("predicted_label") == 0, "error").when(F.col("predicted_label") == 3, "purchase")
    changed = {
        "predicted_label": label.cast(dict(log.dtypes)["predicted_label"]),
        "predicted_label_name": F.coalesce(name, F.col("predicted_label_name")),
        "confidence": F.col("confidence") / 2,
        "latency_ms": F.col("latency_ms") * 2,
    }
    return log.withColumns({c: F.when(rows, new).otherwise(F.col(c)) for c, new in changed.items()})


def summary_of(sides):
    return drift.drift_summary(drift.numeric_drift(sides, NUMERIC), drift.categorical_drift(sides, CATEGORICAL))


def check_of(sides):
    return drift.alert_check(summary_of(sides), drift.confidence_drop(sides), drift.label_shift(sides))


def drift_summary(spark, d):
    out = summary_of(shifted(spark, d))
    return out.withColumn("drifted_columns", F.array_join("drifted_columns", ","))


def confidence_drop(spark, d):
    out = drift.confidence_drop(shifted(spark, d))
    return out.select(*[F.round(c, 6).alias(c) for c in ("ref_confidence", "cur_confidence", "drop")], "alert")


def label_distribution(spark, d):
    out = drift.label_distribution(t.predictions(spark, d))
    return out.select("predicted_label", "n", F.round("share", 6).alias("share"))


def label_shift(spark, d):
    return drift.label_shift(shifted(spark, d)).select(F.round("max_shift", 6).alias("max_shift"), "alert")


def alert_check(spark, d):
    out = check_of(shifted(spark, d))
    return out.select(
        F.array_join(F.transform("alerts", lambda a: a["code"]), ",").alias("codes"),
        F.array_join(F.transform("alerts", lambda a: F.format_string("%.4f", a["value"])), ",").alias("shown_values"),
        "alert_count",
        "needs_attention",
    )


def retrain_trigger(spark, d):
    out = drift.retrain_trigger(check_of(shifted(spark, d)))
    codes = F.transform("reasons", lambda r: F.split_part(r, F.lit(":"), F.lit(1)))
    return out.withColumn("reasons", F.array_join(codes, ","))


def window_summary(spark, d):
    return monitor.window_summary(t.predictions(spark, d))


def window_summary_day(spark, d):
    """The same over longer windows, where most of the log falls inside."""
    windows = {"1day": 86_400, "10day": 864_000, "60day": 5_184_000}
    return monitor.window_summary(t.predictions(spark, d), windows)


def retention_trim(spark, d):
    return monitor.retention_trim(t.predictions(spark, d)).select("prediction_id", at("ts").alias("ts"), "latency_ms")


def hourly_metrics(log, name: str, edge: str):
    """Mean confidence, error rate and exact 95th percentile of the latency for each hour."""
    hours = log.withColumn(name, F.window("ts", "1 hour")[edge])
    means = hours.groupBy(name).agg(
        F.avg("confidence").alias("mean_confidence"), F.avg((F.col("status") >= 400).cast("double")).alias("error_rate")
    )
    return means.join(exact_percentiles(hours, [name], "latency_ms", {"latency_p95": 0.95}), name, "left")


def threshold_alerts(spark, d):
    out = monitor.threshold_alerts(hourly_metrics(t.predictions(spark, d), "w", "start"), carry=["w"])
    return out.select(at("w").alias("w"), "type", "severity", F.round("value", 6).alias("value"), "threshold")


def feedback_stats(spark, d):
    return monitor.feedback_stats(t.feedback(spark, d))


def recent_audit(spark, d):
    both = io.prediction_audit(t.predictions(spark, d)).unionByName(io.feedback_audit(t.feedback(spark, d)))
    # the two logs share one id sequence: corrections follow their prediction
    ids = F.col("id") * 2 + (F.col("action") == "feedback").cast("long")
    return monitor.recent_audit(both.withColumn("id", ids)).select("id", "action", "created_at")


def request_rate(spark, d):
    return monitor.request_rate(t.predictions(spark, d)).withColumn("window_start", at("window_start"))


def request_counter(spark, d):
    return monitor.request_counter(t.predictions(spark, d))


def request_histogram(spark, d):
    return monitor.request_histogram(t.predictions(spark, d))


def bucket_quantiles(spark, d):
    return monitor.bucket_quantiles(t.predictions(spark, d)).withColumn("window_start", at("window_start"))


def bucket_quantiles_day(spark, d):
    out = monitor.bucket_quantiles(t.predictions(spark, d), minutes=1440)
    return out.withColumn("window_start", at("window_start"))


def error_rate(spark, d):
    return monitor.error_rate(t.predictions(spark, d)).withColumn("window_start", at("window_start"))


def confidence_windows(spark, d):
    return monitor.confidence_windows(t.predictions(spark, d)).withColumn("window_start", at("window_start"))


def rate_limit_audit(spark, d):
    return monitor.rate_limit_audit(t.predictions(spark, d), limit=1).withColumn("window_start", at("window_start"))


def keyed(log):
    return log.withColumn("text_key", text_key("text"))


def ttl_dedup(spark, d):
    return dedup.ttl_dedup(keyed(t.predictions(spark, d)))


def ttl_dedup_overwrite(spark, d):
    """Requests by GET stand for batch requests, which never read the cache and always write it."""
    log = keyed(t.predictions(spark, d)).withColumn("from_batch", F.col("method") == "GET")
    return dedup.ttl_dedup(log, overwrite="from_batch")


def ttl_dedup_hot(spark, d):
    """The same by the path for hot keys: the busiest keys are cut into chunks."""
    return dedup.ttl_dedup(keyed(t.predictions(spark, d)), hot_rows=215)


QUERIES = {
    f.__name__: f
    for f in (
        numeric_drift, categorical_drift, drift_summary, confidence_drop, label_distribution, label_shift, alert_check,
        retrain_trigger, window_summary, window_summary_day, retention_trim, threshold_alerts, feedback_stats, recent_audit,
        request_rate, request_counter, request_histogram, bucket_quantiles, bucket_quantiles_day, error_rate,
        confidence_windows, rate_limit_audit, ttl_dedup, ttl_dedup_overwrite, ttl_dedup_hot,
    )
}

SHIFTED_SQL = """shifted as (select * from ref_cur where side = 'ref'
    union all select * replace (confidence / 2 as confidence, latency_ms * 2 as latency_ms,
      case predicted_label when 0 then 1 when 3 then 2 else predicted_label end as predicted_label,
      case predicted_label when 0 then 'error' when 3 then 'purchase' else predicted_label_name end as predicted_label_name)
    from ref_cur where side = 'cur')"""


def drift_sql(view: str) -> str:
    melted_n = " union all ".join(f"select '{c}' as \"column\", side, {c}::double as v from {view}" for c in NUMERIC)
    melted_c = " union all ".join(f"select '{c}' as \"column\", side, {c}::varchar as v from {view}" for c in CATEGORICAL)
    return f"""
      nl as ({melted_n}),
      nv as (select "column", v, count(*) filter (where side = 'ref') as r, count(*) filter (where side = 'cur') as c from nl group by 1, 2),
      nt as (select "column", count(*) filter (where side = 'ref') as n_ref, count(*) filter (where side = 'cur') as n_cur,
          stddev_pop(v) filter (where side = 'ref') as sd from nl group by 1),
      ng as (select "column", v, abs(sum(r) over w::double / n_ref - sum(c) over w::double / n_cur) as gap, lead(v) over w - v as step
        from nv join nt using ("column") window w as (partition by "column" order by v)),
      ns as (select "column", max(gap) as ks, sum(gap * step) as w1 from ng group by 1),
      np as (select *, sqrt(n_ref::double * n_cur / (n_ref + n_cur)) * ks as lam from ns join nt using ("column")),
      num as (select "column", n_ref, n_cur, round(ks, 6) as ks_statistic, round(case when lam < 0.04 then 1 else
          least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda j:
            (case when j % 2 = 1 then 1 else -1 end) * exp(-2 * lam * lam * j * j))))) end, 6) as ks_p_value,
          round(w1 / sd, 6) as wasserstein_norm, w1 / sd >= 0.1 as drifted from np),
      cl as ({melted_c}),
      cv as (select "column", v, count(*) filter (where side = 'ref') as r, count(*) filter (where side = 'cur') as c from cl group by 1, 2),
      ct as (select "column", sum(r)::bigint as n_ref, sum(c)::bigint as n_cur from cv group by 1),
      cp as (select *, r::double / n_ref as p, c::double / n_cur as q,
          (r + c) * n_ref::double / (n_ref + n_cur) as er, (r + c) * n_cur::double / (n_ref + n_cur) as ec from cv join ct using ("column")),
      cat as (select "column", n_ref, n_cur, count(*) as categories,
          round(sqrt(sum((case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / 2)), 6) as js_distance,
          round(sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec), 6) as chi_square,
          round(sum((greatest(q, 1e-4::double) - greatest(p, 1e-4::double)) * ln(greatest(q, 1e-4::double) / greatest(p, 1e-4::double))), 6) as psi,
          sqrt(sum((case when p > 0 then p * ln(2 * p / (p + q)) else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) else 0 end) / 2)) >= 0.1 as drifted
        from cp group by 1, 2, 3)
    """


SUMMARY_SQL = (
    SHIFTED_SQL
    + ", "
    + drift_sql("shifted")
    + """, flags as (select "column", drifted from num union all select "column", drifted from cat),
    summary as (select count(*) as k, count(*) filter (where drifted) as hit, avg(drifted::int::double) as share from flags),
    conf as (select avg(confidence) filter (where side = 'ref') as rc, avg(confidence) filter (where side = 'cur') as cc from shifted),
    lab as (select predicted_label, count(*) filter (where side = 'ref')::double / (select count(*) from shifted where side = 'ref') as r,
        count(*) filter (where side = 'cur')::double / (select count(*) from shifted where side = 'cur') as c from shifted group by 1),
    shift as (select max(abs(r - c)) as s from lab),
    fired as (select 1 as i, 'DATA_DRIFT' as code, share as value from summary where share > 0.15
      union all select 2, 'CONFIDENCE_DROP', rc - cc from conf where rc - cc > 0.05
      union all select 3, 'LABEL_SHIFT', s from shift where s > 0.10)
    """
)

SECONDS = "%Y-%m-%d %H:%M:%S"


def window_sql(windows: dict[str, int]) -> str:
    values = ", ".join(f"('{w}', {s})" for w, s in windows.items())
    return f"""w(win, s) as (values {values}),
      x as (select win, s, latency_ms, confidence from w left join predictions p
        on p.ts >= (select max(ts) from predictions) - to_seconds(s))
      select win as "window", count(latency_ms) as count, round(coalesce(avg(latency_ms), 0), 6) as latency_mean,
        round(coalesce(quantile_cont(latency_ms, 0.5), 0), 6) as latency_p50, round(coalesce(quantile_cont(latency_ms, 0.95), 0), 6) as latency_p95,
        round(coalesce(avg(confidence), 0), 6) as confidence_mean, round(coalesce(min(confidence), 0), 6) as confidence_min,
        round(count(latency_ms)::double / s, 6) as throughput_per_sec from x group by win, s"""


def quantile_sql(value: str, bounds, quantiles, minutes: int) -> str:
    """Histogram in long form, then the first bucket that reaches the rank."""
    bound_rows = ", ".join(f"({i}, {b}::double)" for i, b in enumerate(bounds))
    picks = ", ".join(
        f"round(coalesce(arg_min(case when le >= {q}::double * n then case when le = prev then lo else"
        f" lo + (b - lo) * ({q}::double * n - prev) / (le - prev) end end, i) filter (where le >= {q}::double * n), {float(bounds[-1])}), 6) as p{int(q * 100)}"
        for q in quantiles
    )
    return f"""b(i, b) as (values {bound_rows}),
      t as (select time_bucket(interval '{minutes} minutes', ts) as w, count({value}) as n, avg({value}) as mean from predictions group by 1),
      h as (select time_bucket(interval '{minutes} minutes', ts) as w, b.i, b.b, count(*) filter (where {value} <= b.b) as le
        from predictions cross join b group by 1, 2, 3),
      c as (select *, coalesce(lag(le) over x, 0) as prev, coalesce(lag(b) over x, 0) as lo from h join t using (w)
        window x as (partition by w order by i))
      select strftime(w, '{SECONDS}') as window_start, any_value(n) as n, {picks}, round(any_value(mean), 6) as mean from c group by w"""


def ttl_sql(forced: str, log: str = "predictions", more: str = "") -> str:
    return f"""o as (select prediction_id, ts, text, sha256(text) as text_key, epoch_us(ts) // 1000 as t, ({forced}) as forced,
          predicted_label, confidence,
          row_number() over (partition by text order by ts, prediction_id) as rn from {log}),
      chain(text, rn, allowed, computed, id) as (
        select text, rn, t + 3600000, true, prediction_id from o where rn = 1
        union all
        select o.text, o.rn, case when o.forced or o.t >= c.allowed then o.t + 3600000 else c.allowed end,
          o.forced or o.t >= c.allowed, case when o.forced or o.t >= c.allowed then o.prediction_id else c.id end
        from chain c join o on o.text = c.text and o.rn = c.rn + 1)
      select o.prediction_id, o.text_key, not c.computed as hit, c.id as computed_id, s.predicted_label, s.confidence{more}
      from chain c join o using (text, rn) join predictions s on s.prediction_id = c.id"""


ORACLE = {
    "numeric_drift": with_views(drift_sql("ref_cur") + "select * from num", "ref_cur"),
    "categorical_drift": with_views(drift_sql("ref_cur") + "select * from cat", "ref_cur"),
    "drift_summary": with_views(
        SUMMARY_SQL
        + """select k as number_of_columns, hit as number_of_drifted_columns, round(share, 6) as share_of_drifted_columns,
          share >= 0.5 as drift_detected,
          (select coalesce(string_agg("column", ',' order by "column"), '') from flags where drifted) as drifted_columns from summary""",
        "ref_cur",
    ),
    "confidence_drop": with_views(
        SUMMARY_SQL + """select round(rc, 6) as ref_confidence, round(cc, 6) as cur_confidence, round(rc - cc, 6) as drop,
          rc - cc > 0.05 as alert from conf""",
        "ref_cur",
    ),
    "label_distribution": with_views(
        """select predicted_label, count(*) as n, round(count(*)::double / (select count(*) from predictions), 6) as share
           from predictions group by 1""",
        "predictions",
    ),
    "label_shift": with_views(SUMMARY_SQL + "select round(s, 6) as max_shift, s > 0.10 as alert from shift", "ref_cur"),
    "alert_check": with_views(
        SUMMARY_SQL + """select coalesce(string_agg(code, ',' order by i), '') as codes,
          coalesce(string_agg(printf('%.4f', value), ',' order by i), '') as shown_values,
          count(*) as alert_count, count(*) > 0 as needs_attention from fired""",
        "ref_cur",
    ),
    "retrain_trigger": with_views(
        SUMMARY_SQL
        + """, r as (select 0 as i, 'dataset_drift_detected' as code from summary where share >= 0.5 union all select i, code from fired)
        select count(*) > 0 as should_retrain, coalesce(string_agg(code, ',' order by i), '') as reasons,
          coalesce(bool_or(i = 0), false) as drift_detected, count(*) filter (where i > 0) as alert_count from r""",
        "ref_cur",
    ),
    "window_summary": with_views(window_sql(monitor.WINDOWS), "predictions"),
    "window_summary_day": with_views(window_sql({"1day": 86_400, "10day": 864_000, "60day": 5_184_000}), "predictions"),
    "retention_trim": with_views(
        f"""select prediction_id, strftime(ts, '{SECONDS}') as ts, latency_ms from predictions
            where ts >= (select max(ts) from predictions) - interval '1 hour'""",
        "predictions",
    ),
    "threshold_alerts": with_views(
        f"""h as (select time_bucket(interval '1 hour', ts) as w, avg(confidence) as c, avg((status >= 400)::int::double) as e,
              quantile_cont(latency_ms, 0.95) as l from predictions group by 1),
          a as (select w, 'confidence_drop' as type, 'warning' as severity, c as value, 0.7::double as threshold from h where c < 0.7::double
            union all select w, 'error_rate_spike', 'critical', e, 0.05::double from h where e > 0.05::double
            union all select w, 'latency_spike', 'warning', l, 100 from h where l > 100)
          select strftime(w, '{SECONDS}') as w, type, severity, round(value, 6) as value, threshold from a""",
        "predictions",
    ),
    "feedback_stats": with_views(
        """select correct_label as label, coalesce(correct_label_name, 'class_' || correct_label) as label_name, count(*) as count,
             (select count(*) from feedback) as total_corrections from feedback group by correct_label, correct_label_name
           order by count(*) desc, correct_label limit 10""",
        "feedback",
    ),
    "recent_audit": with_views(
        """a as (select prediction_id * 2 as id, 'prediction' as action, ts as created_at from predictions
             union all select prediction_id * 2 + 1, 'feedback', created_at from feedback)
          select id, action, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') as created_at from a order by id desc limit 50""",
        "predictions", "feedback",
    ),
    "request_rate": with_views(
        f"""g as (select time_bucket(interval '1 minute', ts) as w, method, grouping(method) = 1 as is_total, count(*) as n
            from predictions group by grouping sets ((w), (w, method)))
          select strftime(w, '{SECONDS}') as window_start, method, is_total, n as requests, round(n / 60.0::double, 6) as per_second from g""",
        "predictions",
    ),
    "request_counter": with_views(
        "select method, endpoint, status, count(*) as requests from predictions group by 1, 2, 3", "predictions"
    ),
    "request_histogram": with_views(
        f"""b(le, b) as (values {", ".join(f"('{x}', {x}::double)" for x in monitor.LATENCY_BOUNDS)}, ('+Inf', 'infinity'::double))
          select method, endpoint, le, count(*) filter (where latency_ms <= b) as n from predictions cross join b group by 1, 2, 3""",
        "predictions",
    ),
    "bucket_quantiles": with_views(quantile_sql("latency_ms", monitor.LATENCY_BOUNDS, (0.5, 0.95, 0.99), 5), "predictions"),
    "bucket_quantiles_day": with_views(quantile_sql("latency_ms", monitor.LATENCY_BOUNDS, (0.5, 0.95, 0.99), 1440), "predictions"),
    "error_rate": with_views(
        f"""select strftime(time_bucket(interval '1 minute', ts), '{SECONDS}') as window_start, count(*) as requests,
             round(avg((status >= 400)::int::double), 6) as error_rate from predictions group by 1""",
        "predictions",
    ),
    "confidence_windows": with_views(quantile_sql("confidence", monitor.CONFIDENCE_BOUNDS, (0.5, 0.95), 5), "predictions"),
    "rate_limit_audit": with_views(
        f"""select client_id, strftime(time_bucket(interval '1 minute', ts), '{SECONDS}') as window_start, count(*) as requests
            from predictions group by 1, 2 having count(*) > 1""",
        "predictions",
    ),
    "ttl_dedup": with_views(ttl_sql("false"), "predictions"),
    "ttl_dedup_overwrite": with_views(ttl_sql("method = 'GET'"), "predictions"),
    "ttl_dedup_hot": with_views(ttl_sql("false"), "predictions"),
}
