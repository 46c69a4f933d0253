"""Sources and sinks: every sink query writes, reads back and returns what was stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.operators import evaluation, monitor, sampling
from intentloom.plans.evaluation import eval_pairs, report_sql, METRICS_SQL
from intentloom.plans.fixtures import with_views
from intentloom.plans.monitoring import hourly_metrics
from intentloom.plans.sampling import SPLIT_SQL
from intentloom.session import scratch_path
from intentloom.sources import io
from intentloom.sources import tables as t


def _texts(spark, d):
    docs = t.read_table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), "text", F.col("lang").alias("label"))
    bench = t.read_table(spark, d, "benchmark").select(F.col("item_id").alias("sample_id"), "text", F.lit("benchmark").alias("label"))
    return docs, bench


def load_union(spark, d):
    return io.union_report(io.load_union(*_texts(spark, d)))


def write_splits(spark, d):
    path = scratch_path(spark, "splits")
    io.write_splits(sampling.stratified_split(t.samples(spark, d)), path)
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count("text").alias("n"))


def read_splits(spark, d):
    path = scratch_path(spark, "splits")
    io.write_splits(sampling.stratified_split(t.samples(spark, d)), path)
    table = io.read_splits(spark, path, ["train", "test"])
    return table.select(F.col("sample_id"), F.col("label").cast("long").alias("label"), F.col("split").cast("string").alias("split"))


def report_csv_io(spark, d):
    path = scratch_path(spark, "report")
    io.write_report_csv(evaluation.per_class_report(eval_pairs(spark, d)), path)
    back = io.read_report_csv(spark, path)
    return back.select("class", "precision", "recall", F.col("f1-score").alias("f1_score"), F.col("support").cast("long").alias("support"))


def metrics_json_io(spark, d):
    path = scratch_path(spark, "metrics")
    metrics = evaluation.classification_metrics(eval_pairs(spark, d))
    io.write_metrics_json(metrics.withColumn("model", F.lit("centroid")), path)
    return io.read_metrics_json(spark, path)


def alert_sink(spark, d):
    path = scratch_path(spark, "alerts")
    alerts = monitor.threshold_alerts(hourly_metrics(t.predictions(spark, d), "window_end", "end"), carry=["window_end"])
    for _ in range(2):  # a repeated batch replaces its own rows
        io.write_alerts(alerts.withColumnRenamed("window_end", "timestamp"), path, "1")
    return io.read_alerts(spark, path).select(
        "type", "severity", F.round("value", 6).alias("value"), "threshold", "timestamp"
    )


def metric_log_sink(spark, d):
    path = scratch_path(spark, "metric-log")
    for _ in range(2):  # a repeated batch replaces its own rows
        io.write_metric_log(t.predictions(spark, d), path, "1")
    return io.read_metric_log(spark, path).select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "latency_ms", "confidence", "label"
    )


def audit_rows(spark, d):
    details = "text_preview string, prediction struct<label:int,confidence:double,label_name:string,prediction_id:string>, feedback_id string, prediction_id string, correct_label int"
    both = io.prediction_audit(t.predictions(spark, d)).unionByName(io.feedback_audit(t.feedback(spark, d)))
    j = F.from_json("details", details)
    return both.select(
        "id",
        "action",
        j["text_preview"].alias("text_preview"),
        F.coalesce(j["prediction"]["label"], j["correct_label"]).cast("long").alias("label"),
        j["prediction"]["confidence"].alias("confidence"),
        j["feedback_id"].alias("feedback_id"),
        F.coalesce(j["prediction"]["prediction_id"], j["prediction_id"]).alias("prediction_id"),
    )


def feedback_rows(spark, d):
    path = scratch_path(spark, "feedback")
    for _ in range(2):  # a repeated batch replaces its own rows
        io.write_feedback(t.feedback(spark, d), path, "1")
    return spark.read.parquet(path).select(
        "prediction_id",
        F.col("correct_label").cast("long").alias("correct_label"),
        "correct_label_name",
        F.length("feedback_id").cast("long").alias("id_length"),
    )


HOURLY_SQL = """hourly as (select time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end,
    avg(confidence) as c, avg((status >= 400)::int::double) as e, quantile_cont(latency_ms, 0.95) as l from predictions group by 1)"""

QUERIES = {
    f.__name__: f
    for f in (
        load_union, write_splits, read_splits, report_csv_io, metrics_json_io, alert_sink, metric_log_sink,
        audit_rows, feedback_rows,
    )
}
ORACLE = {
    "load_union": """with u as (select doc_id as id, lang as label from documents union all
        select item_id + (select max(doc_id) + 1 from documents), 'benchmark' from benchmark)
        select count(*) as rows, count(distinct label) as labels, max(id) as last_position from u""",
    "write_splits": with_views(f"split as ({SPLIT_SQL}) select split, label, count(text) as n from split group by 1, 2", "samples"),
    "read_splits": with_views(
        f"split as ({SPLIT_SQL}) select sample_id, label::bigint as label, split from split where split <> 'val'", "samples"
    ),
    "report_csv_io": with_views(
        report_sql("scored") + "select label::varchar as class, precision, recall, f1_score, support from report", "scored"
    ),
    "metrics_json_io": with_views(
        report_sql("scored", rounded=False) + METRICS_SQL + "select metric, value from (unpivot metrics on columns(*) into name metric value value)",
        "scored",
    ),
    "alert_sink": with_views(
        HOURLY_SQL
        + """
        select type, severity, round(value, 6) as value, threshold,
          strftime(window_end, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp from (
          select window_end, 'confidence_drop' as type, 'warning' as severity, c as value, 0.7::double as threshold from hourly where c < 0.7::double
          union all select window_end, 'error_rate_spike', 'critical', e, 0.05::double from hourly where e > 0.05::double
          union all select window_end, 'latency_spike', 'warning', l, 100::double from hourly where l > 100)""",
        "predictions",
    ),
    "metric_log_sink": with_views(
        "select strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp, latency_ms, confidence, predicted_label_name as label from predictions",
        "predictions",
    ),
    "audit_rows": with_views(
        """select prediction_id as id, 'prediction' as action, substr(text, 1, 200) as text_preview,
             predicted_label::bigint as label, confidence, null::varchar as feedback_id, prediction_id::varchar as prediction_id
           from predictions union all
           select prediction_id, 'feedback', null, correct_label::bigint, null, feedback_id, prediction_id::varchar from feedback""",
        "predictions", "feedback",
    ),
    "feedback_rows": with_views(
        "select prediction_id, correct_label::bigint as correct_label, correct_label_name, 32::bigint as id_length from feedback",
        "feedback",
    ),
}
