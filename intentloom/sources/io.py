"""Sinks and the readers that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "class string, precision double, recall double, `f1-score` double, support double"
ALERT_KEYS = ["type", "severity", "message", "value", "threshold", "timestamp"]
PREVIEW_CHARS = 200


def load_union(first: DataFrame, second: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """The second table appended to the first, its positions renumbered to follow on."""
    shift = first.agg(F.coalesce(F.max(id_col) + 1, F.lit(0))).scalar()
    return first.unionByName(second.withColumn(id_col, F.col(id_col) + shift))


def union_report(df: DataFrame, label: str = "label", id_col: str = "sample_id") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(label).alias("labels"),
        F.max(id_col).alias("last_position"),
    )


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split name; a rerun replaces the whole table."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_splits(spark: SparkSession, path: str, names: Sequence[str], schema: str | None = None) -> DataFrame:
    """The named splits, read from their own folders only; names the missing ones if any."""
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.parquet(path).filter(F.col("split").isin(list(names)))
    # file listing by partition value: only the folders of the named splits are opened
    present = {r[0] for r in table.select("split").distinct().collect()}
    missing = [n for n in names if n not in present]
    if missing:
        raise FileNotFoundError(f"no rows for split {', '.join(missing)} in {path}; write the splits first")
    return table


def write_report_csv(report: DataFrame, path: str) -> None:
    """Per-class report with the class as unnamed first column."""
    shaped = report.select(
        F.col("label").cast("string").alias("_index"), "precision", "recall", F.col("f1_score").alias("f1-score"), "support"
    )
    named = shaped.withColumnRenamed("_index", "Unnamed: 0")
    named.write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a per-class report back; the first column, whatever its name, is the class."""
    return spark.read.schema(REPORT_SCHEMA).option("header", True).option("enforceSchema", True).csv(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Numbers (and flags, as 1 or 0) of flat JSON objects as (metric, value) rows; the rest is dropped.

    A file holds one object over several lines, or several, each from a line of its own on.
    """
    text = spark.read.text(path, wholetext=True)
    several = F.concat(F.lit("["), F.regexp_replace("value", r"\}\s*\n\s*\{", "},{"), F.lit("]"))
    files = text.filter(F.trim("value") != "").select(F.parse_json(several).alias("v"))
    objects = files.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("value").alias("v"))
    entries = objects.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", "value")
    kind = F.schema_of_variant("value")
    number = F.try_variant_get("value", "$", "double")
    flag = F.try_variant_get("value", "$", "boolean").cast("int").cast("double")
    value = F.when(kind == "BOOLEAN", flag).when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), number)
    return entries.select(F.col("key").alias("metric"), value.alias("value")).filter("value is not null")


def utc_clock(instant: str | Column) -> Column:
    """The UTC wall time of an instant, to format in any session time zone."""
    return F.to_utc_timestamp(instant, F.current_timezone())


def iso_utc(clock: str | Column) -> Column:
    return F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def committed(spark: SparkSession, path: str) -> list[str]:
    """The folders of whole batches under ``path``, ``batch=<id>`` each.

    A write leaves its mark last, so a batch that broke off is not among them until it is written again.
    """
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(str(f.getPath().getParent().toString()) for f in found or [])


def read_batches(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """All whole batches of an appended table; ``schema`` names its columns, a folder's among them if wanted."""
    folders = committed(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).format(kind).load(folders)


ALERT_SCHEMA = "type string, severity string, message string, value double, threshold double, timestamp string"
METRIC_LOG_SCHEMA = "timestamp timestamp_ntz, latency_ms double, confidence double, label string, day date"
FILES_PER_DAY = 8


def write_alerts(alerts: DataFrame, path: str, batch: str) -> None:
    """Append alert rows as JSON lines with fixed keys, time (UTC wall time) in ISO form.

    One folder for each batch: a repeated write of a batch replaces its rows.
    """
    rows = alerts.select(*ALERT_KEYS[:-1], iso_utc("timestamp").alias("timestamp"))
    rows.write.mode("overwrite").json(f"{path}/batch={batch}")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, ALERT_SCHEMA, "json")


def metric_rows(log: DataFrame) -> DataFrame:
    """Metric log entries of scored requests."""
    return log.select(
        F.col("ts").alias("timestamp"),
        "latency_ms",
        "confidence",
        F.col("predicted_label_name").alias("label"),
        F.to_date("ts").alias("day"),
    )


def write_metric_log(log: DataFrame, path: str, batch: str, files_per_day: int = FILES_PER_DAY) -> None:
    """Append metric entries, one folder per batch and day so that trailing windows open few files.

    A day's rows of a batch go to ``files_per_day`` files at most, a crowded day to that many tasks. A
    repeated write of a batch replaces its rows.
    """
    rows = metric_rows(log)
    dealt = rows.repartition(F.col("day"), F.pmod(F.xxhash64("timestamp", "latency_ms", "confidence"), F.lit(files_per_day)))
    dealt.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={batch}")


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, METRIC_LOG_SCHEMA)


RUN_SCHEMA = "run_id string, experiment string, run_name string, accuracy double, f1_macro double, f1_weighted double, status string"
HISTORY_SCHEMA = "run_id string, run_name string, epoch int, objective double"


def write_run(runs: DataFrame, history: DataFrame, path: str, run: str) -> None:
    """Add one training run to a run log: its final metrics and the objective of every iteration.

    A run is whole once its metrics are there; they are written last. A repeated run replaces its rows.
    """
    history.write.mode("overwrite").parquet(f"{path}/history/batch={run}")
    runs.write.mode("overwrite").parquet(f"{path}/runs/batch={run}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/runs", RUN_SCHEMA)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Iterations of the whole runs."""
    return read_batches(spark, f"{path}/history", HISTORY_SCHEMA).join(F.broadcast(read_runs(spark, path).select("run_id").distinct()), "run_id", "left_semi")


def prediction_audit(log: DataFrame) -> DataFrame:
    """Audit rows of predictions: a text preview and the prediction, as JSON details."""
    prediction = F.struct(
        F.col("predicted_label").alias("label"),
        "confidence",
        F.col("predicted_label_name").alias("label_name"),
        F.col("prediction_id").cast("string").alias("prediction_id"),
        "latency_ms",
    )
    details = F.struct(F.substring("text", 1, PREVIEW_CHARS).alias("text_preview"), prediction.alias("prediction"))
    return log.select(
        F.col("prediction_id").alias("id"),
        F.lit("prediction").alias("action"),
        F.to_json(details).alias("details"),
        F.col("ts").alias("created_at"),
    )


def feedback_audit(feedback: DataFrame) -> DataFrame:
    """Audit rows of corrections."""
    details = F.struct("feedback_id", F.col("prediction_id").cast("string").alias("prediction_id"), "correct_label")
    return feedback.select(
        F.col("prediction_id").alias("id"),
        F.lit("feedback").alias("action"),
        F.to_json(details).alias("details"),
        "created_at",
    )


def feedback_rows(requests: DataFrame) -> DataFrame:
    """Corrections with an id made from their content, so a rerun makes the same row.

    The corrected prediction need not exist.
    """
    parts = ["prediction_id", "correct_label", "correct_label_name", "comment", "created_at"]
    key = F.to_json(F.struct(*parts))
    return requests.select(F.substring(F.sha2(key, 256), 1, 32).alias("feedback_id"), *parts)


def write_feedback(requests: DataFrame, path: str, batch: str) -> None:
    """One folder for each batch: a repeated write of a batch replaces its rows."""
    feedback_rows(requests).write.mode("overwrite").parquet(f"{path}/batch={batch}")
