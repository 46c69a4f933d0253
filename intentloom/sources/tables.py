"""The supplied tables, and the labelled-text and log views derived from them.

``read_table`` reads with the columns the caller needs left to Catalyst; the views are plain
projections, so filters and column pruning reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
MICROS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str = "ts"):
    """Microseconds since the epoch of a zone-less timestamp, whatever the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {ts})")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled text with few, unequal classes: the language is the class."""
    lang = F.col("lang")
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sample_id"),
        "text",
        lang.alias("label_name"),
        F.when(lang == "de", 0).when(lang == "en", 1).when(lang == "es", 2).otherwise(3).alias("label"),
    )


def samples20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled text with twenty classes: the source is the class."""
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sample_id"),
        "text",
        F.col("source").alias("label_name"),
        F.substring("source", 4, 9).cast("int").alias("label"),
    )


def predictions_from(events: DataFrame) -> DataFrame:
    """Request log: one scored request per event. Works on a batch or a stream of events."""
    kind, user = F.col("event_type"), F.col("user_id")
    return events.select(
        F.col("event_id").alias("prediction_id"),
        "ts",
        user.alias("client_id"),
        F.when(kind == "click", 0)
        .when(kind == "error", 1)
        .when(kind == "purchase", 2)
        .when(kind == "signup", 3)
        .otherwise(4)
        .alias("predicted_label"),
        kind.alias("predicted_label_name"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("double") / F.lit(100.0)).alias("confidence"),
        F.col("value").alias("latency_ms"),
        F.when(kind == "error", 500).otherwise(200).alias("status"),
        F.when(user % 10 == 0, "GET").otherwise("POST").alias("method"),
        F.when(kind == "purchase", "/feedback").when(kind == "signup", "/batch").otherwise("/predict").alias("endpoint"),
        F.concat(kind, F.lit(" "), (user % 10).cast("string")).alias("text"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from(read_table(spark, sf_dir, "events"))


SPLIT_DAY = "timestamp_ntz'2024-01-16 00:00:00'"


def ref_cur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log in two sides: first half of the month is the reference, the rest current."""
    side = F.when(F.expr(f"ts < {SPLIT_DAY}"), "ref").otherwise("cur").alias("side")
    return predictions(spark, sf_dir).select("*", side)


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections; one label has no name, to exercise the fallback."""
    number = F.col("user_id") % 12
    return (
        read_table(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .select(
            F.concat(F.lit("fb"), F.col("event_id").cast("string")).alias("feedback_id"),
            F.col("event_id").alias("prediction_id"),
            number.cast("int").alias("correct_label"),
            F.when(number != 3, F.concat(F.lit("name_"), number.cast("string"))).alias("correct_label_name"),
            F.col("props").alias("comment"),
            F.col("ts").alias("created_at"),
        )
    )


def event_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label dictionary of the request log: one row per label number."""
    return (
        predictions(spark, sf_dir)
        .select(F.col("predicted_label").alias("label"), F.col("predicted_label_name").alias("label_name"))
        .distinct()
        .groupBy("label")
        .agg(F.min("label_name").alias("label_name"))
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label"
    )
