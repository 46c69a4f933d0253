"""Continuous log rows, and the periodic drift check against a fixed reference."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.operators import drift
from intentloom.session import exists, forget
from intentloom.sources.io import metric_rows, prediction_audit


def stream_logs(stream: DataFrame, path: str, checkpoint: str, rows: Callable[[DataFrame], DataFrame] = prediction_audit):
    """A writer that appends log rows of every request to a parquet table, each exactly once."""
    return rows(stream).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def stream_metric_log(stream: DataFrame, path: str, checkpoint: str):
    return stream_logs(stream, path, checkpoint, metric_rows).partitionBy("day")


COUNTED = "kind string, column string, number double, word string, n long"


def value_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``COUNTED``: how often each value of the columns occurs; null and NaN are no values.

    The mergeable form of a side: tables of counts add up, and all drift statistics follow from them.
    """
    no_number, no_word = F.lit(None).cast("double"), F.lit(None).cast("string")
    numbers = [
        F.struct(F.lit("number").alias("kind"), F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), no_number).alias("number"), no_word.alias("word"))
        for c in numeric
    ]
    words = [
        F.struct(F.lit("word").alias("kind"), F.lit(c).alias("column"), no_number.alias("number"), F.col(c).cast("string").alias("word"))
        for c in categorical
    ]
    long = df.select(F.inline(F.array(*numbers, *words))).filter("number is not null or word is not null")
    return long.groupBy("kind", "column", "number", "word").agg(F.count(F.lit(1)).alias("n"))


def decision(sides: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, confidence: str) -> DataFrame:
    """The retrain decision from both sides' counts (kind, column, number, word, ref, cur)."""
    numbers = sides.filter("kind = 'number'").select("column", F.col("number").alias("v"), "ref", "cur")
    words = sides.filter("kind = 'word'").select("column", F.col("word").alias("v"), "ref", "cur")
    summary = drift.drift_summary(
        drift.drift_of_numbers(numbers.filter(F.col("column").isin(list(numeric)))),
        drift.drift_of_categories(words.filter(F.col("column").isin(list(categorical)))),
    )
    drop = drift.drop_of_confidence(numbers.filter(F.col("column") == confidence))
    shift = drift.shift_of_labels(words.filter(F.col("column") == label))
    return drift.retrain_trigger(drift.alert_check(summary, drop, shift))


def write_monitor_batch(
    batch: DataFrame, batch_id: int, folder: str, numeric: Sequence[str], categorical: Sequence[str], label: str, confidence: str
) -> None:
    """Add one micro-batch to the counts of the current side and write the decision over all of it."""
    spark = batch.sparkSession
    counted = [*categorical, *([label] if label not in categorical else [])]
    now = value_counts(batch, [*numeric, *([confidence] if confidence not in numeric else [])], counted)
    if batch_id:
        now = now.unionByName(spark.read.schema(COUNTED).parquet(f"{folder}/current/batch={batch_id - 1}"))
    keys = ["kind", "column", "number", "word"]
    current = f"{folder}/current/batch={batch_id}"
    now.groupBy(*keys).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(current)
    none = F.lit(0).cast("long")
    sides = spark.read.schema(COUNTED).parquet(f"{folder}/reference").select(*keys, F.col("n").alias("ref"), none.alias("cur"))
    sides = sides.unionByName(spark.read.schema(COUNTED).parquet(current).select(*keys, none.alias("ref"), F.col("n").alias("cur")))
    sides = sides.groupBy(*keys).agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    made = decision(sides, numeric, categorical, label, confidence)
    made.write.mode("overwrite").json(f"{folder}/decisions/batch={batch_id}")
    if batch_id > 1:  # a retry of this batch needs the one before it
        forget(spark, f"{folder}/current/batch={batch_id - 2}")


def stream_monitor(
    stream: DataFrame, reference: DataFrame, folder: str, checkpoint: str, numeric: Sequence[str], categorical: Sequence[str],
    label: str = "predicted_label", confidence: str = "confidence",
):
    """A writer that decides after every batch over all rows so far against a fixed reference.

    The decision is a view kept up by counts: the reference is counted once, when the folder has no counts of
    it, and a batch adds its own counts to those of the batches before, whose rows are not read again.
    All outputs of a batch go to folders named by it, so a retried batch replaces its own.
    """
    spark = stream.sparkSession
    if not exists(spark, f"{folder}/reference/_SUCCESS"):
        counted = value_counts(reference, list(dict.fromkeys([*numeric, confidence])), list(dict.fromkeys([*categorical, label])))
        counted.write.mode("overwrite").parquet(f"{folder}/reference")
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_monitor_batch(batch, batch_id, folder, numeric, categorical, label, confidence)
    )


def read_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The decision after each batch."""
    schema = "should_retrain boolean, reasons array<string>, drift_detected boolean, alert_count int, batch long"
    return spark.read.schema(schema).json(f"{folder}/decisions")
