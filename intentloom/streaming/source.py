"""The request log as a stream of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.sources.tables import EVENT_SCHEMA, micros, predictions_from


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Requests from an event table, one file or a folder; ``ts`` becomes a UTC instant, as watermarks need."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a plain path must be a folder, a pattern may also match one file
    log = predictions_from(reader.parquet(f"{path[:-1]}[{path[-1]}]"))
    return log.withColumn("ts", F.timestamp_micros(micros("ts")))
