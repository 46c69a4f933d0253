"""Continuous window metrics with exact percentiles, the rows that came too late, and alerts.

One stream feeds all windows. Each micro-batch is reduced to rows (minute, latency, counts and sums), the
mergeable form of everything the metrics need: minutes merge into five minutes or an hour by adding up, and
a percentile over (value, count) is exact. What is kept from batch to batch is that table for the longest
window and the minutes still open, so a trigger costs its own rows and about an hour of distinct values,
however long the stream has run.

The watermark is the newest event time so far less the delay, as at the end of a batch. A minute closes
when the watermark passes its end and is written once; a window likewise. A row of a minute that was closed
before its batch is late: it changes no window and goes into a ledger in the same form, so every row that came
in is found in exactly one of the closed minutes, the open ones and the ledger.

Every output of a batch is a folder named by the batch, so a retried batch replaces its own. The driver reads
one number per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions.scale import exact_percentiles
from intentloom.operators.monitor import threshold_alerts
from intentloom.session import forget
from intentloom.sources.io import iso_utc, utc_clock

MINUTE = 60
#: Window name: size and slide in seconds, multiples of a minute.
WINDOWS = {"1min": (60, 60), "5min": (300, 60), "1hour": (3600, 600)}
PERCENTILES = {"latency_p50": 0.5, "latency_p95": 0.95}
COUNTS = "minute long, latency_ms double, n long, confidence_sum double, confidence_n long, confidence_min double, errors long, status_n long"
METRICS = (
    "window string, window_start timestamp, window_end timestamp, count long, latency_mean double, latency_p50 double, "
    "latency_p95 double, mean_confidence double, confidence_min double, error_rate double, throughput_per_sec double"
)


def minute_counts(log: DataFrame) -> DataFrame:
    """``COUNTS`` of a log, with ``newest``, the latest event time of a row in microseconds."""
    us = F.unix_micros("ts")
    minute = F.floor(us / (MINUTE * 1_000_000)) * MINUTE
    return log.groupBy(minute.alias("minute"), F.col("latency_ms").cast("double").alias("latency_ms")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("confidence").cast("double")).alias("confidence_sum"),
        F.count("confidence").alias("confidence_n"),
        F.min(F.col("confidence").cast("double")).alias("confidence_min"),
        F.sum((F.col("status") >= 400).cast("long")).alias("errors"),
        F.count("status").alias("status_n"),
        F.max(us).alias("newest"),
    )


def merged(counts: DataFrame) -> DataFrame:
    """One row per minute and latency of several tables of counts put together."""
    sums = [F.sum(c).alias(c) for c in ("n", "confidence_sum", "confidence_n")]
    rest = [F.min("confidence_min").alias("confidence_min"), F.sum("errors").alias("errors"), F.sum("status_n").alias("status_n")]
    return counts.groupBy("minute", "latency_ms").agg(*sums, *rest)


def _holding(name: str, size: int, slide: int) -> Column:
    """The windows of one kind that hold a minute, as struct(window, start, size)."""
    if size % MINUTE or slide % MINUTE:
        raise ValueError(f"window {name} is not made of whole minutes")
    last = F.col("minute") - F.pmod("minute", F.lit(slide))
    starts = F.transform(F.sequence(F.lit(0), F.lit(-(-size // slide) - 1)), lambda k: last - k * slide)
    starts = F.filter(starts, lambda start: start + size > F.col("minute"))
    return F.transform(starts, lambda start: F.struct(F.lit(name).alias("window"), start.alias("start"), F.lit(size).alias("size")))


def window_metrics(counts: DataFrame, windows: Mapping[str, tuple[int, int]] = WINDOWS, after: int | None = None, upto: int | None = None) -> DataFrame:
    """``METRICS`` of the windows that end later than ``after`` and not later than ``upto`` (epoch seconds)."""
    placed = F.flatten(F.array(*[_holding(name, size, slide) for name, (size, slide) in windows.items()]))
    rows = counts.select("*", F.inline(placed))
    end = F.col("start") + F.col("size")
    if after is not None:
        rows = rows.filter(end > after)
    if upto is not None:
        rows = rows.filter(end <= upto)
    keys = ["window", "start", "size"]
    valued = F.when(F.col("latency_ms").isNotNull(), F.col("n"))
    basics = rows.groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.try_divide(F.sum(F.col("latency_ms") * F.col("n")), F.sum(valued)).alias("latency_mean"),
        F.try_divide(F.sum("confidence_sum"), F.sum("confidence_n")).alias("mean_confidence"),
        F.min("confidence_min").alias("confidence_min"),
        F.try_divide(F.sum("errors"), F.sum("status_n")).alias("error_rate"),
    )
    spots = exact_percentiles(rows, keys, "latency_ms", PERCENTILES, weight="n")
    joined = basics.join(spots, keys, "left")
    return joined.select(
        "window",
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(end).alias("window_end"),
        "count", "latency_mean", *PERCENTILES, "mean_confidence", "confidence_min", "error_rate",
        (F.col("count") / F.col("size")).alias("throughput_per_sec"),
    )


def write_window_batch(
    batch: DataFrame, batch_id: int, folder: str, windows: Mapping[str, tuple[int, int]], delay: int,
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Add one micro-batch to the tables in ``folder``; ``then`` gets the windows it closed."""
    spark = batch.sparkSession
    earlier, mark = spark.createDataFrame([], COUNTS), None
    if batch_id:
        earlier = spark.read.schema(COUNTS).parquet(f"{folder}/kept/batch={batch_id - 1}")
        mark = spark.read.schema("mark long").parquet(f"{folder}/marks/batch={batch_id - 1}").first()["mark"]

    came = f"{folder}/came/batch={batch_id}"
    minute_counts(batch).write.mode("overwrite").parquet(came)
    came = spark.read.schema(f"{COUNTS}, newest long").parquet(came)
    newest = came.agg(F.max("newest")).first()[0]  # one number
    reached = mark if newest is None else max(newest // 1_000_000 - delay, mark if mark is not None else -(1 << 62))
    spark.createDataFrame([(reached,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/marks/batch={batch_id}")

    late = F.lit(False) if mark is None else F.coalesce(F.col("minute") + MINUTE <= mark, F.lit(False))
    # a row without a time belongs to no window
    behind = late | F.col("minute").isNull()
    came.filter(behind).drop("newest").write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
    kept, longest = f"{folder}/kept/batch={batch_id}", max(size for size, _ in windows.values())
    whole = merged(earlier.unionByName(came.filter(~behind).drop("newest")))
    if mark is not None:  # the windows that close now begin after this
        whole = whole.filter(F.col("minute") >= mark - longest)
    whole.write.mode("overwrite").parquet(kept)
    whole = spark.read.schema(COUNTS).parquet(kept)
    upto = reached if reached is not None else -(1 << 62)
    closed = whole.filter(F.col("minute") + MINUTE <= upto)
    if mark is not None:
        closed = closed.filter(F.col("minute") + MINUTE > mark)
    closed.write.mode("overwrite").parquet(f"{folder}/minutes/batch={batch_id}")
    done = f"{folder}/windows/batch={batch_id}"
    window_metrics(whole, windows, mark, upto).write.mode("overwrite").parquet(done)
    if then:
        then(spark.read.schema(METRICS).parquet(done), batch_id)
    if batch_id > 1:  # a retry of this batch needs the one before it
        for name in ("kept", "came", "marks"):
            forget(spark, f"{folder}/{name}/batch={batch_id - 2}")


def stream_windows(
    stream: DataFrame, folder: str, checkpoint: str, windows: Mapping[str, tuple[int, int]] = WINDOWS, delay: int = 600,
    then: Callable[[DataFrame, int], None] | None = None,
):
    """A writer that keeps minutes, window metrics and late rows of a request stream in ``folder``."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_window_batch(batch, batch_id, folder, windows, delay, then)
    )


def read_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of every closed window."""
    return spark.read.schema(METRICS).parquet(f"{folder}/windows")


def read_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every closed minute, with the batch that closed it."""
    return spark.read.schema(f"{COUNTS}, batch long").parquet(f"{folder}/minutes")


def read_open(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the minutes that are still open after the last batch."""
    marks = spark.read.schema("mark long, batch long").parquet(f"{folder}/marks")
    last = marks.orderBy(F.desc("batch")).first()  # two rows
    counts = spark.read.schema(COUNTS).parquet(f"{folder}/kept/batch={last['batch']}")
    return counts if last["mark"] is None else counts.filter(F.col("minute") + MINUTE > last["mark"])


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the rows that came after their minute was closed (or have no time), with their batch."""
    return spark.read.schema(f"{COUNTS}, batch long").parquet(f"{folder}/late")


def write_alerts_of(batch: DataFrame, batch_id: int, path: str) -> None:
    """Alerts of one micro-batch of window metrics; a retried batch replaces its own folder."""
    alerts = threshold_alerts(batch, carry=["window_end"])
    rows = alerts.select("type", "severity", "message", "value", "threshold", F.col("window_end").alias("timestamp"))
    rows.withColumn("timestamp", iso_utc(utc_clock("timestamp"))).write.mode("overwrite").json(f"{path}/batch={batch_id}")


def stream_alerts(
    stream: DataFrame, path: str, folder: str, checkpoint: str, windows: Mapping[str, tuple[int, int]], delay: int = 600
):
    """A writer that appends the alerts of every closed window as JSON lines, from the same single stream."""
    return stream_windows(stream, folder, checkpoint, windows, delay, lambda closed, batch_id: write_alerts_of(closed, batch_id, path))
