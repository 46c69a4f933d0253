"""Expiring de-duplication as a stateful stream: one cached answer per key."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from intentloom.operators.dedup import ALWAYS, HOT_ROWS, TTL_SECONDS, computed_in, ttl_dedup

OUTPUT = (
    "prediction_id bigint, text_key string, hit boolean, computed_id bigint, predicted_label int, confidence double"
)
STATE = "allowed_ms bigint, computed_id bigint, predicted_label int, confidence double"


class TtlCache(StatefulProcessor):
    """Keeps the last computation of a key until it expires; rows come in event-time order per batch."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cached = handle.getValueState("cached", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.cached.get() if self.cached.exists() else None
        batch = pd.concat(list(rows)).sort_values(["us", "prediction_id"], ignore_index=True)
        t, forced = batch["us"].to_numpy() // 1_000, batch["overwrite"].to_numpy(dtype=bool)
        done = computed_in(np.zeros(len(t), "int64"), t, forced, int(state[0]) if state else int(ALWAYS), self.ttl_ms)
        by = np.maximum.accumulate(np.where(done, np.arange(len(t)), -1))
        answer = ["prediction_id", "predicted_label", "confidence"]
        served = batch[answer].iloc[np.maximum(by, 0)].reset_index(drop=True)
        if state:
            served.loc[by < 0, answer] = list(state[1:])
        if done.any():
            last = int(by[-1])
            made = batch.iloc[last]
            self.cached.update((int(t[last]) + self.ttl_ms, int(made["prediction_id"]), int(made["predicted_label"]), float(made["confidence"])))
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(t[last]) + self.ttl_ms)
        yield pd.DataFrame(
            {"prediction_id": batch["prediction_id"], "text_key": key[0], "hit": ~done, "computed_id": served["prediction_id"],
             "predicted_label": served["predicted_label"], "confidence": served["confidence"]}
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.cached.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_ttl_dedup(
    stream: DataFrame, ttl_seconds: int = TTL_SECONDS, delay: int = 600, overwrite: str | None = None
) -> DataFrame:
    """Requests with the answer a result cache would serve; needs the RocksDB state store.

    ``stream`` has prediction_id, text_key, ts, predicted_label, confidence. A key's cached
    answer is dropped by an event-time timer, so state holds only keys seen within the period. Spark
    drops rows behind the watermark; ``LateRows`` counts them, and ``stream_ttl_batches`` serves them.
    """
    flagged = stream.select(
        "prediction_id",
        "text_key",
        "ts",
        F.unix_micros("ts").alias("us"),
        "predicted_label",
        "confidence",
        (F.col(overwrite) if overwrite else F.lit(False)).alias("overwrite"),
    )
    return (
        flagged.withWatermark("ts", f"{delay} seconds")
        .groupBy("text_key")
        .transformWithStateInPandas(TtlCache(ttl_seconds * 1_000), OUTPUT, "Append", "EventTime")
    )


REQUEST = "prediction_id bigint, text_key string, ts timestamp, predicted_label int, confidence double"


def write_ttl_batch(
    batch: DataFrame, batch_id: int, out: str, state: str, ttl_seconds: int, delay: int, hot_rows: int
) -> None:
    """Serve one micro-batch from the writes of the batches before, then store the writes that still count.

    Earlier writes join the batch as overwrites at their own time. A row more than ``delay`` behind the
    newest row of the batches before is late: computed on its own, it neither reads nor writes the cache.
    Output and state go to folders named by the batch, so a retried batch replaces its own.
    """
    spark = batch.sparkSession
    cols = ["prediction_id", "text_key", "ts", "predicted_label", "confidence"]
    earlier, newest = spark.createDataFrame([], REQUEST), None
    if batch_id:
        earlier = spark.read.schema(REQUEST).parquet(f"{state}/writes/batch={batch_id - 1}")
        newest = spark.read.schema("newest long").parquet(f"{state}/newest/batch={batch_id - 1}").first()["newest"]
    late = F.lit(False)
    if newest is not None:
        late = F.coalesce(F.unix_micros("ts") < newest - delay * 1_000_000, F.lit(False))
    on_time = batch.filter(~late).select(*cols, F.lit(False).alias("earlier"))
    both = on_time.unionByName(earlier.withColumn("earlier", F.lit(True)))
    payload = ["predicted_label", "confidence", "ts"]
    served = ttl_dedup(both, payload=payload, overwrite="earlier", ttl_seconds=ttl_seconds, hot_rows=hot_rows)
    served = served.withColumnRenamed("ts", "computed_ts").join(earlier.select("prediction_id"), "prediction_id", "left_anti")
    behind = batch.filter(late).select(
        "prediction_id", "text_key", F.lit(False).alias("hit"), F.col("prediction_id").alias("computed_id"),
        "predicted_label", "confidence", F.col("ts").alias("computed_ts"), F.lit(True).alias("late"),
    )
    served = served.withColumn("late", F.lit(False)).unionByName(behind)
    path = f"{out}/batch={batch_id}"
    served.write.mode("overwrite").parquet(path)

    seen = batch.agg(F.max(F.unix_micros("ts"))).first()[0]  # one number
    newest = max((x for x in (seen, newest) if x is not None), default=None)
    spark.createDataFrame([(newest,)], "newest long").coalesce(1).write.mode("overwrite").parquet(f"{state}/newest/batch={batch_id}")
    written = spark.read.schema(served.schema).parquet(path).filter("not hit and not late").withColumnRenamed("computed_ts", "ts")
    writes = written.select(*cols).unionByName(earlier).filter("text_key is not null")
    # an on-time row of the next batch is served by nothing older than this
    reach = (newest or 0) - (ttl_seconds + delay) * 1_000_000
    writes.filter(F.unix_micros("ts") >= reach).write.mode("overwrite").parquet(f"{state}/writes/batch={batch_id}")


def stream_ttl_batches(
    stream: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    ttl_seconds: int = TTL_SECONDS,
    delay: int = 600,
    hot_rows: int = HOT_ROWS,
):
    """The same de-duplication by the batch form per trigger, for streams with very hot keys.

    No task holds a key's whole trigger, at the price of rewriting the live writes each time. Every row is
    served: a late one, behind the newest before its batch by more than ``delay``, as a miss of its own.
    """
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_ttl_batch(batch, batch_id, out, state, ttl_seconds, delay, hot_rows)
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which typed state needs; later ones as before."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class LateRows(StreamingQueryListener):
    """Writes how many rows each trigger of the session's stateful streams dropped behind the watermark.

    A row per trigger that dropped any, in a folder named by stream and batch, so a retried batch counts once.
    The numbers are exact for operators that take rows as they come; an aggregation drops what is left of
    them after its first step, so windows have a ledger of their own (``windows.read_late``).
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(int(o.numRowsDroppedByWatermark) for o in progress.stateOperators)
        if dropped:
            row = self.spark.createDataFrame([(dropped,)], "dropped long").coalesce(1)
            row.write.mode("overwrite").json(f"{self.path}/stream={progress.id}/batch={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("dropped long, stream string, batch long").json(path)
