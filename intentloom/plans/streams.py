"""Streaming jobs, each run over all files present and then stopped."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.plans.fixtures import with_views
from intentloom.plans.monitoring import CATEGORICAL, NUMERIC, SECONDS, at, keyed, moved, ttl_sql
from intentloom.plans.sources import ORACLE as SOURCE_ORACLE
from intentloom.session import scratch_path, through_table
from intentloom.sources import io
from intentloom.sources import tables as t
from intentloom.streaming import jobs, windows
from intentloom.streaming.source import event_stream
from intentloom.streaming.ttl import rocksdb, stream_ttl_batches, stream_ttl_dedup

DELAY = 600


def run_all(writer) -> None:
    """Process what is there, then stop; an error in the stream is raised here."""
    writer.trigger(availableNow=True).start().awaitTermination()


def _requests(spark, d):
    return event_stream(spark, f"{d}/events.parquet")


def _to_table(spark, stream, purpose):
    """Run ``stream`` into a parquet table and read it back."""
    path, checkpoint = scratch_path(spark, purpose), scratch_path(spark, "checkpoint")
    run_all(
        stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    return spark.read.schema(stream.schema).parquet(path)


def _utc(c):
    return at(io.utc_clock(c))


def _shown(metrics):
    """Window metrics as the checks read them."""
    numbers = ("latency_mean", "latency_p50", "latency_p95", "mean_confidence", "confidence_min", "error_rate", "throughput_per_sec")
    return metrics.select("window", _utc("window_start").alias("window_start"), "count", *[F.round(c, 6).alias(c) for c in numbers])


def stream_window_metrics(spark, d):
    """Closed windows of one minute, five minutes and one hour (the longer ones sliding), from one stream."""
    folder = scratch_path(spark, "windows")
    run_all(windows.stream_windows(_requests(spark, d), folder, scratch_path(spark, "checkpoint"), delay=DELAY))
    return _shown(windows.read_windows(spark, folder))


def stream_alerts(spark, d):
    path, folder, checkpoint = (scratch_path(spark, p) for p in ("alerts", "windows", "checkpoint"))
    run_all(windows.stream_alerts(_requests(spark, d), path, folder, checkpoint, {"1hour": (3600, 3600)}, DELAY))
    return io.read_alerts(spark, path).select("type", "severity", F.round("value", 6).alias("value"), "threshold")


def _arrivals(spark, d, behind: int, upto: int):
    """The events with the batch they arrive in: quarters of their time, every seventh of the quarters up to
    ``upto`` comes ``behind`` quarters too late."""
    events = t.read_table(spark, d, "events").withColumn("us", t.micros("ts"))
    span = events.agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    share = (F.col("us") - span.select("lo").scalar()) / (span.select("hi").scalar() - span.select("lo").scalar() + 1)
    slow = (F.col("event_id") % 7 == 0) & (F.col("quarter") <= upto)
    events = events.withColumn("quarter", F.floor(share * 4))
    events = events.withColumn("arrival", F.col("quarter") + F.when(slow, behind).otherwise(0)).drop("us", "quarter")
    return through_table(events, "arrivals")


def _late_stream(spark, d):
    """Folder of window tables after all arrivals were streamed, one trigger for each."""
    files, folder, checkpoint = (scratch_path(spark, p) for p in ("arrivals", "windows", "checkpoint"))
    arrivals = _arrivals(spark, d, 1, 3)
    for k in range(5):
        arrivals.filter(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(files)
        run_all(windows.stream_windows(event_stream(spark, files), folder, checkpoint, delay=DELAY))
    return folder


def stream_late_rows(spark, d):
    """Where every row went when a seventh of them arrives too late: closed minutes, open ones, the ledger."""
    folder = _late_stream(spark, d)
    parts = {"closed": windows.read_minutes, "open": windows.read_open, "late": windows.read_late}
    tables = [read(spark, folder).select(F.lit(name).alias("found_in"), "minute", "n") for name, read in parts.items()]
    whole = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return whole.groupBy("found_in", _utc(F.timestamp_seconds("minute")).alias("minute")).agg(F.sum("n").alias("n"))


def stream_ttl(spark, d):
    stream = keyed(_requests(spark, d))
    out = stream_ttl_dedup(stream.select("prediction_id", "text_key", "ts", "predicted_label", "confidence"), delay=DELAY)
    with rocksdb(spark):
        return _to_table(spark, out, "ttl")


def stream_ttl_by_batch(spark, d):
    """The form for very hot keys: the batch operator per trigger, live writes carried in a table."""
    out, state, checkpoint = (scratch_path(spark, p) for p in ("ttl-out", "ttl-state", "checkpoint"))
    run_all(stream_ttl_batches(keyed(_requests(spark, d)), out, state, checkpoint, delay=DELAY))
    cols = ["prediction_id", "text_key", "hit", "computed_id", "predicted_label", "confidence"]
    return spark.read.parquet(out).select(*cols)


def stream_ttl_late(spark, d):
    """The same when a seventh of the first half arrives too late: those are served as misses of their own."""
    files, out, state, checkpoint = (scratch_path(spark, p) for p in ("arrivals", "ttl-out", "ttl-state", "checkpoint"))
    arrivals = _arrivals(spark, d, 2, 1)
    for k in range(4):
        arrivals.filter(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(files)
        run_all(stream_ttl_batches(keyed(event_stream(spark, files)), out, state, checkpoint, delay=DELAY))
    cols = ["prediction_id", "text_key", "hit", "computed_id", "predicted_label", "confidence", "late"]
    return spark.read.parquet(out).select(*cols)


def stream_logs(spark, d):
    path, checkpoint = scratch_path(spark, "audit"), scratch_path(spark, "checkpoint")
    run_all(jobs.stream_logs(_requests(spark, d), path, checkpoint))
    details = F.from_json("details", "text_preview string, prediction struct<label:int,confidence:double>")
    return spark.read.parquet(path).select(
        "id", "action", details["text_preview"].alias("text_preview"),
        details["prediction"]["label"].cast("long").alias("label"), details["prediction"]["confidence"].alias("confidence"),
    )


def stream_metric_log(spark, d):
    path, checkpoint = scratch_path(spark, "metric-log"), scratch_path(spark, "checkpoint")
    run_all(jobs.stream_metric_log(_requests(spark, d), path, checkpoint))
    return spark.read.parquet(path).select(_utc("timestamp").alias("timestamp"), "latency_ms", "confidence", "label")


def stream_monitor(spark, d):
    """The second half of the log as a stream in four triggers, its values moved, against the first half.

    Returned is the decision after the last trigger, over all of them.
    """
    files, folder, checkpoint = (scratch_path(spark, p) for p in ("arrivals", "monitor", "checkpoint"))
    arrivals = t.read_table(spark, d, "events").filter(F.expr(f"ts >= {t.SPLIT_DAY}"))
    arrivals = through_table(arrivals.withColumn("arrival", F.pmod("event_id", F.lit(4))), "arrivals")
    reference = t.ref_cur(spark, d).filter("side = 'ref'")
    for k in range(4):
        arrivals.filter(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(files)
        stream = moved(event_stream(spark, files), F.lit(True))
        run_all(jobs.stream_monitor(stream, reference, folder, checkpoint, NUMERIC, CATEGORICAL))
    out = jobs.read_decisions(spark, folder).filter("batch = 3")
    codes = F.transform("reasons", lambda r: F.split_part(r, F.lit(":"), F.lit(1)))
    return out.select("should_retrain", F.array_join(codes, ",").alias("reasons"), "drift_detected", "alert_count")


QUERIES = {
    "stream_window_metrics": stream_window_metrics,
    "stream_alerts": stream_alerts,
    "stream_late_rows": stream_late_rows,
    "stream_ttl_dedup": stream_ttl,
    "stream_ttl_batches": stream_ttl_by_batch,
    "stream_ttl_late": stream_ttl_late,
    "stream_logs": stream_logs,
    "stream_metric_log": stream_metric_log,
    "stream_monitor": stream_monitor,
}

CLOSED = f"(select max(ts) - interval '{DELAY} seconds' from predictions)"
_METRICS = """count(*) as count, avg(latency_ms) as latency_mean, quantile_cont(latency_ms, 0.5) as latency_p50,
    quantile_cont(latency_ms, 0.95) as latency_p95, avg(confidence) as mean_confidence, min(confidence) as confidence_min,
    avg((status >= 400)::int::double) as error_rate"""


def _windows_sql() -> str:
    parts = []
    for name, size, slide in (("1min", 60, 60), ("5min", 300, 60), ("1hour", 3600, 600)):
        parts.append(
            f"""select '{name}' as "window", time_bucket(interval '{slide} seconds', ts) - to_seconds(k * {slide}) as w, {size} as size, {_METRICS}
              from predictions cross join (select unnest(range(0, {size // slide})) as k) group by 2"""
        )
    return f"""m as ({' union all '.join(parts)})
      select "window", strftime(w, '{SECONDS}') as window_start, count, round(latency_mean, 6) as latency_mean, round(latency_p50, 6) as latency_p50,
        round(latency_p95, 6) as latency_p95, round(mean_confidence, 6) as mean_confidence, round(confidence_min, 6) as confidence_min,
        round(error_rate, 6) as error_rate, round(count::double / size, 6) as throughput_per_sec
      from m where w + to_seconds(size) <= {CLOSED}"""


from intentloom.plans.monitoring import ORACLE as MONITOR_ORACLE  # noqa: E402

ORACLE = {
    "stream_window_metrics": with_views(_windows_sql(), "predictions"),
    "stream_alerts": with_views(
        f"""m as (select time_bucket(interval '1 hour', ts) as w, {_METRICS} from predictions group by 1),
          c as (select * from m where w + interval '1 hour' <= {CLOSED}),
          a as (select 'confidence_drop' as type, 'warning' as severity, mean_confidence as value, 0.7::double as threshold from c where mean_confidence < 0.7::double
            union all select 'error_rate_spike', 'critical', error_rate, 0.05 from c where error_rate > 0.05::double
            union all select 'latency_spike', 'warning', latency_p95, 100 from c where latency_p95 > 100)
          select type, severity, round(value, 6) as value, threshold from a""",
        "predictions",
    ),
    "stream_late_rows": with_views(
        f"""s as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from predictions),
          a as (select epoch_us(ts) // 60000000 * 60 as minute, epoch_us(ts) // 1000000 as sec,
              floor((epoch_us(ts) - lo)::double / (hi - lo + 1) * 4)::int + (prediction_id % 7 = 0)::int as k from predictions, s),
          top as (select k, max(max(sec)) over (order by k) - {DELAY} as mark from a group by k),
          f as (select case when minute + 60 <= lag_mark then 'late' when minute + 60 <= (select max(mark) from top) then 'closed'
              else 'open' end as found_in, minute
            from a left join (select k + 1 as k, mark as lag_mark from top) using (k))
          select found_in, strftime(to_timestamp(minute) at time zone 'UTC', '{SECONDS}') as minute, count(*) as n from f group by 1, 2""",
        "predictions",
    ),
    "stream_ttl_dedup": with_views(ttl_sql("false"), "predictions"),
    "stream_ttl_batches": with_views(ttl_sql("false"), "predictions"),
    "stream_ttl_late": with_views(
        """s as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from predictions),
          slow as (select p.* from predictions p, s where prediction_id % 7 = 0 and floor((epoch_us(ts) - lo)::double / (hi - lo + 1) * 4) <= 1),
          quick as (select * from predictions where prediction_id not in (select prediction_id from slow)),"""
        + ttl_sql("false", "quick", ", false as late")
        + """ union all select prediction_id, sha256(text) as text_key, false as hit, prediction_id as computed_id, predicted_label, confidence,
          true as late from slow""",
        "predictions",
    ),
    "stream_logs": with_views(
        """select prediction_id as id, 'prediction' as action, substr(text, 1, 200) as text_preview,
             predicted_label::bigint as label, confidence from predictions""",
        "predictions",
    ),
    "stream_metric_log": SOURCE_ORACLE["metric_log_sink"],
    "stream_monitor": MONITOR_ORACLE["retrain_trigger"],
}
