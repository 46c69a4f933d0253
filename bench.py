"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from intentloom.plans.catalog import QUERIES  # noqa: E402
from intentloom.session import local_session  # noqa: E402

HEADLINE = """
load_union schema_violations validate_split split_audit stratified_split few_shot_sample augment_minority_langs
class_weights_rows text_lengths length_stats length_histograms top_words class_documents class_tfidf
class_overlap_pairs tfidf_features text_key_counts text_overview linear_attribution batch_score minmax_scale
confusion_matrix per_class_report classification_metrics model_comparison validation_gate numeric_drift
categorical_drift drift_summary alert_check window_summary window_summary_day threshold_alerts feedback_stats
request_rate request_histogram bucket_quantiles error_rate rate_limit_audit ttl_dedup ttl_dedup_overwrite
audit_rows metric_log_sink train_logreg stream_window_metrics stream_ttl_dedup
""".split()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "label_distribution", sf_dir)  # warm the session up
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
