"""Scoring, metrics and gates on nearest-centre predictions of the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.functions.scale import broadcast_small
from intentloom.operators import evaluation as e
from intentloom.operators import scoring as s
from intentloom.operators.quality import nan_logit_check
from intentloom.plans.fixtures import with_views
from intentloom.sources import tables as t

MEASURES = ("euclidean", "manhattan", "cosine")


def logits(spark, d):
    emb = t.embeddings(spark, d)
    return s.centroid_logits(emb, s.centroids(emb))


def emb_dictionary(spark, d):
    """Names for the classes below 7; the rest show the fallback."""
    labels = t.embeddings(spark, d).select("label").distinct().filter("label < 7")
    return labels.select("label", F.concat(F.lit("topic_"), F.col("label").cast("string")).alias("label_name"))


def scored(spark, d):
    return s.batch_score(logits(spark, d), emb_dictionary(spark, d))


def eval_pairs(spark, d):
    return logits(spark, d).select("label", s.argmax("logits").alias("predicted_label"))


def model_pairs(spark, d):
    """Predictions of three models, from one scan: the nearest centre by three measures."""
    emb = t.embeddings(spark, d)
    centers = broadcast_small(s.centroids(emb))
    for m in MEASURES:
        emb = s.centroid_logits(emb, centers, measure=m, out=m)
    calls = [F.struct(F.lit(m).alias("model"), s.argmax(m).alias("predicted_label")) for m in MEASURES]
    return emb.select("label", F.inline(F.array(*calls)))


def batch_score(spark, d):
    return scored(spark, d).select(
        "vec_id", F.col("predicted_label").cast("long").alias("predicted_label"), "predicted_label_name", "confidence"
    )


def low_confidence(spark, d):
    return s.low_confidence_share(scored(spark, d).select("confidence"), 0.9)


def low_confidence_rows(spark, d):
    return s.low_confidence(t.predictions(spark, d)).select("prediction_id", "confidence", "low_confidence", "message")


def confidence_tiers(spark, d):
    return s.confidence_tiers(t.predictions(spark, d))


def prediction_summary(spark, d):
    """Both sides of the log, and how many of their rows are of doubtful confidence."""
    log = t.ref_cur(spark, d).withColumn("doubtful", F.col("confidence") < 0.5)
    sides = [s.prediction_summary(log.filter(F.col("side") == x), "doubtful").withColumn("side", F.lit(x)) for x in ("ref", "cur")]
    return sides[0].unionByName(sides[1])


def minmax_scale(spark, d):
    scaled = s.minmax_scale(t.embeddings(spark, d)).select("vec_id", F.posexplode("scaled").alias("pos", "x"))
    return scaled.select("vec_id", "pos", F.round("x", 6).alias("scaled"))


def confusion_matrix(spark, d):
    return e.confusion_matrix(eval_pairs(spark, d)).select(
        F.col("true_label").cast("long").alias("true_label"), F.col("predicted_label").cast("long").alias("predicted_label"), "n"
    )


def per_class_report(spark, d):
    report = e.per_class_report(eval_pairs(spark, d))
    return report.select(F.col("label").cast("long").alias("label"), "precision", "recall", "f1_score", "support")


def classification_metrics(spark, d):
    return e.classification_metrics(eval_pairs(spark, d))


def metrics_long(spark, d):
    return e.metrics_long(e.classification_metrics(eval_pairs(spark, d)), prefix="test_")


def model_comparison(spark, d):
    return e.model_comparison(e.classification_metrics(model_pairs(spark, d), by=["model"]))


def macro_f1_from_report(spark, d):
    return e.macro_f1_from_report(e.per_class_report(model_pairs(spark, d), by=["model"]))


def runs(spark, d):
    """A run log shaped from the events: the experiment is the event type, the run a client group."""
    log = t.predictions(spark, d)
    group = F.col("client_id") % 20
    return log.groupBy(F.col("predicted_label_name").alias("experiment"), group.alias("run_id")).agg(
        F.round(F.avg("confidence"), 6).alias("f1_macro"), F.count(F.lit(1)).alias("samples")
    ).withColumn("run_name", F.when(F.col("run_id") % 2 == 0, "baseline").otherwise("tuned"))


def best_run(spark, d):
    log = runs(spark, d)
    cols = ["experiment", "run_id", "run_name", "f1_macro", "samples"]
    return e.best_run(log).select(F.lit("any").alias("filter"), *cols).unionByName(
        e.best_run(log, "baseline").select(F.lit("baseline").alias("filter"), *cols)
    )


def variant_latency(spark, d):
    return e.variant_latency(t.predictions(spark, d), "click", "predicted_label_name")


def validation_gate(spark, d):
    metrics = classification_metrics(spark, d)
    return e.validation_gate(metrics, t.predictions(spark, d), nan_logit_check(logits(spark, d)))


def promotion_gate(spark, d):
    by_model = e.classification_metrics(model_pairs(spark, d), by=["model"])
    return e.promotion_gate(by_model, 0.4)


QUERIES = {
    f.__name__: f
    for f in (
        batch_score, low_confidence, low_confidence_rows, confidence_tiers, prediction_summary, minmax_scale,
        confusion_matrix, per_class_report, classification_metrics, metrics_long, model_comparison, macro_f1_from_report,
        best_run, variant_latency, validation_gate, promotion_gate,
    )
}


def report_sql(pairs: str, by: str = "", rounded: bool = True) -> str:
    """CTE ``report`` of per-class metrics, optionally per ``by`` column."""
    key, using = (f"{by}, ", f"({by}, label)") if by else ("", "(label)")
    r = (lambda x: f"round({x}, 6)") if rounded else (lambda x: x)
    return f"""sup as (select {key}label, count(*) as support, count(*) filter (where label = predicted_label) as tp from {pairs} group by all),
      prd as (select {key}predicted_label as label, count(*) as predicted from {pairs} group by all),
      report0 as (select {key}label, coalesce(tp, 0) as tp, coalesce(support, 0) as support, coalesce(predicted, 0) as predicted
        from sup full join prd using {using}),
      report as (select *, {r("case when predicted = 0 then 0 else tp::double / predicted end")} as precision,
        {r("case when support = 0 then 0 else tp::double / support end")} as recall,
        {r("case when predicted + support = 0 then 0 else 2::double * tp / (predicted + support) end")} as f1_score from report0)
    """


def _metrics_sql(by: str = "") -> str:
    key, group = (f"{by}, ", f" group by {by}") if by else ("", "")
    cols = ["round(sum(tp)::double / sum(support), 6) as accuracy"]
    for m, c in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score")):
        cols.append(f"round(avg({c}), 6) as {m}_macro")
        cols.append(f"round(sum({c} * support) / sum(support), 6) as {m}_weighted")
    cols.append("round(sum(tp)::double / sum(predicted), 6) as precision_micro")
    cols.append("round(sum(tp)::double / sum(support), 6) as recall_micro")
    cols.append("round(2::double * sum(tp) / (sum(predicted) + sum(support)), 6) as f1_micro")
    return f", metrics as (select {key}{', '.join(cols)} from report{group})\n"


METRICS_SQL = _metrics_sql()

# the same three models from the raw vectors
MODELS_SQL = """near as (select e.vec_id, any_value(e.label) as label, t.c, -sum((e.v - t.m) * (e.v - t.m)) as euclidean,
      -sum(abs(e.v - t.m)) as manhattan, sum(e.v * t.m) / sqrt(sum(e.v * e.v)) / sqrt(sum(t.m * t.m)) as cosine
    from emb_long e join centers t using (d) group by 1, 3),
  mlogit as (unpivot near on euclidean, manhattan, cosine into name model value z),
  mpairs as (select model, vec_id, any_value(label) as label, arg_min(c, {'a': -z, 'b': c}) as predicted_label
    from mlogit group by 1, 2),
"""

ORACLE = {
    "batch_score": with_views(
        """select vec_id, predicted_label::bigint as predicted_label, case when predicted_label < 7 then 'topic_' else 'class_' end
             || predicted_label as predicted_label_name, round(confidence, 4) as confidence from scored""",
        "scored",
    ),
    "low_confidence": with_views(
        """select count(*) as rows, count(*) filter (where round(confidence, 4) < 0.9::double) as flagged,
             round(count(*) filter (where round(confidence, 4) < 0.9::double)::double / count(*), 6) as flagged_share from scored""",
        "scored",
    ),
    "low_confidence_rows": with_views(
        """select prediction_id, confidence, confidence < 0.5::double as low_confidence,
             case when confidence < 0.5::double then 'Low confidence - consider human review' end as message from predictions""",
        "predictions",
    ),
    "confidence_tiers": with_views(
        """select case when confidence >= 0.8::double then 'high' when confidence >= 0.5::double then 'medium' else 'low' end as tier,
             count(*) as n from predictions group by 1""",
        "predictions",
    ),
    "prediction_summary": with_views(
        """select side, count(*) as rows, round(avg(confidence), 6) as mean_confidence, round(min(confidence), 6) as min_confidence,
             count(distinct predicted_label) as distinct_labels, count(*) filter (where confidence < 0.5::double) as labels_changed,
             round(avg((confidence < 0.5::double)::int::double), 6) as changed_share
           from ref_cur group by 1""",
        "ref_cur",
    ),
    "minmax_scale": with_views(
        """x as (select vec_id, d - 1 as pos, (v - min(v) over (partition by vec_id))
             / (max(v) over (partition by vec_id) - min(v) over (partition by vec_id) + 1e-8::double) as s from emb_long)
          select vec_id, pos, round(s, 6) as scaled from x""",
        "emb_long",
    ),
    "confusion_matrix": with_views(
        """l as (select label from scored union select predicted_label from scored)
          select a.label::bigint as true_label, b.label::bigint as predicted_label, count(s.vec_id) as n
          from l a cross join l b left join scored s on s.label = a.label and s.predicted_label = b.label group by 1, 2""",
        "scored",
    ),
    "per_class_report": with_views(
        report_sql("scored") + "select label::bigint as label, precision, recall, f1_score, support from report", "scored"
    ),
    "classification_metrics": with_views(report_sql("scored", rounded=False) + METRICS_SQL + "select * from metrics", "scored"),
    "metrics_long": with_views(
        report_sql("scored", rounded=False) + METRICS_SQL
        + "select 'test_' || metric as metric, value from (unpivot metrics on columns(*) into name metric value value)",
        "scored",
    ),
    "model_comparison": with_views(
        MODELS_SQL + report_sql("mpairs", "model", rounded=False) + _metrics_sql("model")
        + "select row_number() over (order by f1_macro desc, model) as rank, * from metrics",
        "emb_long", "centers",
    ),
    "macro_f1_from_report": with_views(
        MODELS_SQL + report_sql("mpairs", "model") + "select model, round(avg(f1_score), 9) as f1_macro from report group by 1",
        "emb_long", "centers",
    ),
    "best_run": with_views(
        """r as (select predicted_label_name as experiment, client_id % 20 as run_id, round(avg(confidence), 6) as f1_macro,
             count(*) as samples, case when client_id % 20 % 2 = 0 then 'baseline' else 'tuned' end as run_name
             from predictions group by 1, 2, 5),
          x as (select 'any' as filter, * from r union all select 'baseline', * from r where run_name = 'baseline')
          select filter, experiment, run_id, run_name, f1_macro, samples from x
          qualify row_number() over (partition by filter, experiment order by f1_macro desc, run_id) = 1""",
        "predictions",
    ),
    "variant_latency": with_views(
        """m as (select predicted_label_name, avg(latency_ms) as m, count(*) as n_samples from predictions group by 1)
          select predicted_label_name, n_samples, round(m, 6) as mean_latency_ms,
            round((select m from m where predicted_label_name = 'click') / m, 2) as speedup from m""",
        "predictions",
    ),
    "validation_gate": with_views(
        report_sql("scored", rounded=False) + METRICS_SQL + """, checks as (
            select 'accuracy' as metric_name, accuracy as actual, 0.9::double as threshold, '>=' as comparison, accuracy >= 0.9 as passed from metrics
            union all select 'f1_score', f1_weighted, 0.9, '>=', f1_weighted >= 0.9 from metrics
            union all select 'latency_ms', avg(latency_ms), 100, '<=', avg(latency_ms) <= 100 from predictions
            union all select 'no_nan_predictions', (not bool_or(isnan(z)))::int::double, 1, '>=', not bool_or(isnan(z)) from logit)
          select metric_name, round(actual, 6) as actual_value, threshold, comparison, passed, bool_and(passed) over () as all_passed from checks""",
        "scored", "predictions",
    ),
    "promotion_gate": with_views(
        MODELS_SQL + report_sql("mpairs", "model", rounded=False) + _metrics_sql("model")
        + """select f1_weighted, 0.4::double as threshold,
             case when f1_weighted < 0.4::double then 'NOT_REGISTERED' else 'REGISTERED' end as status from metrics""",
        "emb_long", "centers",
    ),
}
