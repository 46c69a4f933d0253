"""Validation, lookups and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.operators import quality as q
from intentloom.operators.sampling import SPLITS, stratified_split
from intentloom.operators.scoring import centroid_logits, centroids
from intentloom.plans.fixtures import with_views
from intentloom.plans.sampling import SPLIT_SQL
from intentloom.sources import tables as t


def raw_samples(spark, d):
    """Labelled text as it might arrive: labels as text, some missing, unreadable or out of range."""
    i = F.col("sample_id") % 50
    label = F.when(i == 0, "x").when(i == 1, F.lit(None)).when(i == 2, "99").otherwise(F.col("label").cast("string"))
    text = F.when(i == 3, F.lit(None)).when(i == 4, F.lit("")).otherwise(F.col("text"))
    return t.samples20(spark, d).select("sample_id", text.alias("text"), label.alias("label"))


def schema_violations(spark, d):
    return q.schema_violations(raw_samples(spark, d), q.full_rules())


def schema_violations_min(spark, d):
    return q.schema_violations(raw_samples(spark, d), q.min_rules())


def class_distribution_check(spark, d):
    return q.class_distribution_check(t.samples20(spark, d), min_samples=50)


def validate_split(spark, d):
    return q.validate_split(t.samples20(spark, d), "all", q.full_rules(20), min_samples=10, expected=20)


def request_bounds(spark, d):
    talk = t.read_table(spark, d, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    docs = t.read_table(spark, d, "documents").withColumn("id", F.col("doc_id").cast("string"))
    return q.request_bounds(
        {
            "single": q.text_requests(talk.select("id", "text").unionByName(docs.select("id", "text")), "id"),
            "batch": q.batch_requests(talk, "conv_id", max_batch=3),
            "feedback": q.feedback_requests(t.feedback(spark, d), "feedback_id"),
        }
    )


def split_audit(spark, d):
    shares = {name: pct / 100 for name, pct in SPLITS.items()}
    return q.split_audit(stratified_split(t.samples(spark, d)), shares, num_classes=4)


def label_lookup(spark, d):
    """Names known for even labels only, so odd ones show the fallback; then back to numbers."""
    dictionary = t.event_dictionary(spark, d).filter("label % 2 = 0")
    log = t.predictions(spark, d).select("prediction_id", F.col("predicted_label").alias("label"))
    named = q.label_lookup(log, dictionary)
    return q.name_lookup(named, dictionary, out="back").select(
        "prediction_id", "label", "label_name", F.coalesce("back", F.lit(-1)).alias("back")
    )


def min_samples_guard(spark, d):
    return q.min_samples_guard(t.ref_cur(spark, d).filter("side = 'cur'"))


def nan_logit_check(spark, d):
    emb = t.embeddings(spark, d)
    return q.nan_logit_check(centroid_logits(emb, centroids(emb)))


def shared_columns(spark, d):
    log = t.ref_cur(spark, d)
    shared = ["prediction_id", "predicted_label_name", "confidence", F.col("ts").alias("created_at")]
    reference = log.filter("side = 'ref'").select(*shared, "latency_ms")
    current = log.filter("side = 'cur'").select(*shared, "client_id", "status")
    return q.shared_columns(reference, current)


def training_history(spark, d):
    """A training log shaped from the events: one epoch per day, train and evaluation rows interleaved."""
    day = F.dayofmonth("ts").cast("long")
    kind = F.col("event_type")
    log = t.read_table(spark, d, "events").groupBy(day.alias("epoch")).agg(
        F.avg(F.when(kind == "click", F.col("value"))).alias("loss"),
        F.avg(F.when(kind == "view", F.col("value"))).alias("eval_loss"),
        F.avg((kind == "purchase").cast("double")).alias("eval_f1_macro"),
    )
    even = F.col("epoch") % 2 == 0
    return log.select(
        "epoch",
        F.when(~even, F.round("loss", 6)).alias("loss"),
        *[F.when(even, F.round(c, 6)).alias(c) for c in ("eval_loss", "eval_f1_macro")],
    )


def history_series(spark, d):
    return q.history_series(training_history(spark, d), ["loss", "eval_loss", "eval_f1_macro"], "eval_f1_macro")


QUERIES = {
    f.__name__: f
    for f in (
        schema_violations, schema_violations_min, class_distribution_check, validate_split, request_bounds, split_audit,
        label_lookup, min_samples_guard, nan_logit_check, shared_columns, history_series,
    )
}

RAW_SQL = """raw as (select sample_id, case sample_id % 50 when 3 then null when 4 then '' else text end as text,
    case sample_id % 50 when 0 then 'x' when 1 then null when 2 then '99' else label::varchar end as label from samples20)"""


def _rules_sql(text_rules: dict[str, str]) -> str:
    rules = {
        **text_rules,
        "label_null": "label is null",
        "label_type": "label is not null and try_cast(label as int) is null",
        "label_range": "not try_cast(label as int) between 0 and 76",
    }
    parts = [f"select sample_id, '{name}' as rule from raw where {rule}" for name, rule in rules.items()]
    return RAW_SQL + "\n" + " union all ".join(parts)


ORACLE = {
    "schema_violations": with_views(
        _rules_sql({"text_null": "text is null", "text_length": "not length(text) between 1 and 512"}), "samples20"
    ),
    "schema_violations_min": with_views(_rules_sql({"text_null": "text is null", "text_empty": "length(text) < 1"}), "samples20"),
    "class_distribution_check": with_views(
        """c as (select label, count(*) as n from samples20 group by 1)
          select count(*) as classes_present, 77 - count(*) as classes_missing, min(n) as min_count, max(n) as max_count,
            count(*) filter (where n < 50) as low_classes, count(*) filter (where n < 50) = 0 as passed from c""",
        "samples20",
    ),
    "validate_split": with_views(
        """c as (select label, count(*) as n from samples20 group by 1),
          b as (select count(*) as n, count(*) filter (where text is null or length(text) not between 1 and 512
              or label is null or label not between 0 and 19) as bad from samples20)
          select 'all' as split, n as rows, bad as bad_rows, bad = 0 as schema_passed,
            (select min(n) >= 10 from c) as distribution_passed from b""",
        "samples20",
    ),
    "request_bounds": with_views(
        """one as (select concat_ws('-', conv_id, turn) as id, text from conversations
              union all select doc_id::varchar, text from documents),
          r as (select 'single' as kind, id as request_id, case when text is null then 'missing' when length(text) < 1 then 'too_short'
                when length(text) > 10000 then 'too_long' else 'ok' end as reason from one
              union all select 'batch', conv_id::varchar, case when count(text) < 1 then 'too_short'
                when count(text) > 3 then 'too_long' else 'ok' end from conversations group by conv_id
              union all select 'feedback', feedback_id, case when correct_label is null or correct_label < 0 then 'bad_label'
                when length(comment) > 1000 then 'too_long' else 'ok' end from feedback)
          select kind, request_id, reason = 'ok' as accepted, reason from r""",
        "feedback",
    ),
    "split_audit": with_views(
        f"""split as ({SPLIT_SQL}),
          s as (select split, count(*) as n, count(distinct label) as classes,
              count(*) filter (where coalesce(length(text), 0) < 1) as empty,
              count(distinct label) filter (where label not between 0 and 3) as outside from split group by 1),
          g as (select *, abs(n::double / (sum(n) over ()) - case split when 'train' then 0.7::double else 0.15::double end) as gap,
              (select count(distinct label) from split) as k from s)
          select 'share_gap:' || split as check, round(gap, 6) as value, gap <= 0.05 as passed from g
          union all select 'missing_classes:' || split, (k - classes)::double, k = classes from g
          union all select 'empty_texts:' || split, empty::double, empty = 0 from g
          union all select 'labels_out_of_range:' || split, outside::double, outside = 0 from g
          union all select 'shared_ids', count(*)::double, count(*) = 0 from
            (select sample_id from split group by 1 having count(distinct split) > 1)""",
        "samples",
    ),
    "label_lookup": with_views(
        """select prediction_id, predicted_label as label,
             case when predicted_label % 2 = 0 then predicted_label_name else 'class_' || predicted_label end as label_name,
             case when predicted_label % 2 = 0 then predicted_label else -1 end as back from predictions""",
        "predictions",
    ),
    "min_samples_guard": with_views(
        "select count(*) as rows, 50::bigint as min_samples, count(*) < 50 as too_few from ref_cur where side = 'cur'", "ref_cur"
    ),
    "nan_logit_check": with_views(
        """per as (select vec_id, bool_or(isnan(z)) as bad from logit group by 1)
          select count(*) as rows, count(*) filter (where bad) as nan_rows, count(*) filter (where bad) = 0 as passed from per""",
        "logit",
    ),
    "shared_columns": with_views("select confidence, predicted_label_name, prediction_id, side from ref_cur", "ref_cur"),
    "history_series": """with h as (select dayofmonth(ts) as epoch, avg(value) filter (where event_type = 'click') as loss,
            avg(value) filter (where event_type = 'view') as eval_loss, avg((event_type = 'purchase')::int::double) as f from events group by 1),
          s as (select 'loss' as series, epoch, round(loss, 6) as value from h where epoch % 2 = 1
            union all select 'eval_loss', epoch, round(eval_loss, 6) from h where epoch % 2 = 0
            union all select 'eval_f1_macro', epoch, round(f, 6) from h where epoch % 2 = 0)
          select series, epoch, value, epoch = (select arg_max(epoch, {'a': value, 'b': -epoch}) from s where series = 'eval_f1_macro')
            as best_epoch from s where value is not null""",
}
