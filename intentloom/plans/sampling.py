"""Splits, samples, augmentation and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.functions.text import SYNONYMS, random_swap, synonym_replace
from intentloom.operators import sampling as s
from intentloom.plans.fixtures import with_views
from intentloom.sources import tables as t

SHOTS, SAMPLE_ROWS, FIRST_ROWS = 8, 200, 100


def stratified_split(spark, d):
    return s.stratified_split(t.samples(spark, d)).select("sample_id", F.col("label").cast("long").alias("label"), "split")


def few_shot_sample(spark, d):
    return s.few_shot_sample(t.samples20(spark, d), SHOTS).select("sample_id", "label_name", F.length("text").alias("chars"))


def first_per_class(spark, d):
    return s.first_per_class(t.samples20(spark, d)).select("sample_id", "label", "text")


def class_samples(spark, d):
    return s.class_samples(t.samples20(spark, d)).select("sample_id", "label_name", "text")


def bounded_sample(spark, d):
    samples = t.samples(spark, d)
    drawn = s.bounded_sample(samples, SAMPLE_ROWS).select(F.lit("drawn").alias("kind"), "sample_id", "text")
    return drawn.unionByName(s.first_rows(samples, FIRST_ROWS).select(F.lit("first").alias("kind"), "sample_id", "text"))


def augment_minority(spark, d):
    return s.augment_minority(t.samples20(spark, d).select("sample_id", "text", "label"))


def _augment_langs(spark, d):
    return s.augment_minority(t.samples(spark, d).select("sample_id", "text", "label"))


def synonyms(spark, d):
    return t.samples(spark, d).select("sample_id", synonym_replace("text", 2, WIDE_SYNONYMS).alias("text"))


def swap(spark, d):
    return t.samples(spark, d).select("sample_id", random_swap("text", ["sample_id"]).alias("text"))


def class_weights(spark, d):
    return s.class_weights(t.samples20(spark, d), "label_name", decimals=6)


def class_weights_rows(spark, d):
    return s.with_class_weights(t.samples(spark, d), "label").select(
        "sample_id", "label", F.round("weight", 6).alias("weight")
    )


# the invented prose holds few banking words, so the column op is also run with words it does hold
WIDE_SYNONYMS = {**SYNONYMS, "the": "this", "le": "un", "der": "ein", "el": "un", "and": "plus"}

SPLIT_SQL = """select sample_id, text, label_name, label,
    case when rn * 100 <= 70 * n then 'train' when rn * 100 <= 85 * n then 'val' else 'test' end as split
  from (select *, row_number() over (partition by label order by md5('42|' || sample_id)) as rn,
               count(*) over (partition by label) as n from samples)"""


def augment_sql(view: str) -> str:
    m = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in SYNONYMS.items()) + "}"
    return f"""
      cnt as (select label, count(*) as n from {view} group by 1),
      med as (select floor(quantile_cont(n, 0.5))::bigint as m from cnt),
      fresh as (select label, n, unnest(range(1, m - n + 1)) as copy_no from cnt, med where n < m),
      ranked as (select *, row_number() over (partition by label order by md5('42|' || sample_id)) as rn from {view}),
      drawn as (select f.label, f.copy_no, r.sample_id, r.text, regexp_extract_all(r.text, '\\S+') as w,
          ('0x' || substr(md5('42coin|' || f.label || '|' || f.copy_no), 1, 15))::bigint % 2 as coin,
          ('0x' || substr(md5('swap0a|' || f.label || '|' || f.copy_no), 1, 15))::bigint as ha,
          ('0x' || substr(md5('swap0b|' || f.label || '|' || f.copy_no), 1, 15))::bigint as hb
        from fresh f join ranked r on r.label = f.label
         and r.rn = ('0x' || substr(md5('42pick|' || f.label || '|' || f.copy_no), 1, 15))::bigint % f.n + 1),
      spots as (select *, case when len(w) > 1 then ha % len(w) end as a,
          case when len(w) > 1 then (ha % len(w) + 1 + hb % (len(w) - 1)) % len(w) end as b,
          list_filter(range(1, len(w) + 1), lambda i: map_contains({m}, lower(w[i])))[1] as hit from drawn),
      made as (select label, sample_id, copy_no, case
          when coin = 0 then array_to_string(list_transform(w, lambda x, i: case when i = hit then {m}[lower(x)] else x end), ' ')
          when len(w) < 2 then text
          else array_to_string(list_transform(range(0, len(w)), lambda k:
              case when k = a then w[b + 1] when k = b then w[a + 1] else w[k + 1] end), ' ') end as text from spots)
      select label, text, sample_id as source_id, 0::bigint as copy_no from {view}
      union all select label, text, sample_id, copy_no from made"""


QUERIES = {
    "stratified_split": stratified_split,
    "few_shot_sample": few_shot_sample,
    "first_per_class": first_per_class,
    "class_samples": class_samples,
    "bounded_sample": bounded_sample,
    "augment_minority": augment_minority,
    "augment_minority_langs": _augment_langs,
    "synonym_replace": synonyms,
    "random_swap": swap,
    "class_weights": class_weights,
    "class_weights_rows": class_weights_rows,
}

_WIDE = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in WIDE_SYNONYMS.items()) + "}"
ORACLE = {
    "stratified_split": with_views(
        f"split as ({SPLIT_SQL}) select sample_id, label::bigint as label, split from split", "samples"
    ),
    "few_shot_sample": with_views(
        f"""select sample_id, label_name, length(text) as chars from
          (select *, row_number() over (partition by label order by md5('42|' || sample_id)) as rn from samples20) where rn <= {SHOTS}""",
        "samples20",
    ),
    "first_per_class": with_views(
        """select min(sample_id) as sample_id, label, arg_min(text, sample_id) as text from samples20
           group by label order by label limit 8""",
        "samples20",
    ),
    "class_samples": with_views(
        """select sample_id, label_name, text from (
             select *, row_number() over (partition by label_name order by md5('42|' || sample_id)) as rn from samples20
             where label_name in (select label_name from samples20 group by 1 order by md5('42|' || label_name) limit 5))
           where rn <= 3""",
        "samples20",
    ),
    "bounded_sample": with_views(
        f"""select * from (select 'drawn' as kind, sample_id, text from samples order by md5('42|' || sample_id) limit {SAMPLE_ROWS})
            union all select * from (select 'first', sample_id, text from samples order by sample_id limit {FIRST_ROWS})""",
        "samples",
    ),
    "augment_minority": with_views(augment_sql("samples20"), "samples20"),
    "augment_minority_langs": with_views(augment_sql("samples"), "samples"),
    "synonym_replace": with_views(
        f"""w as (select sample_id, regexp_extract_all(text, '\\S+') as w from samples),
          h as (select *, list_slice(list_filter(range(1, len(w) + 1), lambda i: map_contains({_WIDE}, lower(w[i]))), 1, 2) as hits from w)
          select sample_id, array_to_string(list_transform(w, lambda x, i:
            case when list_contains(hits, i) then {_WIDE}[lower(x)] else x end), ' ') as text from h""",
        "samples",
    ),
    "random_swap": with_views(
        """w as (select sample_id, text, regexp_extract_all(text, '\\S+') as w,
             ('0x' || substr(md5('swap0a|' || sample_id), 1, 15))::bigint as ha,
             ('0x' || substr(md5('swap0b|' || sample_id), 1, 15))::bigint as hb from samples),
          p as (select *, case when len(w) > 1 then ha % len(w) end as a,
             case when len(w) > 1 then (ha % len(w) + 1 + hb % (len(w) - 1)) % len(w) end as b from w)
          select sample_id, case when len(w) < 2 then text else array_to_string(list_transform(range(0, len(w)), lambda k:
             case when k = a then w[b + 1] when k = b then w[a + 1] else w[k + 1] end), ' ') end as text from p""",
        "samples",
    ),
    "class_weights": with_views(
        """c as (select label_name, count(*) as n from samples20 group by 1),
          x as (select label_name, n, (sum(n) over ())::double / ((count(*) over ()) * n) as weight from c)
          select label_name, n, round(weight, 6) as weight, round(min(weight) over (), 6) as min_weight,
            round(max(weight) over (), 6) as max_weight from x""",
        "samples20",
    ),
    "class_weights_rows": with_views(
        """c as (select label, count(*) as n from samples group by 1),
          x as (select label, (sum(n) over ())::double / ((count(*) over ()) * n) as weight from c)
          select sample_id, label, round(weight, 6) as weight from samples join x using (label)""",
        "samples",
    ),
}
