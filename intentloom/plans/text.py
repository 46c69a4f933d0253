"""Text profile, TF-IDF, class overlap and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from intentloom.functions.text import STOPWORDS
from intentloom.operators import explain, features, overlap, profiling
from intentloom.plans.fixtures import with_views
from intentloom.session import through_table
from intentloom.sources import tables as t


def text_lengths(spark, d):
    out = profiling.text_lengths(t.samples(spark, d))
    return out.select("sample_id", F.col("text_length").cast("long").alias("text_length"), F.col("word_count").cast("long").alias("word_count"))


def length_stats(spark, d):
    return profiling.length_stats(t.samples20(spark, d))


def class_count_stats(spark, d):
    return profiling.class_count_stats(t.samples(spark, d))


def underrepresented_classes(spark, d):
    return profiling.underrepresented_classes(t.samples(spark, d))


def length_histograms(spark, d):
    return profiling.length_histograms(t.samples(spark, d))


def top_words(spark, d):
    return profiling.top_words(t.samples(spark, d))


def class_documents(spark, d):
    return profiling.class_documents(t.samples20(spark, d), rows_per_part=250)


def class_tfidf(spark, d):
    out = features.class_tfidf(t.samples20(spark, d))
    return out.select("label_name", "term", "tf", F.round("weight", 6).alias("weight"))


def class_overlap_pairs(spark, d):
    return overlap.class_overlap_pairs(features.class_tfidf(t.samples20(spark, d)))


def overlap_submatrix(spark, d):
    return overlap.overlap_submatrix(features.class_tfidf(t.samples20(spark, d)))


def tfidf_features(spark, d):
    out = features.tfidf_features(t.samples(spark, d))
    return out.select("sample_id", "term", F.round("weight", 6).alias("weight"))


def text_key(spark, d):
    return profiling.text_keys(t.samples(spark, d))


def text_key_counts(spark, d):
    return profiling.text_key_counts(t.samples(spark, d))


def _sided(spark, d):
    """Texts in two sides: the first ten sources are the reference."""
    side = F.when(F.col("label") < 10, "ref").otherwise("cur").alias("side")
    return t.samples20(spark, d).select("text", side)


def text_overview(spark, d):
    return profiling.text_overview(_sided(spark, d))


def _attribution_parts(spark, d):
    """A linear model whose coefficients are the class TF-IDF weights, and the spread of each term."""
    samples = t.samples(spark, d)
    coefficients = features.class_tfidf(samples).select(
        F.col("label_name").alias("class_name"), "term", F.col("weight").alias("w")
    )
    # the means and the gaps both read the long table: it is made once
    long = through_table(features.tfidf_features(samples), "tfidf")
    return coefficients, explain.feature_spread(long, samples.count())


def linear_attribution(spark, d):
    return explain.linear_attribution(*_attribution_parts(spark, d))


def global_importance(spark, d):
    return explain.global_importance(*_attribution_parts(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        text_lengths, length_stats, class_count_stats, underrepresented_classes, length_histograms, top_words, class_documents,
        class_tfidf, class_overlap_pairs, overlap_submatrix, tfidf_features, text_key, text_key_counts, text_overview,
        linear_attribution, global_importance,
    )
}

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS) + ")"
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


def class_tfidf_sql(view: str) -> str:
    return rf"""ctok as (select label_name, unnest({TOKENS}) as term from {view}),
      ccnt as (select label_name, term, count(*) as tf from ctok where term not in {STOP_SQL} group by 1, 2),
      cvoc as (select term, count(*) as df from ccnt group by 1 order by sum(tf) desc, term limit 5000),
      craw as (select label_name, term, tf, tf * (ln((1 + (select count(distinct label_name) from {view}))::double / (1 + df)) + 1) as raw
        from ccnt join cvoc using (term)),
      ctfidf as (select label_name, term, tf, raw / sqrt(sum(raw * raw) over (partition by label_name)) as weight from craw)
    """


SIMILARITY_SQL = (
    class_tfidf_sql("samples20")
    + """, sim as (select a.label_name as class_a, b.label_name as class_b, sum(a.weight * b.weight) as similarity
      from ctfidf a join ctfidf b on a.term = b.term and a.label_name < b.label_name group by 1, 2),
    top5 as (select class_a, class_b, round(similarity, 6) as similarity from sim order by 3 desc, 1, 2 limit 5),
    top10 as (select class_a, class_b, round(similarity, 6) as similarity from sim order by 3 desc, 1, 2 limit 10)
    """
)

TFIDF_SQL = rf"""tok as (select sample_id, {TOKENS} as t from samples),
  gram as (select sample_id, unnest(t) as term from tok
    union all select sample_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) from tok),
  tfs as (select sample_id, term, count(*) as tf from gram group by 1, 2),
  voc as (select term, count(*) as df from tfs group by 1 order by sum(tf) desc, term limit 10000),
  raw as (select sample_id, term, (1 + ln(tf)) * (ln((1 + (select count(*) from samples))::double / (1 + df)) + 1) as raw
    from tfs join voc using (term)),
  tfidf as (select sample_id, term, raw / sqrt(sum(raw * raw) over (partition by sample_id)) as weight from raw)
"""

IMPORTANCE_SQL = (
    class_tfidf_sql("samples")
    + ", "
    + TFIDF_SQL
    + """, mean as (select term, sum(weight) / (select count(*) from samples) as mx, count(*) as nnz from tfidf group by 1),
    spread as (select t.term, (sum(abs(t.weight - m.mx)) + ((select count(*) from samples) - any_value(m.nnz)) * any_value(abs(m.mx)))
        / (select count(*) from samples) as spread from tfidf t join mean m using (term) group by 1),
    imp as (select label_name as class_name, term, abs(weight) * spread as importance from ctfidf join spread using (term))
    """
)

ORACLE = {
    "text_lengths": with_views(
        "select sample_id, length(text) as text_length, len(regexp_extract_all(text, '\\S+')) as word_count from samples", "samples"
    ),
    "length_stats": with_views(
        """s as (select label, length(text) as c, len(regexp_extract_all(text, '\\S+')) as w from samples20)
          select count(distinct label) as num_classes, round(avg(c), 6) as chars_mean, min(c) as chars_min, max(c) as chars_max,
            round(stddev_samp(c), 6) as chars_std, round(avg(w), 6) as words_mean, min(w) as words_min, max(w) as words_max from s""",
        "samples20",
    ),
    "class_count_stats": with_views(
        """c as (select label_name, count(*) as n from samples group by 1)
          select round(avg(n), 6) as mean_count, min(n) as min_count, arg_min(label_name, {'a': n, 'b': label_name}) as min_class,
            max(n) as max_count, arg_min(label_name, {'a': -n, 'b': label_name}) as max_class,
            round(max(n)::double / min(n), 6) as imbalance_ratio from c""",
        "samples",
    ),
    "underrepresented_classes": with_views(
        """c as (select label_name, count(*) as n from samples group by 1),
          f as (select *, n < 0.8::double * avg(n) over () as underrepresented from c)
          select *, count(*) filter (where underrepresented) over () as n_flagged from f""",
        "samples",
    ),
    "length_histograms": with_views(
        """x as (select 'chars' as measure, length(text)::double as x, 50 as bins from samples
             union all select 'words', len(regexp_extract_all(text, '\\S+'))::double, 30 from samples),
          s as (select measure, bins, min(x) as lo, (max(x) - min(x)) / bins as width, avg(x) as mean from x group by 1, 2),
          b as (select measure, least(floor((x - lo) / width), x.bins - 1)::bigint as bin, count(*) as n from x join s using (measure) group by 1, 2),
          g as (select measure, lo, width, mean, unnest(range(0, bins)) as bin from s)
          select measure, bin, round(lo + bin * width, 6) as bin_start, round(lo + (bin + 1) * width, 6) as bin_end,
            coalesce(n, 0) as n, round(mean, 6) as mean from g left join b using (measure, bin)""",
        "samples",
    ),
    "top_words": with_views(
        f"""w as (select unnest(regexp_extract_all(lower(text), '\\S+')) as word from samples)
          select word, count(*) as n from w where word not in {STOP_SQL} and length(word) > 2 group by 1 order by 2 desc, 1 limit 30""",
        "samples",
    ),
    "class_documents": with_views(
        """select label_name, sample_id // 250 as part, count(*) as n, string_agg(text, ' ' order by sample_id) as text
           from samples20 group by 1, 2""",
        "samples20",
    ),
    "class_tfidf": with_views(
        class_tfidf_sql("samples20") + "select label_name, term, tf, round(weight, 6) as weight from ctfidf", "samples20"
    ),
    "class_overlap_pairs": with_views(SIMILARITY_SQL + "select * from top5", "samples20"),
    "overlap_submatrix": with_views(
        SIMILARITY_SQL
        + """, names as (select c from (select class_a as c from top10 union select class_b from top10) order by c limit 15)
        select a.c as class_a, b.c as class_b, round(coalesce(s.similarity, 0), 6) as similarity
        from names a cross join names b left join sim s on s.class_a = least(a.c, b.c) and s.class_b = greatest(a.c, b.c)""",
        "samples20",
    ),
    "tfidf_features": with_views(TFIDF_SQL + "select sample_id, term, round(weight, 6) as weight from tfidf", "samples"),
    "text_key": with_views(
        "select sample_id, sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) as text_key from samples", "samples"
    ),
    "text_key_counts": with_views(
        """k as (select sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) as k from samples)
          select count(*) as rows, count(distinct k) as distinct_keys, count(*) - count(distinct k) as duplicates from k""",
        "samples",
    ),
    "text_overview": with_views(
        rf"""s as (select sample_id, case when label < 10 then 'ref' else 'cur' end as side, text, {TOKENS} as t from samples20),
          w as (select sample_id, side, len(t) as k, unnest(t) as word from s),
          ref as (select distinct word from w where side = 'ref'),
          o as (select sample_id, side, sum(case when word in (select word from ref) then 0 else 1 end)::double / any_value(k) as oov
            from w group by 1, 2)
          select s.side, count(*) as rows, round(avg(length(text)), 6) as mean_length,
            round(avg((length(text) - length(regexp_replace(text, '[^\p{{L}}]', '', 'g')))::double / length(text)), 6) as mean_non_letter_share,
            round(avg(coalesce(o.oov, 0)), 6) as mean_oov_share
          from s left join o using (sample_id) group by s.side""",
        "samples20",
    ),
    "linear_attribution": with_views(
        IMPORTANCE_SQL
        + """, r as (select class_name, term, round(importance, 6) as importance from imp)
        select class_name, term, importance, row_number() over (partition by class_name order by importance desc, term) as rank
        from r qualify rank <= 20""",
        "samples",
    ),
    "global_importance": with_views(
        IMPORTANCE_SQL + "select term, round(sum(importance), 6) as importance from imp group by 1 order by 2 desc, 1 limit 20", "samples"
    ),
}
