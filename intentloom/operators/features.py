"""TF-IDF in long form (row, term, weight), and vectors for Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentloom.functions import grams
from intentloom.functions.scale import SMALL_ROWS, broadcast_small
from intentloom.functions.text import STOPWORDS, let, ngrams, token_letters, tokens
from intentloom.session import through_table

CLASS_FEATURES = 5_000
MAX_FEATURES = 10_000
NGRAM_RANGE = (1, 2)


def terms(text: str | Column, ngram_range: tuple[int, int] = NGRAM_RANGE) -> Column:
    sizes = range(ngram_range[0], ngram_range[1] + 1)
    return let(tokens(text), lambda t: F.concat(*[ngrams(t, n) for n in sizes]))


def class_term_counts(df: DataFrame, label: str = "label_name", stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """(class, term, tf): counted per class, never through a concatenated class document."""
    letters, names = token_letters(df.sparkSession), [label, "term", "tf"]
    schema = T.StructType([df.schema[label], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return (
        df.select(F.lower("text"), label)
        .mapInArrow(lambda batches: grams.group_counts(grams.token_batches(batches, letters), names), schema)
        # "not null" is said here so that every reader of the counts plans, and shares, one shuffle
        .filter(F.col("term").isNotNull() & ~F.col("term").isin(list(stopwords)))
        .groupBy(label, "term")
        .agg(F.sum("tf").alias("tf"))
    )


def class_tfidf(
    df: DataFrame, label: str = "label_name", max_features: int = CLASS_FEATURES, stopwords: Sequence[str] = STOPWORDS
) -> DataFrame:
    """TF-IDF of each class taken as one document, L2-normalised: (class, term, tf, weight)."""
    counts = class_term_counts(df, label, stopwords)
    vocabulary = (
        counts.groupBy("term")
        .agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )
    n_docs = F.lit(df.select(label).distinct().count())
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    # the limit bounds the vocabulary; each class then has at most that many rows
    kept = counts.join(F.broadcast(vocabulary.select("term", idf.alias("idf"))), "term")
    raw = kept.select(label, "term", "tf", (F.col("tf") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(label)))
    return raw.select(label, "term", "tf", (F.col("raw") / norm).alias("weight"))


def vocabulary(
    df: DataFrame,
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    n_rows: int | None = None,
) -> DataFrame:
    """The most frequent terms with their inverse document frequency: (term, idx, idf).

    Terms are counted in Arrow batches and added before they move. Single words are counted first: with
    ``max_features`` of them found, a longer term of a word rarer than the last of these cannot be among the
    most frequent, and is not counted. The limit bounds the result.
    """
    n_rows = F.lit(df.count() if n_rows is None else n_rows)
    found, words, sizes = None, None, ngram_range
    if ngram_range[0] == 1 < ngram_range[1]:
        counted = through_table(_term_totals(df, (1, 1)), "words")
        top = _most_frequent(counted, max_features).toArrow()
        found, sizes = df.sparkSession.createDataFrame(top, schema=counted.schema), (2, ngram_range[1])
        if top.num_rows == max_features:
            words = _words_from(counted, pc.min(top["total"]).as_py())
    longer = _most_frequent(_term_totals(df, sizes, words), max_features)
    top = longer if found is None else _most_frequent(found.unionByName(longer), max_features)
    idf = F.log((n_rows + 1) / (F.col("df") + 1)) + 1
    idx = F.row_number().over(W.orderBy("term")) - 1  # over the limited list
    return top.select("term", idx.alias("idx"), idf.alias("idf"))


def _term_totals(df: DataFrame, sizes: tuple[int, int], words: pa.Array | None = None) -> DataFrame:
    """(term, total, df): occurrences and rows of every term of these sizes, of ``words`` only if given."""
    letters = token_letters(df.sparkSession)
    return (
        df.select(F.lower("text"))
        .mapInArrow(lambda batches: grams.total_counts(grams.token_batches(batches, letters), sizes, words), "term string, tf bigint, df bigint")
        .groupBy("term")
        .agg(F.sum("tf").alias("total"), F.sum("df").alias("df"))
    )


def _most_frequent(counted: DataFrame, n: int) -> DataFrame:
    return counted.orderBy(F.desc("total"), "term").limit(n)


def _words_from(counted: DataFrame, least: int) -> pa.Array | None:
    """The words with a total of ``least`` or more; nothing if ties make them too many to send along."""
    rows = counted.filter(F.col("total") >= least).select("term").limit(SMALL_ROWS + 1).toArrow()
    return None if rows.num_rows > SMALL_ROWS else rows["term"].combine_chunks()


def with_cells(df: DataFrame, vocab: DataFrame, ngram_range: tuple[int, int] = NGRAM_RANGE) -> tuple[DataFrame, DataFrame]:
    """``df`` with its known terms as ``_cells`` of (idx, raw weight) in place of the text, and the vocabulary as a local table.

    The vocabulary travels with the function, as a model's coefficients do.
    """
    local = vocab.select("term", F.col("idx").cast("long").alias("idx"), F.col("idf").cast("double").alias("idf")).orderBy("idx").toArrow()
    known = local.filter(pc.is_valid(local["term"])).combine_chunks()
    term, idx, idf = known["term"].combine_chunks(), known["idx"].to_numpy(), known["idf"].to_numpy()
    words = pa.array(sorted({w for t in term.to_pylist() for w in t.split(" ")}), term.type)

    letters = token_letters(df.sparkSession)

    @F.arrow_udf(grams.CELLS)
    def cells(texts: pa.Array) -> pa.Array:
        return grams.row_terms(texts, letters, ngram_range, term, words, idx, idf)

    kept = [c for c in df.columns if c != "text"]
    weighed = F.transform(cells(F.lower("text")), lambda c: F.struct(c["idx"].alias("idx"), ((F.log(c["tf"]) + 1) * c["idf"]).alias("raw")))
    return df.select(*kept, weighed.alias("_cells")), F.broadcast(df.sparkSession.createDataFrame(local))


def tfidf_features(
    df: DataFrame,
    vocab: DataFrame | None = None,
    id_col: str = "sample_id",
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(row, term, idx, weight): weight (1 + ln tf) * idf, L2-normalised per row.

    Only the known terms of a row are spread by id, as one array; term texts are added at the end.
    A row without any known term has no output rows.
    """
    if vocab is None:
        vocab = vocabulary(df, max_features, ngram_range)  # bounded by max_features
    rows, terms_by_idx = with_cells(df.select(id_col, *carry, "text"), vocab, ngram_range)
    own = F.aggregate("_cells", F.lit(0.0), lambda a, c: a + c["raw"] * c["raw"])
    norm = F.sqrt(F.sum(own).over(W.partitionBy(id_col)))
    long = rows.withColumn("_norm", norm).select(id_col, *carry, "_norm", F.inline("_cells"))
    named = long.join(terms_by_idx.select("term", "idx"), "idx")
    return named.select(id_col, *carry, "term", F.col("idx").cast("int").alias("idx"), (F.col("raw") / F.col("_norm")).alias("weight"))


def _sparse_parts(
    df: DataFrame, vocab: DataFrame, id_col: str, ngram_range: tuple[int, int]
) -> tuple[DataFrame, list[str]]:
    """Every row with its known terms as ``_cells`` of (idx, raw weight), sorted by idx."""
    carry = [c for c in df.columns if c not in (id_col, "text")]
    firsts = [F.first(c).alias(c) for c in carry]
    cells = F.sort_array(F.flatten(F.collect_list("_cells")))
    rows = with_cells(df, vocab, ngram_range)[0].groupBy(id_col).agg(*firsts, cells.alias("_cells"))
    return rows, [id_col, *carry]


def stored_tfidf_vectors(
    df: DataFrame,
    vocab: DataFrame,
    id_col: str = "sample_id",
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    size: int = MAX_FEATURES,
    out: str = "features",
) -> DataFrame:
    """``df`` rows (every column but the text) with their TF-IDF vector; zero for a row without a known term.

    They go by way of a written table, as fits pass over the vectors many times. The table stores a vector as a plain struct and is read back as vectors: no Python worker.
    """
    parts, cols = _sparse_parts(df, vocab, id_col, ngram_range)
    norm = F.sqrt(F.aggregate("_cells", F.lit(0.0).cast("double"), lambda a, c: a + c["raw"] * c["raw"]))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),  # 0 marks a sparse vector
        F.lit(size).alias("size"),
        F.transform("_cells", lambda c: c["idx"].cast("int")).alias("indices"),
        let(norm, lambda n: F.transform("_cells", lambda c: c["raw"] / n)).alias("values"),
    )
    table = parts.select(*cols, vector.alias(out))
    schema = T.StructType([f for f in table.schema if f.name != out]).add(out, VectorUDT())
    return through_table(table, "vectors", schema)
