"""Flat token files with 64-bit document offsets, written by Spark tasks and memory-mapped on reading.

A folder holds, for each range partition k of the document ids, ``tokens-k`` (unsigned ids, two bytes
where the vocabulary allows it, else four), ``ids-k`` (int64 document ids) and ``offsets-k`` (int64, one
more than documents: where each document starts in the whole corpus), and a small ``parts`` table.
Partitions are written first, each knowing only its own lengths; the bases are prefix sums over the
partitions' totals, and a second pass turns lengths into offsets.

Files get their name only when whole (a retried task replaces its own file by the same bytes), in the
folder that all executors share; paths go through ``pyarrow.fs``, so it may be any store Arrow reaches.
Defined results: null text is empty and still ends with the end id; null ids come first and are stored
as the smallest int64; repeated rows are documents of their own; an empty table gives no files.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentloom.llm.common import read
from intentloom.llm.encode import crc32_of, encoder
from intentloom.session import scratch_path

NULL_ID = np.iinfo(np.int64).min


def _place(folder: str, name: str) -> tuple[pafs.FileSystem, str]:
    store, path = pafs.FileSystem.from_uri(folder)
    return store, f"{path}/{name}"


def _keep(folder: str, name: str, values: np.ndarray) -> None:
    store, path = _place(folder, name)
    hidden = f"{path}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(hidden, compression=None) as out:
        out.write(values.tobytes())
    store.move(hidden, path)


def _values(folder: str, name: str, kind: str) -> np.ndarray:
    """A file's numbers; memory-mapped where the store is a mounted file system."""
    store, path = _place(folder, name)
    if isinstance(store, pafs.LocalFileSystem):
        return np.frombuffer(pa.memory_map(path).read_buffer(), kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, spaced: bool, end_id: int, partitions: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode ``docs`` in ascending id order into ``folder``."""
    with open(tokenizer) as f:
        model = json.load(f)
    width = 2 if max(end_id, *model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"])) < 1 << 16 else 4
    spark, end = docs.sparkSession, np.array([end_id], f"<u{width}").tobytes()
    store, path = _place(folder, "")
    store.create_dir(path)

    def write(batches):
        k = TaskContext.get().partitionId()
        encode = encoder(tokenizer, spaced, width)
        hidden = f"tokens-{k}.{TaskContext.get().taskAttemptId()}"
        place, path = _place(folder, hidden)
        lengths, ids = [], []
        with place.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for tokens in encode.ids(batch.column(1)):
                    out.write(tokens + end)
                    lengths.append(len(tokens) // width + 1)
                ids.append(np.asarray(batch.column(0).fill_null(int(NULL_ID))))
        if not lengths:
            place.delete_file(path)
            return
        place.move(path, _place(folder, f"tokens-{k}")[1])
        _keep(folder, f"lengths-{k}", np.array(lengths, "<i8"))
        _keep(folder, f"ids-{k}", np.concatenate(ids).astype("<i8"))
        yield pa.RecordBatch.from_pydict({"part": [k], "docs": [len(lengths)], "tokens": [sum(lengths)]})

    order = [F.col("id").asc_nulls_first(), "spread"]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("spread", F.xxhash64("text")).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    rows.select("id", "text").mapInArrow(write, "part long, docs long, tokens long").write.parquet(f"{folder}/totals")

    totals = spark.read.parquet(f"{folder}/totals")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each partition
    based = totals.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def offset(batches):
        for batch in batches:
            for k, base in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                ends = base + np.cumsum(_values(folder, f"lengths-{k}", "<i8"))
                _keep(folder, f"offsets-{k}", np.concatenate([[base], ends]).astype("<i8"))
            yield batch

    based.repartition(partitions, "part").mapInArrow(offset, based.schema).write.parquet(f"{folder}/parts")
    with store.open_output_stream(_place(folder, "kind.json")[1], compression=None) as out:
        out.write(json.dumps({"kind": f"<u{width}"}).encode())


def read_token_files(spark: SparkSession, folder: str, schema: str, row) -> DataFrame:
    """One row per document: ``row(doc_id, start, tokens)`` gives its values, tokens as a mapped array."""
    store, path = _place(folder, "kind.json")
    with store.open_input_file(path) as f:
        kind = json.loads(f.read())["kind"]
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def rows(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                ids, at = _values(folder, f"ids-{k}", "<i8"), _values(folder, f"offsets-{k}", "<i8")
                tokens = _values(folder, f"tokens-{k}", kind)
                for lo in range(0, len(ids), 4096):
                    made = [
                        row(None if i == NULL_ID else int(i), int(a), tokens[a - at[0] : b - at[0]])
                        for i, a, b in zip(ids[lo : lo + 4096], at[lo:], at[lo + 1 :])
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names)

    parts = spark.read.parquet(f"{folder}/parts").select("part")
    return parts.mapInArrow(rows, schema)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_token_files(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), True, 0, partitions)
    return read_token_files(
        spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda i, at, t: (i, at, len(t), crc32_of(t))
    )
