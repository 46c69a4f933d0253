"""Session settings and the shared folder for state that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_OWN_DIR: dict[str, str] = {}
_MADE: list[str] = []


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) is a folder made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _OWN_DIR:
        _OWN_DIR["dir"] = tempfile.mkdtemp(prefix="intentloom-")
    return _OWN_DIR["dir"]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder; ``drop_scratch`` deletes it."""
    _MADE.append(f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}")
    return _MADE[-1]


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later step reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables made so far. For a job's end: frames that read them are done then."""
    while _MADE:
        forget(spark, _MADE.pop())


def through_table(df: DataFrame, purpose: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where several later steps read one costly result: the lineage ends here, so a
    lost executor costs a re-read, not a recomputation. ``schema`` reads other types of the same
    storage format.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
