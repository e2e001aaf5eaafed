"""Shared small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Where that is unset, as in tests, a local master gets a
    temporary folder; on a cluster, where no machine sees another's folders, it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if "dir" not in _fallback:
        _fallback["dir"] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _fallback["dir"]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes a table into the shared folder and reads it again. What the write shuffled is of no use
    after that, so its files go at once instead of when the driver next collects garbage."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into slices of about `limit` bytes (one row at least), so that long texts don't pile up."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, int(rows * limit / max(1, batch.nbytes))))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def small_batches(spark: SparkSession, size: str | None = None) -> None:
    """Texts can be long: unless the session has settings of its own, fewer rows (and bytes, with `size`) go to Python at once."""
    for key, usual, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", size)):
        if value and spark.conf.get(key) == usual:
            spark.conf.set(key, value)


def whole_id(name: str):
    """The id as a whole number. One that isn't (a fraction, a text) is treated as a null id."""
    c = F.col(name)
    return F.when(c.try_cast("decimal(38,6)") == c.try_cast("bigint"), c.try_cast("bigint"))


def row_key(text: str = "text"):
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))
