"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_fallback: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, a local master gets a temporary folder of its own; on
    a cluster, where no machine sees another's folders, it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not _fallback:
            _fallback.append(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        root = _fallback[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: str | None = None, path: str | None = None) -> DataFrame:
    """`df` written and read again. With `partition_by`, adaptive execution deals the rows out by its values and splits
    frequent ones, so neither one task nor one file holds them and no value is cut into many small files."""
    path = path or scratch_path(df.sparkSession, name)
    (df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """`df` in ranges of all `keys`, each row with its range's number as `_part`, in the order of the keys. The rows are
    stored with their number, so every reader sees the same ranges. Equal rows of all keys share a range."""
    return stored(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")


def carried(ranges: DataFrame, value: Column, over) -> DataFrame:
    """_part, carried: `over` (an aggregate of the column `_value`) of all ranges before, from one row for each range."""
    ends = ranges.groupBy("_part").agg(value.alias("_value"))
    return ends.select("_part", over("_value").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
