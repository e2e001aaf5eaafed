"""CSV whose quoted fields may hold line breaks, read in splits.

A line break inside quotes doesn't end a record, and whether a line begins inside quotes depends on all quotes before it
in its file. Each split counts its own lines both ways (as if it began outside, and inside quotes); one row for each
split, with the parity of its quotes, then tells which way holds. Lines that are records by themselves go on at once;
only the lines of records that span several are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LINES = "file string, block bigint, place bigint, value string, inside int, odd boolean, outer_rank bigint, inner_rank bigint"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their place in the split, the parity of the split's quotes before them, and their rank among the lines
    of each parity. The lines of a split come in order."""
    now, place, parity, ranks = None, 0, 0, [0, 0]
    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys = list(zip(files, blocks))
        edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if keys[a] != now:
                now, place, parity, ranks = keys[a], 0, 0, [0, 0]
            part = batch.slice(a, b - a)
            quotes = pc.count_substring(part.column(2), '"').to_numpy(zero_copy_only=False).astype(np.int64)
            after = parity + np.cumsum(quotes)
            inside = (after - quotes) % 2
            outer, inner = ranks[0] + np.cumsum(inside == 0), ranks[1] + np.cumsum(inside == 1)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.arange(place, place + b - a)), part.column(2), pa.array(inside.astype(np.int32)), pa.array(quotes % 2 == 1), pa.array(outer), pa.array(inner)], names=["file", "block", "place", "value", "inside", "odd", "outer_rank", "inner_rank"])
            place, parity, ranks = place + b - a, int(after[-1] % 2), [int(outer[-1]), int(inner[-1])]


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, number, record: each record's text, told by the split in which it begins and its number there."""
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").mapInArrow(_counted, _LINES)
    splits = lines.groupBy("file", "block").agg((F.count_if("odd") % 2).alias("parity"), F.max("outer_rank").alias("outer"), F.max("inner_rank").alias("inner"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    splits = splits.withColumn("carried", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("begun", F.when(F.col("carried") == 0, F.col("outer")).otherwise(F.col("inner")))
    some = F.when(F.col("begun") > 0, F.struct("block", "begun"))
    splits = splits.select("file", "block", "carried", F.last(some, ignorenulls=True).over(before).alias("open"))
    rank = F.when(F.col("carried") == 0, F.col("outer_rank")).otherwise(F.col("inner_rank"))
    begins = F.col("inside") == F.col("carried")
    here = F.when(rank > 0, F.struct(F.col("block"), rank.alias("number"))).otherwise(F.struct(F.col("open.block").alias("block"), F.col("open.begun").alias("number")))
    told = lines.join(splits, ["file", "block"]).select("file", "block", "place", "value", (begins & ~F.col("odd")).alias("alone"), here.alias("at"))
    alone = told.where("alone").select("file", "at.block", "at.number", F.col("value").alias("record"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "value"))), lambda x: x["value"]), "\n")
    several = told.where("not alone").groupBy("file", F.col("at.block").alias("block"), F.col("at.number").alias("number")).agg(text.alias("record"))
    return alone.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header in each file, as text columns. A quote that is never closed takes the rest of its file."""
    options = {"quote": '"', "escape": '"'}
    names = spark.read.csv(path, header=True, multiLine=True, **options).columns
    rows = records(spark, path).where("not (block = 0 and number = 1) and record <> ''")
    parsed = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))), options | {"maxCharsPerColumn": "-1"})
    return rows.select(parsed.alias("r")).select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
