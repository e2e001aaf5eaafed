"""Line deduplication over levelled, sorted runs of line hashes (DataFrame operations only).

`LineRuns` is a log-structured set of line keys. A batch is summed to one row per key (hash, number of documents,
largest document), merge-anti-joined with every run to leave out the keys whose fate is already settled, and added as a
sorted run of level 0. Where a level holds `fanout` runs they are merged into one run of the next level. Runs are
bucketed by hash, so the anti-join reads them without a shuffle.

`drop_repeated` feeds documents in batches of falling doc_id: a key that earlier batches have met in `min_docs`
documents is settled (every later occurrence goes), so frequent lines leave after the first batch. Sums are made before
each shuffle and the final join is one that adaptive execution can split, so a line of a third of all documents is no
hot spot.

A key is the line without white space at both ends ([\\x20\\x09-\\x0D]) and with A-Z in lower case, held as two 64-bit
hashes. Defined cases: a null or empty text is one empty line; keys shorter than `min_chars` code points always stay;
rows with a null doc_id count for nothing and stay whole; rows that repeat a doc_id are one document in the counts; a
key's lines all stay in its largest document, repeated lines included; empty tables give empty results.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, row_key, whole_id, written

MIN_DOCS = 3
MIN_CHARS = 20
BATCHES = 4
FANOUT = 4

_BLANK = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; the quick built-in where there is nothing beyond ASCII."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, row_key, pos, h1, h2 of every line whose key is long enough."""
    lines = docs.where("doc_id is not null").select("doc_id", row_key().alias("row_key"), F.posexplode(F.split(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), "\n", -1)).alias("pos", "line"))
    keys = lines.select("doc_id", "row_key", "pos", F.btrim("line", F.lit(_BLANK)).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc_id", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Levels of sorted runs; a run has h1, h2, n_docs, top_doc, and each key once."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, settled_at: int = MIN_DOCS):
        self.spark, self.fanout, self.settled_at = spark, fanout, settled_at
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", new_folder(self.spark, f"line-run-{level}")
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def unsettled(self, keys: DataFrame) -> DataFrame:
        """Merge-anti-join with every run: what is left are keys that still have to be counted."""
        for run in self.runs():
            keys = keys.join(run.where(F.col("n_docs") >= self.settled_at).select("h1", "h2"), ["h1", "h2"], "left_anti")
        return keys

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of (doc_id, h1, h2), and compacts full levels."""
        keys = lines.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        self._write(self.unsettled(keys), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged([path for _, path in full]), level + 1)
            self._drop(full)
            level += 1

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _merged(self, paths: list[str]) -> DataFrame:
        """One row per key. Read as plain files: a union of bucketed scans is summed wrongly here, bucket by bucket."""
        rows = self.spark.read.schema("h1 bigint, h2 bigint, n_docs bigint, top_doc bigint").parquet(*paths)
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"))

    def keys(self) -> DataFrame:
        """Every key once: h1, h2, n_docs (exact below `settled_at`), top_doc."""
        return self._merged([path for level in self.levels for _, path in level])

    def close(self) -> None:
        """Forgets the tables' names; the files stay in the shared folder."""
        for level in self.levels:
            self._drop(level)


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, row_key, dropped (positions) of every document that loses lines."""
    spark = docs.sparkSession
    docs = docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    edges = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)]).alias("at")).first()["at"] if batches > 1 else []
    batch = F.lit(0)
    for at in edges or []:
        batch = batch + (F.col("doc_id") <= at).cast("int")  # the first batch has the largest ids
    folder = new_folder(spark, "lines")
    hashed_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema("doc_id bigint, row_key bigint, pos int, h1 bigint, h2 bigint, batch int").parquet(folder)
    runs = LineRuns(spark, fanout, min_docs)
    for i in range(batches):
        runs.add(lines.where(F.col("batch") == i).select("doc_id", "h1", "h2"))
    repeated = written(runs.keys().where(F.col("n_docs") >= min_docs).select("h1", "h2", "top_doc"), "repeated-lines")
    runs.close()
    return lines.join(repeated, ["h1", "h2"]).where(F.col("doc_id") != F.col("top_doc")).groupBy("doc_id", "row_key").agg(F.collect_set("pos").alias("dropped"))


def drop_repeated(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The rows of `docs`, all columns, with `text` cut to the lines that stay; columns line_dedup_total and line_dedup_dropped follow (they take the place of columns of these names)."""
    taken = {c.lower() for c in docs.columns} | {"line_dedup_total", "line_dedup_dropped"}
    own = [next(n for i in itertools.count() if (n := f"{x}_{i}") not in taken) for x in ("key", "lines", "id", "gone_key", "gone")]
    key, lines, gone_id, gone_key, dropped = own  # names that no column of `docs` has
    gone = dropped_lines(docs, min_docs, min_chars, batches, fanout).select(F.col("doc_id").alias(gone_id), F.col("row_key").alias(gone_key), F.col("dropped").alias(dropped))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({key: row_key(), lines: F.split(text, "\n", -1)}).drop("text")
    joined = rows.join(gone, (whole_id("doc_id") == F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left")
    total, lost = F.size(lines), F.coalesce(F.size(dropped), F.lit(0))
    stay = F.transform(F.array_except(F.sequence(F.lit(0), total - 1), F.col(dropped)), lambda i: F.get(F.col(lines), i))
    kept = F.array_join(F.when(F.col(dropped).isNull(), F.col(lines)).otherwise(stay), "\n")
    rest = [c for c in docs.columns if c.lower() not in ("line_dedup_total", "line_dedup_dropped")]
    return joined.select(*[kept.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in rest], total.cast("bigint").alias("line_dedup_total"), lost.cast("bigint").alias("line_dedup_dropped"))
