"""Corpus pipeline: language ID, line dedup, MinHash near-dedup, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and its decisions take effect: rejected
languages go, repeated lines are cut, one document of each near-duplicate group stays, contaminated documents go. All
but the last return the columns of `docs`. Rows are told apart by doc_id and text, so repeated rows and null ids pass
through as defined by the operators (an id that isn't a whole number is a null id); columns of any other name are carried
along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratigraph.llm import decontamination, langid, line_dedup, minhash, sentencepiece_fst
from stratigraph.llm.common import whole_id, written


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the rows whose doc_id and text hash are in `gone` (doc_id, row_key)."""
    gone = written(gone.distinct(), "gone")  # its size is known to the planner, which broadcasts it only if small
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("row_key").alias("__gone_key"))
    return docs.join(gone, whole_id("doc_id").eqNullSafe(F.col("__gone_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__gone_key")), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or far from every language that the labelled ones show."""
    found = langid.predict(docs, langid.fit(docs))
    return _without(docs, found.where("rejected").select("doc_id", "row_key"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that three documents or more hold out of all but the last of them."""
    names = {c.lower() for c in docs.columns} & {"line_dedup_total", "line_dedup_dropped"}
    found = line_dedup.drop_repeated(docs.withColumnsRenamed({c: f"{c} of docs" for c in docs.columns if c.lower() in names}))
    return found.select(*[F.col(f"`{c} of docs`").alias(c) if c.lower() in names else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates (five words, similarity 0.8). All rows of one doc_id are
    one document to the operator and share its group, so they stay or go together."""
    found = minhash.near_duplicates(docs)
    gone = written(found.where("not kept").select("doc_id").distinct(), "copies").select(F.col("doc_id").alias("__gone_id"))
    return docs.join(gone, whole_id("doc_id") == F.col("__gone_id"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item (or a shorter item whole)."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_matches(docs, benchmark)
    return _without(docs, found.where(F.size("items") > 0).select("doc_id", "row_key"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, exact of each document left."""
    return sentencepiece_fst.encode_decode(docs, sentencepiece_fst.read_model(spark))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: The near-duplicate, tokenizer and language stages aren't expressible in SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
