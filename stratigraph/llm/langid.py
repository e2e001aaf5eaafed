"""Language identification by nearest centroid over normalised TF-IDF character n-grams.

Texts become vectors of hashed 1- to 3-grams of lower-cased letters (runs of anything else are one space). Each
language is described by several centroids (spherical k-means over its labelled rows), a text gets the language of the
centroid with the highest cosine, and it is rejected where it has no letter or lies too far from every centroid: below
`reach` times a low quantile of the cosines that the language's own rows have at that length. As short texts lie further
off, the rows' beginnings of each length are measured too, in bands that double.

The model is fitted on a bounded sample of labelled rows: at most `sample` rows in all, the same number for each
language, chosen by hash of the id; of more languages than that the most frequent ones are learned. Prediction reads every whole text and nothing but the text.

Defined cases: a null text or one without a letter is `und` with score 0; without any labelled row every text is
`und`; a null or repeated doc_id is just another row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id, written

BUCKETS = 4096
CENTROIDS = 4
SAMPLE = 2000
#: A text whose cosine to its nearest centroid is below this share of the low quantile of its language and length is rejected.
REACH = 0.8
QUANTILE = 0.01
BANDS = 14  # of length: distinct n-grams, by powers of two up to the buckets

_OTHER = re.compile(r"[\W\d_]+")


def counts_of(text: str | None, buckets: int) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None without letters."""
    if not text:
        return None
    return _grams(_OTHER.sub(" ", text.lower()).strip(), buckets)


def _grams(letters: str, buckets: int) -> np.ndarray | None:
    if not letters or not (letters[0].isalpha() or any(map(str.isalpha, letters))):
        return None
    c = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    two = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:]
    three = two[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[2:]
    grams = np.concatenate((c[1:-1], two, three)) * np.uint64(0xFF51AFD7ED558CCD)
    return np.bincount((grams >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)


def band_of(counts: np.ndarray) -> int:
    return min(BANDS - 1, int(np.count_nonzero(counts)).bit_length())  # one word over and over is as short as the word


def beginnings(text: str | None, buckets: int) -> Iterator[np.ndarray]:
    """Counts of a text and of its first words, once at each band of length."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    cuts = {len(letters)}
    for band in range(1, BANDS):
        end = letters.find(" ", 1 << (band - 1))
        if end < 0:
            break
        cuts.add(end)
    for end in sorted(cuts):
        if (counts := _grams(letters[:end], buckets)) is not None:
            yield counts


@dataclass
class Centroids:
    langs: list[str]
    of: np.ndarray  # language of each centroid
    idf: np.ndarray
    at: np.ndarray  # centroids, one to a row, of length 1
    least: np.ndarray  # by language and band of length, the low quantile of its own rows' cosines

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, text: str | None, reach: float) -> tuple[str, float, bool]:
        """Language, cosine in 0..1, rejected."""
        counts = counts_of(text, len(self.idf))
        if counts is None or not self.langs:
            return "und", 0.0, True
        cosines = self.at @ self.vector(counts)
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.langs[self.of[best]], score, score < reach * float(self.least[self.of[best], band_of(counts)])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from a farthest-first start; the same result on every run."""
    at = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[at[0]]
    while len(at) < min(k, len(vectors)):
        at.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[at[-1]])
    centres = vectors[at]
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        centres = _unit(np.stack([vectors[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def fit(docs: DataFrame, train: Column | None = None, sample: int = SAMPLE, centroids: int = CENTROIDS, buckets: int = BUCKETS) -> Centroids:
    """Fits on rows with text and lang for which `train` holds."""
    small_batches(docs.sparkSession)
    labelled = docs.select(F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), (F.lit(True) if train is None else train).alias("train")).where("train and lang is not null and text is not null")
    kinds = [r.lang for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()]
    if not kinds:
        return Centroids([], np.zeros(0, int), np.ones(buckets), np.zeros((0, buckets)), np.zeros((0, BANDS)))
    each = max(1, sample // len(kinds))
    keyed = labelled.withColumn("key", F.xxhash64("text"))
    order = [F.xxhash64("id"), F.col("id"), F.col("key")]
    parts = keyed.select("id", "lang", "key", F.pmod(F.xxhash64("id", "lang", "key"), F.lit(16)).alias("part"))  # a frequent language isn't one task's work
    first = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= each)
    chosen = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= each).select(F.col("id").alias("its_id"), F.col("lang").alias("its_lang"), F.col("key").alias("its_key")).distinct()
    chosen = written(chosen, "language-sample")  # at most `sample` rows
    rows = keyed.join(F.broadcast(chosen), (F.col("key") == F.col("its_key")) & (F.col("lang") == F.col("its_lang")) & F.col("id").eqNullSafe(F.col("its_id")), "left_semi").select("id", "lang", "text", "key")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 16 << 20):
            out = [(i, lang, key, c.nonzero()[0].astype(np.int32), c[c.nonzero()].astype(np.int32)) for i, lang, text, key in zip(*(part.column(k).to_pylist() for k in range(4))) if (c := counts_of(text, buckets)) is not None]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["id", "lang", "key", "at", "n"])

    # rows that repeat an id, language and text count once, so there are at most `sample` of them, the same ones each time
    found = rows.select(whole_id("id").alias("id"), "lang", "text", "key").mapInArrow(features, "id bigint, lang string, key bigint, at array<int>, n array<int>").dropDuplicates(["id", "lang", "key"])
    found = sorted(found.collect(), key=lambda r: (r.lang, r.id is None, r.id or 0, r.key))
    counts = np.zeros((len(found), buckets), dtype=np.float32)
    for i, r in enumerate(found):
        counts[i, r.at] = r.n
    idf = np.log((1 + len(found)) / (1 + (counts > 0).sum(axis=0))) + 1
    vectors = _unit(np.log1p(counts) * idf)
    langs = sorted({r.lang for r in found})
    at, of = [], []
    for j, lang in enumerate(langs):
        own = vectors[[i for i, r in enumerate(found) if r.lang == lang]]
        centres = _clusters(own, centroids)
        at.append(centres)
        of += [j] * len(centres)
    model = Centroids(langs, np.array(of, dtype=int), idf.astype(np.float32), np.concatenate(at).astype(np.float32) if at else np.zeros((0, buckets)), np.zeros((len(langs), BANDS)))
    model.least = _least(rows, model)
    return model


def _least(rows: DataFrame, model: Centroids) -> np.ndarray:
    """The low quantile of the rows' cosines to their own language, by language and band."""
    number = {lang: j for j, lang in enumerate(model.langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [model.at[model.of == j] for j in range(len(number))]
        for part in text_batches(batches, 16 << 20):
            out = [(number[lang], band_of(c), float((own[number[lang]] @ model.vector(c)).max())) for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if lang in number for c in beginnings(text, len(model.idf))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.float64()))], names=["lang", "band", "cosine"])

    found = rows.select("lang", "text").mapInArrow(run, "lang int, band int, cosine double").groupBy("lang", "band").agg(F.percentile("cosine", QUANTILE).alias("low"))
    least = np.full((len(number), BANDS), np.nan)
    for r in found.collect():  # BANDS rows a language at most
        least[r.lang, r.band] = r.low
    for row in least:  # a length not met is judged like the next shorter one, else the next longer
        met = np.flatnonzero(~np.isnan(row))
        for band in range(BANDS if len(met) else 0):
            row[band] = row[met[max(0, np.searchsorted(met, band, "right") - 1)]]
    return np.nan_to_num(least)


def predict(docs: DataFrame, model: Centroids, reach: float = REACH) -> DataFrame:
    """doc_id, row_key, lang_pred, score, rejected: one row for each row of `docs`."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 16 << 20):
            out = [model.predict(text, reach) for text in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_())))], names=["doc_id", "row_key", "lang_pred", "score", "rejected"])

    return docs.select(whole_id("doc_id").alias("doc_id"), F.xxhash64("text").alias("row_key"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, row_key bigint, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
