"""Benchmark decontamination over a distributed positional inverted index.

The corpus is cut into segments of bounded size. Every segment stores, for each word in it, the sorted list of its
positions (words are told apart by 64-bit hashes); a segment is one row of the stored index, so any number of executors
build and search segments without a shuffle, a frequent word is spread over all segments, and one index serves any
number of test items and searches.

The test side is a stated query set in blocks of at most `block_words` words, each small enough to be sent to every task.
A block is searched in a segment all at once. Of each phrase (`window` words of an item) with all its words in the
segment, the rarest word is the anchor, which neighbouring phrases mostly share. The places of the anchor are extended to
both sides, word by word, through the offset-adjusted lists of the words beside it; where the run of matching words is as
long as a phrase, all its words are hit. A phrase without a place for its rarest word costs one look at the counts.

Defined cases: a null text has no words; a null or repeated doc_id is just another row; items without an id or
without words match nothing; an empty table on either side gives no hits; further columns are left out. Item ids may be
of any type, they are carried as strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, small_batches, text_batches, whole_id, written

WINDOW = 10
SEGMENT_BYTES = 8 << 20
BLOCK_WORDS = 200_000
TOGETHER = 1 << 20  # places of anchors that are extended together

#: Bytes of words: digits, a-z and everything beyond ASCII stay, A-Z become lower case, the rest separates.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

INDEX_SCHEMA = "segment bigint, doc_ids array<bigint>, keys array<bigint>, n_words array<int>, terms binary, sizes binary, postings binary"
HIT_SCHEMA = "segment bigint, place int, starts array<int>, ends array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class TestPhrases:
    """One block of test items as one line of term numbers; a phrase is a place in it and a length."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        words = [(item, words_of(text)) for item, text in items]
        words = [(item, w) for item, w in words if w]
        self.items = [item for item, _ in words]
        number: dict[bytes, int] = {}
        self.line = np.array([number.setdefault(w, len(number)) for _, ws in words for w in ws], dtype=np.int64)
        self.terms = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
        sizes = np.array([len(ws) for _, ws in words], dtype=np.int64)
        self.item = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        self.before = np.arange(len(self.line)) - (ends - sizes)[self.item] if len(sizes) else np.zeros(0, np.int64)  # words of the item to the left
        self.after = ends[self.item] - 1 - np.arange(len(self.line)) if len(sizes) else np.zeros(0, np.int64)
        self.need = np.minimum(sizes, window)
        self.starts = {int(n): np.flatnonzero((self.need[self.item] == n) & (self.after >= n - 1)) for n in np.unique(self.need)}

    def anchors(self, counts: np.ndarray) -> np.ndarray:
        """Places in the line of the rarest words of the phrases whose words all occur (counts by term)."""
        found = []
        for n, starts in self.starts.items():
            held = np.lib.stride_tricks.sliding_window_view(counts[self.line], n)[starts]
            rarest = held.argmin(axis=1)
            found.append((starts + rarest)[held[np.arange(len(starts)), rarest] > 0])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Segment:
    """Postings of one segment, on one line of positions with a gap after each document."""

    def __init__(self, n_words: np.ndarray, terms: bytes, sizes: bytes, postings: bytes):
        self.first = np.concatenate(([0], np.cumsum(n_words.astype(np.int64) + 1)))
        self.terms, sizes, self.places = np.frombuffer(terms, np.uint64), np.frombuffer(sizes, np.int32), np.frombuffer(postings, np.int32)
        self.ends = np.cumsum(sizes.astype(np.int64))
        self.begins = self.ends - sizes

    @staticmethod
    def pack(ids: list[np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, bytes, bytes, bytes]:
        """From the numbers of each document's words and the hashes by number."""
        order = np.argsort(hashes)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        n_words = np.array([len(x) for x in ids], dtype=np.int32)
        first = np.cumsum(n_words.astype(np.int64) + 1) - n_words - 1
        at = np.concatenate([np.arange(n) + f for n, f in zip(n_words, first)]) if ids else np.zeros(0, np.int64)
        line = rank[np.concatenate(ids)] if ids else np.zeros(0, np.int64)
        both = np.sort(line << 32 | at)
        return n_words, hashes[order].tobytes(), np.bincount(line, minlength=len(order)).astype(np.int32).tobytes(), (both & 0xFFFFFFFF).astype(np.int32).tobytes()

    def look_up(self, terms: np.ndarray) -> None:
        """Takes the lists of these terms: `counts` of each, and all places in one sorted line of (term, place)."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        here = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        self.counts = np.where(here, (self.ends - self.begins)[at] if len(self.terms) else 0, 0)
        self.begin = np.where(here, self.begins[at] if len(self.terms) else 0, 0)
        term = np.repeat(np.arange(len(terms)), self.counts)
        self.start = np.cumsum(self.counts) - self.counts
        self.width = int(self.first[-1]) + 1
        self.flat = term * self.width + self.places[self.begin[term] + np.arange(len(term)) - self.start[term]]

    def list_of(self, term: int) -> np.ndarray:
        return self.flat[self.start[term] : self.start[term] + self.counts[term]] - term * self.width

    def holds(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each place is in the list of its term."""
        key = term * self.width + place
        return (place >= 0) & (self.flat[np.minimum(np.searchsorted(self.flat, key), len(self.flat) - 1)] == key)

    def runs(self, phrases: TestPhrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each run of words that holds a phrase, and the number of its item."""
        self.look_up(phrases.terms)
        anchors = phrases.anchors(self.counts)
        found: list[tuple] = [(_NONE, _NONE, _NONE)]
        upto = np.cumsum(self.counts[phrases.line[anchors]])
        begin = 0
        while begin < len(anchors):
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + TOGETHER, side="right")))
            some = anchors[begin:end]
            term = phrases.line[some]
            at = np.repeat(some, self.counts[term])
            offset = np.arange(len(at)) - np.repeat(np.cumsum(self.counts[term]) - self.counts[term], self.counts[term])
            t = phrases.line[at]
            place = self.flat[self.start[t] + offset] - t * self.width
            begin = end
            need = phrases.need[phrases.item[at]]
            right = self.extended(phrases, at, place, 1, phrases.after)
            # what is to the left can't make up for more than the item has there
            keep = right + 1 + np.minimum(phrases.before[at], phrases.window - 1) >= need
            at, place, need, right = at[keep], place[keep], need[keep], right[keep]
            left = self.extended(phrases, at, place, -1, phrases.before)
            keep = left + right + 1 >= need
            found.append(((place - left)[keep], (place + right + 1)[keep], phrases.item[at[keep]]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def extended(self, phrases: TestPhrases, at: np.ndarray, place: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
        """How many words on from `place` go on as the line does from `at`, up to a phrase's length and the item's end."""
        reach = np.zeros(len(at), np.int64)
        going = np.arange(len(at))
        for d in range(1, phrases.window):
            going = going[room[at[going]] >= d]
            if len(going):
                going = going[self.holds(phrases.line[at[going] + step * d], place[going] + step * d)]
            if not len(going):
                break
            reach[going] = d
        return reach

    def near(self, window: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the rarest term with every other term of the window within len(window) + slop words, same document."""
        parts = sorted((self.list_of(int(t)) for t in set(window.tolist())), key=len)
        if not len(parts[0]):
            return _NONE
        at, reach = parts[0], len(window) + slop - 1
        doc = self.document(at)
        low, high = np.maximum(at - reach, self.first[doc]), np.minimum(at + reach, self.first[doc + 1] - 2)
        for places in parts[1:]:
            i = np.searchsorted(places, low)
            ok = (i < len(places)) & (places[np.minimum(i, len(places) - 1)] <= high)
            at, low, high = at[ok], low[ok], high[ok]
        return at

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, side="right") - 1


_NONE = np.zeros(0, dtype=np.int64)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The postings of all words of all whole texts, a row a segment."""
    small_batches(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        doc_ids: list = []
        keys: list = []
        ids: list[np.ndarray] = []
        number: dict[bytes, int] = {}
        size = 0

        def out() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
            n_words, terms, sizes, postings = Segment.pack(ids, hashes)
            return pa.RecordBatch.from_arrays(
                [pa.array([serial], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([keys], pa.list_(pa.int64())), pa.array([n_words], pa.list_(pa.int32())), *(pa.array([x], pa.binary()) for x in (terms, sizes, postings))],
                names=["segment", "doc_ids", "keys", "n_words", "terms", "sizes", "postings"],
            )

        for part in text_batches(batches, segment_bytes):
            for text in part.column("text").to_pylist():
                words = words_of(text)
                for w in set(words).difference(number):
                    number[w] = len(number)
                ids.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            doc_ids += part.column("doc_id").to_pylist()
            keys += part.column("row_key").to_pylist()
            size += part.nbytes
            if size >= segment_bytes:
                yield out()
                serial, doc_ids, keys, ids, number, size = serial + 1, [], [], [], {}, 0
        if doc_ids:
            yield out()

    return docs.select(whole_id("doc_id").alias("doc_id"), F.xxhash64("text").alias("row_key"), F.col("text").cast("string").alias("text")).mapInArrow(build, INDEX_SCHEMA)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Segment]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield row.column(0)[0].as_py(), Segment(np.asarray(row.column(1)[0].values), *(row.column(k)[0].as_py() for k in (2, 3, 4)))


_SEARCHED = ["segment", "n_words", "terms", "sizes", "postings"]


def exact_matches(index: DataFrame, phrases: TestPhrases) -> DataFrame:
    """HIT_SCHEMA: one row per document with a match, with the word spans of its runs and their items."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, segment in _segments(batches):
            starts, ends, items = segment.runs(phrases)
            doc = segment.document(starts)
            order = np.lexsort((items, ends, starts, doc))
            doc, starts, ends, items = (x[order] for x in (doc, starts, ends, items))
            heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))[: len(doc)]
            cuts = [*heads.tolist(), len(doc)]
            begin = segment.first[doc]
            spans = [sorted(set(zip((starts - begin)[a:b].tolist(), (ends - begin)[a:b].tolist()))) for a, b in zip(cuts, cuts[1:])]
            names = [sorted({phrases.items[i] for i in set(items[a:b].tolist())}) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(heads), pa.int64()), pa.array(doc[heads].astype(np.int32)), *(pa.array([[x[k] for x in s] for s in spans], pa.list_(pa.int32())) for k in (0, 1)), pa.array(names, pa.list_(pa.string()))],
                names=["segment", "place", "starts", "ends", "items"],
            )

    return index.select(*_SEARCHED).mapInArrow(search, HIT_SCHEMA)


def documents_of(index: DataFrame) -> DataFrame:
    """segment, place, doc_id, row_key, n_words of every document in the index."""
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "keys", "n_words")).alias("place", "z"))
    return rows.select("segment", "place", F.col("z.doc_ids").alias("doc_id"), F.col("z.keys").alias("row_key"), F.col("z.n_words").cast("bigint").alias("n_words"))


def proximity_matches(index: DataFrame, phrases: TestPhrases, slop: int) -> DataFrame:
    """(doc_id, item_id, position): all words of a window of the item close together, in any order."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, segment in _segments(batches):
            segment.look_up(phrases.terms)
            out = set()
            for n, starts in phrases.starts.items():
                for start in starts.tolist():
                    at = segment.near(phrases.line[start : start + n], slop)
                    doc = segment.document(at)
                    out.update(zip(doc.tolist(), [phrases.items[phrases.item[start]]] * len(at), (at - segment.first[doc]).tolist()))
            rows = sorted(out)
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["segment", "place", "item_id", "position"])

    found = index.select(*_SEARCHED).mapInArrow(search, "segment bigint, place int, item_id string, position bigint")
    return found.join(documents_of(index), ["segment", "place"]).select("doc_id", "item_id", "position")


def test_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, str]]]:
    """The test items in blocks of bounded size, one block at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text) // 2 + 1
        if size >= block_words:
            yield block
            block, size = [], 0
    yield block


test_blocks.__test__ = False


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """doc_id, row_key, n_words, starts, ends, items of every document, over all blocks of the test items."""
    spark = docs.sparkSession
    index, folder = written(build_index(docs, segment_bytes), "postings"), new_folder(spark, "hits")
    for block in test_blocks(benchmark, block_words):  # the driver holds one block at a time
        exact_matches(index, TestPhrases(block, window)).write.mode("append").parquet(folder)
    found = spark.read.schema(HIT_SCHEMA).parquet(folder)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")]
    hits = found.groupBy("segment", "place").agg(*lists, F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    none = F.array().cast("array<int>")
    joined = documents_of(index).join(hits, ["segment", "place"], "left")
    return joined.select("doc_id", "row_key", "n_words", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(matches: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and the items."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            hits, shas = [], []
            for n, starts, ends, items in zip(batch.column("n_words").to_pylist(), batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), batch.column("items").to_pylist()):
                if not starts:
                    hits.append(0)
                    shas.append(empty)
                    continue
                edge = np.zeros(n + 1, dtype=np.int64)
                np.add.at(edge, np.array(starts), 1)
                np.add.at(edge, np.array(ends), -1)
                hits.append(int((np.cumsum(edge) > 0).sum()))
                shas.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), batch.column("n_words"), pa.array(hits, pa.int64()), pa.array([len(x) for x in batch.column("items").to_pylist()], pa.int64()), pa.array(shas, pa.string()), pa.array([h > 0 for h in hits], pa.bool_()), batch.column("items")],
                names=["doc_id", "row_key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
            )

    return matches.mapInArrow(digest, "doc_id bigint, row_key bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, items array<string>")
