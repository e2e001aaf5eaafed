"""Language-model scoring by cross-entropy difference.

Two bigram models that match in vocabulary, order and smoothing are counted: one over the target documents, one over
the whole corpus as background. A document's score is the mean over its words of the target's loss less the
background's, in bits: the lower, the more the document is like the target.

All counts cover all documents and all words: every word of the corpus is an entry, and one more stands before a
document's first word. A bigram has Witten-Bell smoothing with the add-one unigram model. Counts stay in Spark:

1. Documents are packed into slices of bounded size, words numbered within each slice.
2. Each slice asks for its distinct bigrams with its own counts of them, dealt out by ranges of their hashes. A part adds
   up equal hashes and answers each slice in the order it asked, so a frequent bigram meets once a slice, not once a word.
   More than `FAN` slices ask over a tree: so many slices are added up to a node, so many nodes to a node above, and the
   answers come down the same way; a group never holds more than `FAN` rows, and a node's parts follow its words.
   One slice of those that hold a bigram is told so and counts it among the kinds that follow the first word.
3. Words are added up in the same way; then each slice scores its documents.

Only sums go to the driver (words, words of the target, entries). Words and bigrams have hashes of 64 bits. Given a
`vocabulary`, the entries are its `vocabulary` - 1 most frequent words (ties by bytes) and one for all others.

Words are runs of digits, ASCII letters in lower case and anything beyond ASCII. Defined cases: documents without words
(null, empty, punctuation only) have n_tokens 0 and null losses; without target documents the target model is uniform;
a null or repeated doc_id is just another row, a target if its id is one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id, written
from .decontamination import words_of

FLUSH = 200_000
SLICE = 8 << 20  # characters of text in a slice, unless one document has more
PART = 2 << 20  # words for each part of the hashes
FAN = 128  # slices that meet in one group

SLICES = "slice bigint, doc_ids array<bigint>, sizes array<bigint>, target array<boolean>, n bigint, n_target bigint, width int, words binary, hashes binary"
ASKED = "part int, slice bigint, keys binary, counts binary"
ANSWERED = "kind int, part int, slice bigint, n int, entries bigint, sums binary, first binary"
SCORES = "doc_id bigint, n_tokens bigint, target_bits double, background_bits double, score double"


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), n over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for part in text_batches(batches, 4 << 20):
            for text in part.column(0).to_pylist():
                counts.update(words_of(text))
            if len(counts) > FLUSH:
                yield out()
                counts.clear()
        yield out()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(docs: DataFrame, vocabulary: int) -> set[bytes]:
    """The most frequent words."""
    if vocabulary < 2:
        raise ValueError("vocabulary must be 2 at least")
    return {bytes(r.word) for r in word_counts(docs).orderBy(F.desc("n"), "word").limit(vocabulary - 1).collect()}


def bits(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """Loss of bigrams with count n, whose first word has `total` bigrams of `kinds` kinds."""
    kinds = np.maximum(kinds, 1)
    return -np.log2((n + kinds * unigram) / (total + kinds))


def losses(codes: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Bits of each (previous word, word) as a whole table, from counts by code (previous word * size + word)."""
    table = np.zeros((size, size))
    table.reshape(-1)[codes] = n
    return bits(table, table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True), (table.sum(axis=0) + 1) / (table.sum() + size))


class _Numbers(dict):
    """Numbers words by their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _hashes(words: list[bytes | None]) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(8) if w is None else hashlib.blake2b(w, digest_size=8).digest() for w in words), dtype=np.uint64)


def slices(docs: DataFrame, known: set[bytes] | None = None, size: int = SLICE) -> DataFrame:
    """SLICES from doc_id, text, target: numbers of the words of some whole documents, and the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        numbers, held = _Numbers({None: 0}), 0

        def out() -> pa.RecordBatch:
            width = 2 if len(numbers) <= 1 << 16 else 4
            sizes = np.array([len(r[2]) for r in rows])
            target = np.array([r[1] for r in rows], dtype=bool)
            words = np.concatenate([r[2] for r in rows]).astype(f"<u{width}").tobytes()
            row = {"slice": serial, "doc_ids": [r[0] for r in rows], "sizes": sizes.tolist(), "target": target.tolist(), "n": int(sizes.sum()), "n_target": int(sizes[target].sum()), "width": width, "words": words, "hashes": _hashes(list(numbers)).tobytes()}
            return pa.RecordBatch.from_pylist([row], pa.schema([("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("target", pa.list_(pa.bool_())), ("n", pa.int64()), ("n_target", pa.int64()), ("width", pa.int32()), ("words", pa.binary()), ("hashes", pa.binary())]))

        for part in text_batches(batches, 4 << 20):
            for doc_id, text, target in zip(*(part.column(k).to_pylist() for k in range(3))):
                words = words_of(text)
                if known is not None:
                    words = [w if w in known else None for w in words]
                rows.append((doc_id, target, np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))))
                held += len(text or "") + 64
                if held >= size:
                    yield out()
                    serial, rows, numbers, held = serial + 1, [], _Numbers({None: 0}), 0
        if rows:
            yield out()

    return docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("target")).mapInArrow(run, SLICES)


class _Slice:
    """One row of SLICES: its words and distinct bigrams."""

    def __init__(self, row: dict):
        self.doc_ids, self.sizes = row["doc_ids"], np.array(row["sizes"], dtype=np.int64)
        self.hashes = np.frombuffer(row["hashes"], dtype=np.uint64)
        self.words = np.frombuffer(row["words"], dtype=f"<u{row['width']}").astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.target = np.array(row["target"], dtype=bool)[self.doc]
        before = np.concatenate(([0], self.words[:-1]))[: len(self.words)]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = 0  # a document's first word follows entry 0
        self.before = before
        found, self.bigram = np.unique(before * len(self.hashes) + self.words, return_inverse=True)
        self.a, self.b = found // len(self.hashes), found % len(self.hashes)

    def bigram_keys(self) -> np.ndarray:
        x = self.hashes[self.a] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[self.b]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def both(self, of: np.ndarray, size: int) -> list[np.ndarray]:
        """Counts over all words and over the target's."""
        return [np.bincount(of, minlength=size), np.bincount(of[self.target], minlength=size)]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, dtype: type, shape: tuple[int, int]) -> np.ndarray:
    size = shape[0] * shape[1] * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), dtype=dtype).reshape(shape)


def _ask(number: int, keys: np.ndarray, counts: list[np.ndarray], parts: int, kind: type = np.uint32) -> pa.Table:
    """ASKED of one slice or node, one row a part."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    table = np.stack(counts).astype(kind)[:, order]
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))[: len(part)]
    ends = np.append(at[1:], len(part))
    return pa.table([pa.array(part[at], pa.int32()), pa.array([number] * len(at), pa.int64()), pa.array([keys[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()), pa.array([_packed(table[:, i:j]) for i, j in zip(at, ends)], pa.binary())], names=["part", "slice", "keys", "counts"])


def _answer(rows: list[dict], keys: np.ndarray, columns: int, what: str) -> np.ndarray:
    """The sums, or the marks `first`, in the order of a slice's keys, one row a column."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros((columns, len(keys)), dtype=np.int64 if what == "sums" else bool)
    at = 0
    for r in sorted(rows, key=lambda r: r["part"]):
        n = r["n"]
        here = _unpacked(r["sums"], np.int64, (columns, n)) if what == "sums" else np.unpackbits(np.frombuffer(r["first"], dtype=np.uint8), count=columns * n).reshape(columns, n)
        out[:, order[at : at + n]] = here
        at += n
    return out


def _together(group: pa.Table, columns: int, kind: type) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows' keys in one line, the distinct keys, each place's number among them, and the counts."""
    keys = [np.frombuffer(k, dtype=np.uint64) for k in group["keys"].to_pylist()]
    counts = np.concatenate([_unpacked(c, kind, (columns, len(k))) for c, k in zip(group["counts"].to_pylist(), keys)], axis=1)
    ends = np.cumsum([len(k) for k in keys])
    distinct, entry = np.unique(np.concatenate(keys), return_inverse=True)
    return list(zip([0, *ends[:-1].tolist()], ends.tolist())), distinct, entry, counts


def _sums(entry: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(entry, weights=n, minlength=size).astype(np.int64) for n in counts])  # exact below 2**53


def _answers(kind: int, group: pa.Table, places: list[tuple[int, int]], entry: np.ndarray, counts: np.ndarray, sums: np.ndarray, marked: np.ndarray | None, entries: int) -> pa.Table:
    """ANSWERED for each row of the group: the sums, and in each column a mark at the first place of a key whose count
    isn't 0. marked: the keys that may have one, as another node's row has it otherwise."""
    first = np.zeros(counts.shape, dtype=bool)
    for j in range(len(counts)):
        some = np.flatnonzero(counts[j])
        first[j, some[np.unique(entry[some], return_index=True)[1]]] = True
        if marked is not None:
            first[j] &= marked[j][entry]
    total = [entries] + [0] * (len(places) - 1)
    return pa.table([pa.array([kind] * len(places), pa.int32()), group["part"].cast(pa.int32()), group["slice"], pa.array([j - i for i, j in places], pa.int32()), pa.array(total, pa.int64()), pa.array([_packed(sums[:, entry[i:j]]) for i, j in places], pa.binary()), pa.array([np.packbits(first[:, i:j]).tobytes() for i, j in places], pa.binary())], names=["kind", "part", "slice", "n", "entries", "sums", "first"])


def parts_for(words: int, slices: int, part: int = PART, fan: int = FAN) -> int:
    """Parts of the hashes among `fan` slices, or all if they are fewer."""
    return max(1, -(-words * min(slices, fan) // (max(1, slices) * part)))


def exchange(asked: DataFrame, columns: int, kind: int, parts: int, slices: int, fan: int = FAN, dtype: type = np.uint32) -> DataFrame:
    """ANSWERED: for each row asked the sums of its keys over all slices, and a mark at the first place of each key in
    each column where its count isn't 0. entries: distinct keys of the part, in one row of it."""
    if slices <= fan:

        def run(group: pa.Table) -> pa.Table:
            group = group.sort_by("slice")
            places, distinct, entry, counts = _together(group, columns, dtype)
            return _answers(kind, group, places, entry, counts, _sums(entry, counts, len(distinct)), None, len(distinct))

        return asked.groupBy("part").applyInArrow(run, ANSWERED)
    nodes = -(-slices // fan)
    finer = min(fan, nodes)  # a part below is so many parts of the nodes
    held = written(asked.withColumn("node", F.pmod(F.xxhash64("slice"), F.lit(nodes))), "asked")

    def added(key: tuple, group: pa.Table) -> pa.Table:
        _, distinct, entry, counts = _together(group, columns, dtype)
        return _ask(key[0].as_py(), distinct, list(_sums(entry, counts, len(distinct))), parts * finer, np.int64)

    above = written(exchange(held.groupBy("node", "part").applyInArrow(added, ASKED), columns, kind, parts * finer, nodes, fan, np.int64), "answered")
    down = above.select("slice", F.floor(F.col("part") / finer).cast("int").alias("below"), "part", "n", "entries", "sums", "first")

    def passed_on(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("slice")
        places, distinct, entry, counts = _together(left, columns, dtype)
        rows = right.to_pylist()
        sums, marked = (_answer(rows, distinct, columns, what) for what in ("sums", "first"))
        return _answers(kind, left, places, entry, counts, sums, marked, sum(r["entries"] for r in rows))

    return held.groupBy("node", "part").cogroup(down.groupBy("slice", "below")).applyInArrow(passed_on, ANSWERED)


def ask_bigrams(packed: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["n"]:
                    s = _Slice(row)
                    yield from _ask(row["slice"], s.bigram_keys(), s.both(s.bigram, len(s.a)), parts).to_batches()

    return packed.mapInArrow(run, ASKED)


def ask_words(packed: DataFrame, bigrams: DataFrame, parts: int) -> DataFrame:
    """Of each word: uses, bigrams it begins and their kinds, each over all documents and over the target's."""
    empty = pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())], names=["part", "slice", "keys", "counts"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        if not row["n"]:
            return empty
        s = _Slice(row)
        size = len(s.hashes)
        first = _answer(right.to_pylist(), s.bigram_keys(), 2, "first")
        return _ask(row["slice"], s.hashes, s.both(s.words, size) + s.both(s.before, size) + [np.bincount(s.a[f], minlength=size) for f in first], parts)

    return packed.groupBy("slice").cogroup(bigrams.select("slice", "part", "n", "first").groupBy("slice")).applyInArrow(run, ASKED)


def score(packed: DataFrame, answers: DataFrame, n: tuple[int, int], entries: int) -> DataFrame:
    """SCORES: one row for each document in the slices."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        s = _Slice(row)
        total = [np.zeros(len(s.sizes)), np.zeros(len(s.sizes))]
        if row["n"]:
            rows = right.to_pylist()
            pairs = _answer([r for r in rows if r["kind"] == 0], s.bigram_keys(), 2, "sums")
            words = _answer([r for r in rows if r["kind"] == 1], s.hashes, 6, "sums")
            for j in (0, 1):
                loss = bits(pairs[j], words[2 + j][s.a], words[4 + j][s.a], (words[j][s.b] + 1) / (n[j] + entries))
                total[j] = np.bincount(s.doc, weights=loss[s.bigram], minlength=len(s.sizes))
        some = s.sizes == 0
        background, target = (t / np.maximum(s.sizes, 1) for t in total)
        return pa.table([pa.array(s.doc_ids, pa.int64()), pa.array(s.sizes), *(pa.array(x, mask=some) for x in (target, background, target - background))], names=["doc_id", "n_tokens", "target_bits", "background_bits", "score"])

    return packed.groupBy("slice").cogroup(answers.select("slice", "kind", "part", "n", "sums").groupBy("slice")).applyInArrow(run, SCORES)


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None, size: int = SLICE, part: int = PART, fan: int = FAN) -> DataFrame:
    """Scores every document against the documents whose doc_id is in `target_ids`.

    The ids grow with the corpus, so they are never broadcast."""
    small_batches(docs.sparkSession)
    known = None if vocabulary is None else vocabulary_of(docs, vocabulary)
    ids = target_ids.select(whole_id("doc_id").alias("__target")).distinct().hint("merge")
    texts = docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = texts.join(ids, F.col("doc_id") == F.col("__target"), "left").select("doc_id", "text", F.col("__target").isNotNull().alias("target"))
    packed = written(slices(marked, known, size), "word-numbers")
    sums = packed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0)), F.count("*")).first()
    n, slices_ = (int(sums[0]), int(sums[1])), int(sums[2])
    parts = parts_for(n[0], slices_, part, fan)
    bigrams = written(exchange(ask_bigrams(packed, parts), 2, 0, parts, slices_, fan), "bigram-counts")
    words = written(exchange(ask_words(packed, bigrams, parts), 6, 1, parts, slices_, fan), "word-counts")
    entries = vocabulary or int(words.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0])
    return score(packed, bigrams.unionByName(words), n, entries)
