"""Phrase collocation mining: phrases that occur oftener than their parts let expect, by HAT-trie counting.

A word's id is the hash of its language and itself. Word counts are summed on Spark by id, and should two words share an
id, all is hashed anew with another salt; so ids are exact, and an n-gram is the list of its words' ids. N-grams are
counted in four passes over the texts: words, pairs of frequent words, triples of frequent pairs, longer phrases whose
triples are all frequent. As every occurrence of a phrase is one of each of its parts, nothing frequent is left out.

In a task, a HAT-trie holds the counts: a shallow trie over word ids (the first word, then also the second), under it
hash containers of the words that remain. A container that grows large bursts into containers by its next word. When the
trie holds `LIMIT` entries, its largest subtrees are spilled as sorted runs until half of it is left. Prefixes are dealt
out to `PARTS` times as many prefix partitions as Spark shuffles to, by the first word's hash (of words with a thousandth
of all words or more, a thousand at most, by the first two words', so that a frequent word is spread). A run's part of a
prefix partition is one row of arrays. Spark brings the rows of a partition together, where they are merged as a stream,
which puts out the frequent phrases alone.

What a pass knows of the frequent phrases before is a bit table of a size that is bounded (`FILTER_BITS`), whatever the
corpus: each is entered twice, strangers that pass by chance are counted too and go with the rare ones after the merge.

Words are the parts of a lower-cased (A-Z) text between spaces, tabs and piece ends (`[.,;:!?\\x0A-\\x0D]`); phrases don't
cross piece ends or documents. Defined cases: a null or empty text has no words; a null language is `und`; rows that
repeat a doc_id count like any others; a null or odd doc_id doesn't matter, nor do further columns; an empty table gives
none. Memory follows the number of words of a single text, with some 20 bytes for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_batches, written
from .hashing import mixed, span_hashes, utf8_column

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
COVERED = 100  # percent of a phrase's occurrences that a longer one has to hold to replace it
LIMIT = 500_000  # entries of a trie, and words of a task's table
BURST = 4096  # entries of a container
HOT = 1000  # a word with a HOT-th of all words is dealt out by the next word too
PARTS = 16  # prefix partitions for each partition of a shuffle
RUN = 1 << 14  # entries of a run's row
TOGETHER = 1 << 20  # entries that are merged together
FILTER_BITS = 27  # a bit table has at most 2 ** FILTER_BITS bits
SLICE = 4 << 20  # bytes of text that are worked on together
STRETCH = 1 << 20  # bytes that are hashed, and words that are counted together

_WORD, _BLANK, _END = range(3)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _BLANK
_KINDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

RUNS = "part int, grams binary, counts binary"


def _stretches(kinds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about STRETCH bytes that end before a byte that is in no word."""
    at = 0
    while at < len(kinds):
        end = at + STRETCH
        while end < len(kinds):
            found = np.flatnonzero(kinds[end : end + 65536])
            if len(found):
                end += int(found[0])
                break
            end += 65536
        yield at, min(end, len(kinds))
        at = end


class Words:
    """The words of the texts raw[bounds[i]:bounds[i + 1]] in their order: id and piece of each, and its bytes."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, languages: np.ndarray):
        """languages: a hash for each text."""
        raw = _LOWER[raw]
        kinds = _KINDS[raw]
        inside = kinds == _WORD
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = np.diff(bounds) > 0
        first, last = bounds[:-1][full], bounds[1:][full] - 1
        begins[first], ends[last] = inside[first], inside[last]
        self.raw, self.starts, self.ends = raw, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(bounds, self.starts, "right") - 1
        self.piece = np.cumsum(kinds == _END)[self.starts] + self.text
        self.ids = np.empty(len(self.starts), np.uint64)
        for a, b in _stretches(kinds):
            i, j = np.searchsorted(self.starts, (a, b))
            self.ids[i:j] = span_hashes(raw[a:b], self.starts[i:j] - a, self.ends[i:j] - a)
        self.ids = mixed(self.ids ^ languages[self.text])
        self.ids[self.ids == 0] = 1  # 0 stands for no word


def _bit_places(key, bits: int, shift=lambda x, n: x >> np.uint64(n), both=lambda x, m: x & np.uint64(m)):
    """The two places of a 64-bit key in a table of 2 ** bits bits."""
    return both(key, (1 << bits) - 1), both(shift(key, 64 - bits), (1 << bits) - 1)


class BitTable:
    """Tells keys that may have been entered from ones that haven't."""

    def __init__(self, keys: DataFrame, max_bits: int):
        """keys: one bigint column `key`. The bits are gathered on Spark; a table of bounded size comes to the driver."""
        entries = keys.count()
        self.bits = min(max_bits, max(16, int(32 * entries).bit_length()))
        places = _bit_places(F.col("key"), self.bits, lambda x, n: F.shiftrightunsigned(x, n), lambda x, m: x.bitwiseAND(F.lit(m).cast("bigint")))
        words = keys.select(F.explode(F.array(*places)).alias("place")).groupBy(F.shiftright("place", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 32 AS int))")).alias("bits")).toArrow()
        table = np.zeros(1 << (self.bits - 5), np.uint32)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
        self.table = table.view(np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in _bit_places(keys, self.bits):
            found &= (self.table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _gram_keys(ids: np.ndarray, size: int) -> np.ndarray:
    """One key for each `size` ids in a row."""
    n = len(ids) - size + 1
    key = ids[:n]
    for i in range(1, size):
        key = (key << np.uint64(31) | key >> np.uint64(33)) ^ ids[i : n + i]
    return key


def _gram_key_column(size: int) -> Column:
    """The same for the list `w`."""
    at = lambda i: F.get("w", F.lit(i))
    key = at(0)
    for i in range(1, size):
        key = F.shiftleft(key, 31).bitwiseOR(F.shiftrightunsigned(key, 33)).bitwiseXOR(at(i))
    return key


class HatTrie:
    """Counts of n-grams of up to `width` ids (shorter ones end in zeros)."""

    def __init__(self, width: int, limit: int = LIMIT, burst: int = BURST):
        self.width, self.limit, self.burst, self.size = width, limit, burst, 0
        self.root: dict[int, HatTrie.Container] = {}

    class Container:
        """A hash of the ids that remain, or, once burst, containers by the next id."""

        __slots__ = ("children", "counts", "size")

        def __init__(self):
            self.counts: dict[bytes, int] | None = {}
            self.children: dict[bytes, dict[bytes, int]] = {}
            self.size = 0

        def add(self, keys: list[bytes], counts: list[int]) -> int:
            """How many of the keys are new."""
            before = self.size
            if self.counts is not None:
                own = self.counts
                for key, n in zip(keys, counts):
                    own[key] = own.get(key, 0) + n
                self.size = len(own)
            else:
                for key, n in zip(keys, counts):
                    own = self.children.get(key[:8])
                    if own is None:
                        own = self.children[key[:8]] = {}
                    rest = key[8:]
                    if rest in own:
                        own[rest] += n
                    else:
                        own[rest] = n
                        self.size += 1
            return self.size - before

        def split(self) -> None:
            for key, n in self.counts.items():
                self.children.setdefault(key[:8], {})[key[8:]] = n
            self.counts = None

        def entries(self) -> tuple[list[bytes], list[int]]:
            if self.counts is not None:
                return list(self.counts), list(self.counts.values())
            return [second + rest for second, own in self.children.items() for rest in own], [n for own in self.children.values() for n in own.values()]

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Rows of `width` ids, in order of the first."""
        rest = np.ascontiguousarray(rows[:, 1:]).view(f"V{8 * (self.width - 1)}").ravel().tolist()
        counts = counts.tolist()
        edges = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0], [True]))).tolist()
        firsts = rows[edges[:-1], 0].tolist()
        for first, a, b in zip(firsts, edges, edges[1:]):
            own = self.root.get(first)
            if own is None:
                own = self.root[first] = self.Container()
            self.size += own.add(rest[a:b], counts[a:b])
            if own.size > self.burst and own.counts is not None and self.width > 2:
                own.split()

    def spilled(self, down_to: int, parts: int, hot: frozenset[int] = frozenset()) -> Iterator[pa.RecordBatch]:
        """RUNS: takes whole subtrees out, the largest first, until `down_to` entries are left, as one run by prefix
        partition and, within it, in order."""
        keys: list[bytes] = []
        counts: list[int] = []
        firsts, sizes = [], []
        for first in sorted(self.root, key=lambda x: -self.root[x].size):
            if self.size <= down_to:
                break
            own = self.root.pop(first)
            self.size -= own.size
            rest, n = own.entries()
            keys += rest
            counts += n
            firsts.append(first)
            sizes.append(len(rest))
        if not keys:
            return
        rows = np.empty((len(keys), self.width), np.uint64)
        rows[:, 0] = np.repeat(np.array(firsts, np.uint64), sizes)
        rows[:, 1:] = np.frombuffer(b"".join(keys), np.uint64).reshape(len(keys), -1)
        second = np.where(np.repeat([f in hot for f in firsts], sizes), rows[:, 1], np.uint64(0))
        part = (mixed(rows[:, 0] ^ mixed(second)) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((*rows.T[::-1], part))
        rows, part, n = rows[order], part[order], np.array(counts, np.int64)[order]
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))).tolist()
        cuts = [(i, min(b, i + RUN)) for a, b in zip(edges, edges[1:]) for i in range(a, b, RUN)]
        yield pa.RecordBatch.from_arrays([pa.array(part[[i for i, _ in cuts]]), pa.array([rows[i:j].tobytes() for i, j in cuts], pa.binary()), pa.array([n[i:j].tobytes() for i, j in cuts], pa.binary())], names=["part", "grams", "counts"])


def distinct_rows(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each different row once, in order of the first id, and how often it is there (or the sum of its counts)."""
    key = rows[:, 0]
    for i in range(1, rows.shape[1]):
        key = key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i]
    order = np.argsort(key)
    in_order, key = rows[order], key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    if (in_order[1:] != in_order[:-1])[~new[1:]].any():  # different rows of one key
        order = np.lexsort(rows.T[::-1])
        in_order = rows[order]
        new = np.concatenate(([True], (in_order[1:] != in_order[:-1]).any(axis=1)))
    at = np.flatnonzero(new)
    sums = np.diff(np.concatenate((at, [len(rows)]))) if counts is None else np.add.reduceat(counts[order], at)
    rows = in_order[at]
    order = np.argsort(rows[:, 0], kind="stable")
    return rows[order], sums[order]


def merged_runs(runs: DataFrame, width: int, min_count: int) -> DataFrame:
    """w, n of the phrases that all runs together have min_count times. The rows of a prefix partition stand together and
    are summed some at a time; small partitions together, and of a large one only the distinct phrases are kept."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, bound, last = 0, TOGETHER, None

        def summed() -> tuple[np.ndarray, np.ndarray]:
            return distinct_rows(np.concatenate([r for r, _ in held]), np.concatenate([c for _, c in held]))

        def out(rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            often = counts >= min_count
            rows, counts = rows[often], counts[often]
            words = rows != 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(words.sum(axis=1)))).astype(np.int32)), pa.array(rows[words].view(np.int64)))
            return pa.RecordBatch.from_arrays([lists, pa.array(counts)], names=["w", "n"])

        for batch in batches:
            for part, grams, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= bound:
                    rows, sums = summed()
                    if part != last:
                        yield out(rows, sums)
                        held, size, bound = [], 0, TOGETHER
                    else:
                        held, size, bound = [(rows, sums)], len(rows), max(TOGETHER, 2 * len(rows))
                held.append((np.frombuffer(grams, np.uint64).reshape(-1, width), np.frombuffer(counts, np.int64)))
                size += len(held[-1][1])
                last = part
        if held:
            yield out(*summed())

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "w array<bigint>, n bigint")


def _slices(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[tuple[Words, pa.Array]]:
    for part in text_batches(batches, SLICE):
        raw, at = utf8_column(part.column(0))
        languages = mixed(span_hashes(raw, at[:-1], at[1:]) + np.uint64(salt))
        yield Words(*utf8_column(part.column(1)), languages), part.column(0)


def _word_counts(rows: DataFrame, salt: int) -> DataFrame:
    """id, lang, word, n, clash (whether several words have this id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        names: dict[int, tuple[str, bytes]] = {}

        def batch():
            ids = np.array(list(counts), np.uint64).view(np.int64)
            own = [names[i] for i in counts]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["id", "lang", "word", "n"])

        for words, langs in _slices(batches, salt):
            ids, first, n = np.unique(words.ids, return_index=True, return_counts=True)
            langs, text = langs.to_pylist(), words.raw.tobytes()
            for i, at, k in zip(ids.tolist(), first.tolist(), n.tolist()):
                name = langs[words.text[at]], text[words.starts[at] : words.ends[at]]
                if names.setdefault(i, name) != name:
                    raise ValueError("two words of a task share an id: use another salt")
                counts[i] = counts.get(i, 0) + k
            if len(counts) >= LIMIT:
                yield batch()
                counts.clear()
                names.clear()
        if counts:
            yield batch()

    found = rows.mapInArrow(run, "id bigint, lang string, word string, n bigint")
    named = F.struct("lang", "word")
    sums = found.groupBy("id").agg(F.sum("n").alias("n"), F.min(named).alias("least"), F.max(named).alias("most"))
    return sums.select("id", "least.lang", "least.word", "n", (F.col("least") != F.col("most")).alias("clash"))


def _phrase_counts(rows: DataFrame, salt: int, known: BitTable, hot: frozenset[int], sizes: range, min_count: int, limit: int) -> DataFrame:
    """The counts, at least min_count, of phrases of some sizes whose parts of one word less than the least are in `known`."""
    part, width = sizes.start - 1, sizes.stop - 1
    parts = PARTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(width, limit)
        for words, _ in _slices(batches, salt):
            ids = words.ids
            if len(ids) < sizes.start:
                continue
            often = words.piece[part - 1 :] == words.piece[: len(ids) - part + 1]  # whether a known part begins there
            at = np.flatnonzero(often)
            often[at] = known.has(_gram_keys(ids, part)[at])
            goes_on = often[1:] & (words.piece[part:] == words.piece[: len(ids) - part])  # one word more in the piece
            goes_on &= often[:-1]
            for start in range(0, len(goes_on), STRETCH):
                at = start + np.flatnonzero(goes_on[start : start + STRETCH])
                for n in sizes:
                    if n > sizes.start:  # the next part has to be there too
                        at = at[at + n - sizes.start < len(goes_on)]
                        at = at[goes_on[at + n - sizes.start]]
                    if len(at):
                        grams = np.zeros((len(at), width), np.uint64)
                        for i in range(n):
                            grams[:, i] = ids[at + i]
                        trie.add(*distinct_rows(grams))
                        if trie.size >= limit:
                            yield from trie.spilled(limit // 2, parts, hot)
        yield from trie.spilled(0, parts, hot)

    return merged_runs(rows.mapInArrow(run, RUNS), width, min_count)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, filter_bits: int = FILTER_BITS, limit: int = LIMIT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, lang, word, n) of all words; lang, n: its words; (w, n) of all phrases of 1 to max_words words (lists of ids) that occur min_count times."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"max_words has to be from 2 to {MAX_WORDS}")
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    for salt in range(16):
        words = written(_word_counts(rows, salt), "words")
        if words.where("clash").isEmpty():
            break
    else:
        raise RuntimeError("words of one id with every salt")
    words = words.drop("clash")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.where(F.col("n") >= min_count)
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = frozenset(r.id % 2**64 for r in often.where(F.col("n") * HOT >= total).select("id").collect())  # HOT rows at most
    last = often.select(F.array("id").alias("w"), "n")
    found = last
    for sizes in (range(2, 3), range(3, 4), range(4, max_words + 1)):
        if sizes.start <= max_words:
            known = BitTable(last.select(_gram_key_column(sizes.start - 1).alias("key")), filter_bits)
            last = written(_phrase_counts(rows, salt, known, hot, sizes, min_count, limit), f"phrases-{sizes.start}")
            found = found.unionByName(last)
    return words, totals, found


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, covered: int = COVERED, filter_bits: int = FILTER_BITS, limit: int = LIMIT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language by floor(1000 * a * n / (l * r)) of the cut
    with the lowest score (of equal ones the first), where a, l, r count the phrase, its part before and its part after
    the cut, and n all words. Phrases inside a longer one with `covered` percent of their occurrences are left out."""
    words, totals, found = phrase_counts(docs, min_count, max_words, filter_bits, limit)
    whole = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    phrases = found.where(F.size("w") > 1).select("w", F.col("n").alias("a"))
    known = words.where(F.col("n") >= min_count)
    own = phrases.join(known.select(F.col("id").alias("first_id"), "lang"), F.get("w", F.lit(0)) == F.col("first_id")).join(totals, "lang")
    cuts = own.select("w", "a", "lang", "n", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.withColumns({"left_part": F.expr("slice(w, 1, k)"), "right_part": F.expr("slice(w, k + 1, size(w))")})
    cuts = cuts.join(found.select(F.col("w").alias("left_part"), F.col("n").alias("l")), "left_part").join(found.select(F.col("w").alias("right_part"), F.col("n").alias("r")), "right_part")
    cuts = cuts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * whole("a", 16) * whole("n", 18), "below": whole("l", 18) * whole("r", 18)})
    scored = cuts.withColumn("score", F.expr("above div below")).groupBy("w", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = phrases.where(F.size("w") > 2).select(F.col("a").alias("longer"), F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> slice(w, i, m))))")).alias("w"))
    parts = parts.groupBy("w").agg(F.max("longer").alias("longer"))
    kept = scored.join(parts, "w", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    spelt = kept.select("*", F.posexplode("w").alias("place", "id")).join(known.select("id", "word"), "id")
    spelt = spelt.groupBy("w", "a", "lang", "n", "cut").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
