"""Exact substring deduplication with suffix arrays and their common-prefix interval trees.

A text is its UTF-8 bytes. A string of `length` bytes that starts earlier too (smaller doc_id, or the same document and
an earlier start) is a repeat, and every byte under a repeat goes; matches never cross documents.

No task sees the whole corpus. Every window of `length` bytes has an anchor, the least hash of the `GRAM`-byte strings
in it (the leftmost of equals); equal windows have equal anchors in the same place. So windows are dealt out by anchor:

1. The windows of one anchor occurrence are a run of starts; with the bytes under them they are a context. An occurrence
   after another of its context in one slice of a task is a repeat and needs no further meeting. The other occurrences
   are sorted by (anchor hash, context hash, doc_id, start), and read in that order with constant memory: all but the
   first of one context are repeats at once.
2. What is left are first contexts of anchors that have several. Their bytes are dealt out by anchor; locally, a suffix
   array over their window starts is built by prefix doubling, with the common-prefix lengths of neighbours. A stack
   scan gives its interval tree; an interval whose occurrences have different left neighbours is a maximal repeat, put
   out with all its occurrences. All but the earliest occurrence are repeats over its full length. The contexts of an
   anchor with more than `CONTEXTS` of them (a frequent string in ever other surroundings) never meet in one task: their
   windows are hashed, and equal ones added up and joined by Spark, to the same result.
3. The repeats of each document are merged and cut out.

`repeat_groups` gives the maximal repeats themselves, a row for each group and occurrence: the groups of the interval
trees, the copies of each context joined to them, and groups with the same occurrences that overlap or touch joined into
one, so that a repeat longer than a context is one group. (Where what follows a repeat occurs in still more places, the
longer repeat ends with its context.)

Equal contexts have equal anchor hashes and equal context hashes, equal windows of a frequent anchor equal hashes of both
halves: 128 bits in both cases. Defined cases: a null or empty text has no bytes; texts shorter than `length` stay; rows
with a null doc_id stay whole and count for nothing; rows that repeat a doc_id (with one text) are one document and come
out alike; further columns are left out, and an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id, written

LENGTH = 100
GRAM = 24
PIECE = 1 << 22  # longer texts are read in overlapping pieces
LOCAL_BYTES = 2 << 20  # contexts that are indexed together
CONTEXTS = 8192  # of one anchor that are indexed together

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = 24  # bits


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class Grams:
    """Hashes of substrings of one text, in constant time each."""

    power, inverse = _powers(_BASE, 1 << 17), _powers(_INVERSE, 1 << 17)

    def __init__(self, raw: np.ndarray):
        if len(raw) + 1 > len(Grams.power):
            Grams.power, Grams.inverse = _powers(_BASE, 2 * len(raw)), _powers(_INVERSE, 2 * len(raw))
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.power[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def contexts(raw: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, first and last window start of each anchor's run of windows."""
    if len(raw) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    g = Grams(raw)
    n = len(raw) - gram + 1
    hashes = _mixed((g.sums[gram:] - g.sums[:-gram]) * g.inverse[:n])
    places = np.arange(n, dtype=np.uint64)
    least = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | places
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    anchor = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:], [len(anchor)])) - 1
    at = anchor[first]
    return hashes[at], g.of(first, last + length) + _mixed((at - first).astype(np.uint64)), first, last


def _later(a: np.ndarray, c: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which occurrences have an earlier one of the same context among those given."""
    both = a.view(np.uint64) ^ _mixed(c.view(np.uint64))
    order = np.lexsort((first, ids, both))
    a, c, ids, first = a[order], c[order], ids[order], first[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))[: len(a)]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    out = np.zeros(len(a), dtype=bool)
    out[order] = ~new & ((ids != ids[lead]) | (first != first[lead]))
    return out


def anchors(docs: DataFrame, length: int, gram: int = GRAM, mark: bool = True) -> DataFrame:
    """anchor, context, doc_id, first, last (window starts), known (only if `mark`) over whole texts.

    known: an earlier occurrence of the context is in the same slice of a task, so this one is a repeat whatever else
    there is. It no longer has to meet the others and gets a key of its own, so a frequent passage sends one row a
    slice to its anchor's task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 4 << 20):
            found = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                for start in range(0, max(1, len(raw) - length + 1), PIECE):
                    a, c, first, last = contexts(raw[start : start + PIECE + length - 1], length, gram)
                    found.append((a.view(np.int64), c.view(np.int64), np.full(len(a), doc_id), first + start, last + start))
            a, c, ids, first, last = (np.concatenate(x) for x in zip(*found))
            known = _later(a, c, ids, first) if mark else np.zeros(len(a), dtype=bool)
            a[known] = _mixed(ids[known].astype(np.uint64) * np.uint64(_BASE) + first[known].astype(np.uint64)).view(np.int64)
            for i in range(0, len(a), 50_000):
                j = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(a[j]), pa.array(c[j]), pa.array(ids[j]), pa.array(first[j].astype(np.int32)), pa.array(last[j].astype(np.int32)), pa.array(known[j])], names=["anchor", "context", "doc_id", "first", "last", "known"])

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, "anchor bigint, context bigint, doc_id bigint, first int, last int, known boolean")


def sort_out(found: DataFrame) -> DataFrame:
    """doc_id, first, last, anchor: runs of repeats (anchor null), and first contexts of anchors with several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None  # (anchor, context, doc_id, first, last, told) of the newest first context
        for batch in batches:
            if not batch.num_rows:
                continue
            a, c, ids, first, last, known = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            told = False
            if head is not None:
                a, c, ids, first, last, known = (np.concatenate(([h], x)) for h, x in zip((*head[:5], False), (a, c, ids, first, last, known)))
                told = head[5]
            same_anchor = np.concatenate(([False], a[1:] == a[:-1]))
            new = ~(same_anchor & np.concatenate(([False], c[1:] == c[:-1])))
            lead = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            repeat = known | ~new & ((ids != ids[lead]) | (first != first[lead]))
            heads = np.flatnonzero(new)
            shares_before = np.concatenate(([False], a[heads[1:]] == a[heads[:-1]]))
            shares = shares_before | np.concatenate((shares_before[1:], [False]))
            out = heads[shares]
            newest_told = bool(shares[-1]) or (told and len(heads) == 1)
            if told and len(out) and out[0] == 0:
                out = out[1:]
            i = int(heads[-1])
            head = (a[i], c[i], ids[i], first[i], last[i], newest_told)
            gone = np.flatnonzero(repeat)
            rows = np.concatenate((gone, out))
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(first[rows].astype(np.int32)), pa.array(last[rows].astype(np.int32)), pa.array(a[rows], pa.int64(), mask=np.arange(len(rows)) < len(gone))], names=["doc_id", "first", "last", "anchor"])

    return found.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id", "first").mapInArrow(run, "doc_id bigint, first int, last int, anchor bigint")


def suffix_array(raw: np.ndarray, starts: np.ndarray, groups: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at `starts`, each up to its context's end, that share `length` bytes with another of their group:
    their order by group and bytes, and how many bytes each shares with the one before it (0: under `length`)."""
    if length < 8:
        raise ValueError("length must be 8 bytes at least")
    padded = np.concatenate((raw, np.zeros(2 * length, np.uint8)))
    n = len(raw) + length
    rank = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k : k + n].astype(np.uint64)
    _, rank = np.unique(rank, return_inverse=True)
    reach = 8
    while 2 * reach <= length:  # prefix doubling
        after = np.concatenate((rank[reach:], np.zeros(reach, rank.dtype)))
        _, rank = np.unique(rank.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64), return_inverse=True)
        reach *= 2
    key = rank[starts].astype(np.uint64) << np.uint64(32) | rank[starts + length - reach].astype(np.uint64)
    order = np.lexsort((key, groups))
    same = (key[order][1:] == key[order][:-1]) & (groups[order][1:] == groups[order][:-1])
    some = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    if not len(some):
        return some, np.zeros(0, dtype=np.int64)
    # beyond `length`, byte by byte up to the context's end, which sorts first (no byte of UTF-8 is 255)
    width = max(1, int((ends[some] - starts[some]).max()) - length)
    places = starts[some, None] + length + np.arange(width)
    tail = np.where(places < ends[some, None], padded[np.minimum(places, n)] + np.uint8(1), np.uint8(0))
    fine = np.lexsort((np.ascontiguousarray(tail).view(f"S{width}").ravel(), key[some], groups[some]))
    some, tail = some[fine], tail[fine]
    same = (key[some][1:] == key[some][:-1]) & (groups[some][1:] == groups[some][:-1])
    differ = (tail[1:] != tail[:-1]) | (tail[1:] == 0)
    more = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return some, np.concatenate(([0], np.where(same, length + more, 0)))


def maximal_repeats(raw: np.ndarray, starts: np.ndarray, groups: np.ndarray, ends: np.ndarray, opens: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bytes, occurrences as indices into starts): every interval of common prefixes whose occurrences are not all
    preceded by the same byte. opens: starts with nothing known before them (their own, always different, neighbour)."""
    order, shared = suffix_array(raw, starts, groups, ends, length)
    before = np.where(opens, -1 - np.arange(len(starts)), raw[np.maximum(starts, 1) - 1].astype(np.int64))[order]
    some = np.flatnonzero(shared > 0)
    if not len(some):
        return
    # the suffixes in intervals of at least `length`, as blocks of neighbours
    cut = np.flatnonzero(np.diff(some) > 1)
    lows, highs = some[np.concatenate(([0], cut + 1))] - 1, some[np.concatenate((cut, [len(some) - 1]))]
    for low, high in zip(lows.tolist(), highs.tolist()):
        lengths = shared[low + 1 : high + 1].tolist()
        left = before[low : high + 1].tolist()
        stack: list[list] = []  # [common prefix, first suffix, left neighbour or None if they differ]
        for i in range(len(left)):
            here = lengths[i] if i < len(lengths) else 0
            first, one = i, left[i]
            while stack and stack[-1][0] > here:
                depth, start, side = stack.pop()
                one = side if side == one else None
                if one is None:
                    yield depth, order[low + start : low + i + 1]
                first = start
            if here:
                if stack and stack[-1][0] == here:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == one else None
                else:
                    stack.append([here, first, one])


class _Local:
    """Contexts (anchor, doc_id, first, bytes, ...) laid end to end, with the windows in them."""

    def __init__(self, rows: list[tuple], length: int):
        self.raw = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
        sizes = np.array([len(r[3]) for r in rows])
        begin = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        self.owner = np.repeat(np.arange(len(rows)), windows)
        self.offset = np.arange(len(self.owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.starts = begin[self.owner] + self.offset
        self.ends = (begin + sizes)[self.owner]
        self.groups = np.unique([r[0] for r in rows], return_inverse=True)[1][self.owner]
        self.length = length

    def maximal(self) -> Iterator[tuple[int, np.ndarray]]:
        return maximal_repeats(self.raw, self.starts, self.groups, self.ends, self.offset == 0, self.length)


def local_repeats(rows: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """(doc_id, start, end) of the repeats among contexts of whole anchors."""
    local = _Local(rows, length)
    ids = np.array([r[1] for r in rows])[local.owner]
    places = np.array([r[2] for r in rows])[local.owner] + local.offset
    reach = np.zeros(len(local.starts), dtype=np.int64)
    for size, members in local.maximal():
        if len(members) == 2:
            a, b = members
            later = members[1:] if (ids[a], places[a]) <= (ids[b], places[b]) else members[:1]
        else:
            later = np.delete(members, np.lexsort((places[members], ids[members]))[0])
        reach[later] = np.maximum(reach[later], size)
    at = np.flatnonzero(reach)
    return list(zip(ids[at].tolist(), places[at].tolist(), (places[at] + reach[at]).tolist()))


def local_groups(rows: list[tuple], length: int) -> list[tuple[int, list[tuple[tuple, int]]]]:
    """(bytes, [(context, offset in it)]) of the maximal repeats among contexts of whole anchors."""
    local = _Local(rows, length)
    out = []
    for size, members in local.maximal():
        at = {(rows[o][4], k): rows[o] for o, k in zip(local.owner[members].tolist(), local.offset[members].tolist())}
        out.append((size, [(r, k) for (_, k), r in at.items()]))
    return out


def context_bytes(docs: DataFrame, open_contexts: DataFrame, length: int) -> DataFrame:
    """anchor, doc_id, first, bytes."""
    wanted = open_contexts.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("anchor", "first", "last")).alias("runs"))
    joined = docs.join(wanted, F.col("doc_id") == F.col("id")).select("doc_id", "text", "runs.anchor", "runs.first", "runs.last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 4 << 20):
            for doc_id, text, anchor, first, last in zip(*(c.to_pylist() for c in part.columns)):
                raw = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array([doc_id] * len(anchor), pa.int64()), pa.array(first, pa.int32()), pa.array([raw[a : b + length] for a, b in zip(first, last)], pa.binary())], names=["anchor", "doc_id", "first", "bytes"])

    return joined.mapInArrow(run, "anchor bigint, doc_id bigint, first int, bytes binary")


def frequent_anchors(open_contexts: DataFrame, most: int) -> DataFrame:
    """The anchors with more than `most` contexts."""
    return written(open_contexts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most).select("anchor"), "frequent-anchors")


def window_hashes(found: DataFrame, length: int) -> DataFrame:
    """h1, h2, doc_id, start of each window of the contexts (anchor, doc_id, first, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 1 << 20):
            if not part.num_rows:
                continue
            texts = part.column(3).to_pylist()
            raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
            sizes = np.array([len(t) for t in texts])
            n = sizes - length + 1
            owner = np.repeat(np.arange(len(sizes)), n)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(sizes) - sizes)[owner] + offset
            g, half = Grams(raw), length // 2
            h1, h2 = g.of(at, at + half), g.of(at + half, at + length)
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), part.column(1).take(pa.array(owner)), pa.array((part.column(2).to_numpy()[owner] + offset).astype(np.int32))], names=["h1", "h2", "doc_id", "start"])

    return written(found.mapInArrow(run, "h1 bigint, h2 bigint, doc_id bigint, start int").distinct(), "windows")


def equal_windows(windows: DataFrame, length: int) -> DataFrame:
    """doc_id, start, end of all but the earliest of equal windows. Sums are made before the shuffle, and the join is one
    that adaptive execution can split."""
    lead = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    return windows.join(lead, ["h1", "h2"]).where(F.struct("doc_id", "start") != F.col("lead")).select("doc_id", "start", (F.col("start") + length).alias("end"))


def _by_anchor(found: DataFrame, local_bytes: int, solve: Callable[[list], pa.RecordBatch], schema: str) -> DataFrame:
    """`solve` for contexts (anchor, doc_id, first, bytes, ...) of whole anchors, as many as fit into `local_bytes`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] == held[-1][:3]:  # a row that repeats a document
                    continue
                if size >= local_bytes and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return found.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "first").mapInArrow(run, schema)


def indexed(found: DataFrame, length: int, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """doc_id, start, end of the repeats among first contexts of anchors with a bounded number of them."""

    def solve(held: list) -> pa.RecordBatch:
        rows = local_repeats(held, length)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=["doc_id", "start", "end"])

    return _by_anchor(found, local_bytes, solve, "doc_id bigint, start int, end int")


def repeat_groups(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = CONTEXTS, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """group, n_bytes, doc_id, start: every repeat of at least `length` bytes, with all its occurrences."""
    small_batches(docs.sparkSession)
    docs = docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = written(anchors(docs, length, gram, mark=False).drop("known").distinct(), "contexts")
    one = found.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "first", "last")).alias("one"), F.count("*").alias("copies"))
    several = one.groupBy("anchor").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor")
    heads = written(one.join(several, "anchor").select("anchor", "context", "one.*", "copies"), "heads")
    often = frequent_anchors(heads, most)
    few = heads.join(often, "anchor", "left_anti")
    local = context_bytes(docs, few, length).join(few.select("anchor", "doc_id", "first", "context", "copies"), ["anchor", "doc_id", "first"]).select("anchor", "doc_id", "first", "bytes", "context", "copies")

    def solve(held: list) -> pa.RecordBatch:
        rows = [r for r in held for _ in range(min(2, r[5]))]  # two stand for any number of equal ones
        out = [(r[0], serial, size, r[4], k) for serial, (size, members) in enumerate(local_groups(rows, length)) for r, k in members]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=["anchor", "serial", "n_bytes", "context", "offset"])

    members = written(_by_anchor(local, local_bytes, solve, "anchor bigint, serial bigint, n_bytes int, context bigint, offset int"), "members")
    places = members.join(found, ["anchor", "context"]).select(F.xxhash64("anchor", "serial").alias("group"), "n_bytes", "doc_id", (F.col("first") + F.col("offset")).alias("start"))
    # all windows of frequent anchors, every copy's
    spread = found.join(often, "anchor", "left_semi")
    windows = window_hashes(context_bytes(docs, spread, length), length)
    same = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    places = written(places.union(windows.join(same, ["h1", "h2"]).select(F.xxhash64("h1", "h2"), F.lit(length), "doc_id", "start")).distinct(), "places")
    # groups with the same occurrences, shifted, are parts of one repeat
    lead = places.groupBy("group", "n_bytes").agg(F.min(F.struct("doc_id", "start")).alias("lead"))
    shape = places.join(lead, ["group", "n_bytes"]).withColumn("h", F.xxhash64("doc_id", F.col("start") - F.col("lead.start")))
    shape = shape.groupBy("group", "n_bytes", F.col("lead.doc_id").alias("lead_doc"), F.col("lead.start").alias("lead_start")).agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.shiftright("h", 32)).alias("y"))
    alike = Window.partitionBy("n", "x", "y", "lead_doc").orderBy("lead_start", F.desc("n_bytes"))
    until = F.max(F.col("lead_start") + F.col("n_bytes")).over(alike.rowsBetween(Window.unboundedPreceding, -1))
    runs = shape.withColumn("fresh", F.coalesce((F.col("lead_start") > until).cast("int"), F.lit(1))).withColumn("run", F.sum("fresh").over(alike))
    whole = Window.partitionBy("n", "x", "y", "lead_doc", "run")
    runs = runs.withColumns({"from": F.min("lead_start").over(whole), "to": F.max(F.col("lead_start") + F.col("n_bytes")).over(whole), "first": F.row_number().over(whole.orderBy("lead_start", F.desc("n_bytes")))}).where("first = 1")
    return places.join(runs.select("group", "n_bytes", (F.col("to") - F.col("from")).alias("whole")), ["group", "n_bytes"]).select("group", F.col("whole").cast("int").alias("n_bytes"), "doc_id", "start")


def cut(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: one row for each row of `docs`."""
    by_doc = repeats.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    joined = docs.join(by_doc, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 4 << 20):
            rows = []
            for doc_id, text, starts, ends in zip(*(c.to_pylist() for c in part.columns)):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if not starts:
                    rows.append((doc_id, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(edge, np.minimum(starts, len(raw)), 1)
                np.add.at(edge, np.minimum(ends, len(raw)), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = CONTEXTS) -> DataFrame:
    """Cuts every repeated string of at least `length` bytes out of all but its first place."""
    small_batches(docs.sparkSession)
    docs = docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sorted_out = written(sort_out(anchors(docs, length, gram)), "repeat-runs")
    runs = sorted_out.where("anchor is null").select("doc_id", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    open_contexts = sorted_out.where("anchor is not null")
    often = frequent_anchors(open_contexts, most)
    few, spread = open_contexts.join(often, "anchor", "left_anti"), open_contexts.join(often, "anchor", "left_semi")
    more = written(indexed(context_bytes(docs, few, length), length), "repeats")
    windows = equal_windows(window_hashes(context_bytes(docs, spread, length), length), length)
    return cut(docs, runs.unionByName(more).unionByName(windows))
