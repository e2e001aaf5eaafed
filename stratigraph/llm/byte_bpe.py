"""Byte-level BPE encoding and decoding by two-tier lookup.

A text is cut into pre-tokens, and each of them is encoded by itself:

* first tier: a minimal perfect hash over the vocabulary (hash and displace, as many slots as tokens). One lookup gives
  the only slot where a pre-token can be; its hash and then its bytes are compared, so a hit is certain. All pre-tokens
  of a slice of texts are hashed and looked up together;
* second tier, for pre-tokens that are not in the vocabulary: their bytes are a linked list, a heap holds the ranks of
  neighbours, and the lowest rank (the leftmost of equal ones) is merged until none is left. Results of short pre-tokens
  are remembered, in a memory of bounded size.

Pre-tokens are the matches of `PATTERN`, found for a whole slice at once from the classes of neighbouring characters
(letter, number, space, other white space, rest); another pattern is matched as such. Long texts are cut before white
space that follows something else, where a pre-token begins in any case, so memory doesn't grow with a text (it does
with a single pre-token: some hundred bytes for each of its bytes).

Defined cases: a null or empty text has no ids and decodes to nothing; strings of special tokens are ordinary text; a
null or repeated doc_id is just another row; further columns are left out; an empty table gives none; an id that the
vocabulary doesn't have is an error when decoding.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id
from .hashing import mixed, span_hashes, spread, utf8_column

#: Fixed value: the pattern of the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SLICE = 1 << 20  # bytes of text that are worked on together
REMEMBERED = 400_000  # pre-tokens of one of the memory's two generations, of at most 48 bytes

_REST, _LETTER, _NUMBER, _SPACE, _WHITE, _END = range(6)


class PerfectHash:
    """A minimal perfect hash of byte strings: slot(hashes) is one to one on the strings' hashes."""

    def __init__(self, strings: list[bytes]):
        self.size = len(strings)
        sizes = np.array([len(s) for s in strings], np.int64)
        blob = np.frombuffer(b"".join(strings), np.uint8)
        starts = np.cumsum(sizes) - sizes
        hashes = span_hashes(blob, starts, starts + sizes)
        if len(np.unique(hashes)) < self.size:
            raise ValueError("two strings of the vocabulary have one hash")
        self.shift = np.zeros(self.size // 4 + 1, np.int64)
        taken = np.zeros(self.size, bool)
        bucket = (hashes % np.uint64(len(self.shift))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        count = np.bincount(bucket, minlength=len(self.shift))
        first = np.cumsum(count) - count
        for b in np.argsort(-count, kind="stable"):
            if count[b] < 2:
                break
            own, tried = hashes[order[first[b] : first[b] + count[b]]], 0
            while not self.shift[b]:
                shifts = np.arange(tried + 1, tried + 129, dtype=np.int64)
                places = self._place(own[None, :], shifts[:, None])
                free = ~taken[places].any(axis=1)
                for i in np.flatnonzero(free):
                    if len(set(places[i].tolist())) == count[b]:
                        self.shift[b] = shifts[i]
                        taken[places[i]] = True
                        break
                tried += 128
        alone, free = np.flatnonzero(count == 1), np.flatnonzero(~taken)
        self.shift[alone] = -1 - free[: len(alone)]  # the place itself
        slots = self.slot(hashes)
        self.string_of = np.empty(self.size, np.int64)  # the string's number, by slot
        self.string_of[slots] = np.arange(self.size)
        self.hash_of, self.size_of, self.start_of, self.blob = hashes[self.string_of], sizes[self.string_of], starts[self.string_of], blob

    def _place(self, hashes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        return (mixed(hashes ^ (shifts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(self.size)).astype(np.int64)

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % np.uint64(len(self.shift))).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._place(hashes, shift))

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of the string that each span of `raw` is, or -1."""
        hashes, sizes = span_hashes(raw, starts, ends), ends - starts
        slot = self.slot(hashes)
        like = np.flatnonzero((self.hash_of[slot] == hashes) & (self.size_of[slot] == sizes))
        size = sizes[like]
        differ = raw[spread(starts[like], size)] != self.blob[spread(self.start_of[slot[like]], size)]
        if differ.any():
            like = like[np.bincount(np.repeat(np.arange(len(like)), size), differ, len(like)) == 0]
        found = np.full(len(starts), -1, np.int64)
        found[like] = self.string_of[slot[like]]
        return found


def _classes() -> np.ndarray:
    """The class of every code point."""
    classes = np.zeros(0x110000, np.uint8)
    points = np.concatenate((np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")))
    every = points.tobytes().decode("utf-32-le")
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            classes[points[m.start() : m.end()]] = kind
    classes[0x20] = _SPACE
    return classes


class Vocabulary:
    def __init__(self, rank_file: bytes, pattern: str = PATTERN):
        pairs = [line.split() for line in rank_file.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        self.ids = np.array(list(self.ranks.values()), np.int64)
        self.tokens = tokens
        by_id = dict(zip(self.ranks.values(), tokens))
        table = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts, self.blob = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(table), np.uint8)
        self.pattern = None if pattern == PATTERN else regex.compile(pattern)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @cached_property
    def perfect(self) -> PerfectHash:
        return PerfectHash(self.tokens)

    @cached_property
    def classes(self) -> np.ndarray:
        return _classes()

    @cached_property
    def pairs(self) -> list[int | None]:
        """The rank of each pair of bytes."""
        found = [None] * 65536
        for token, rank in self.ranks.items():
            if len(token) == 2:
                found[token[0] << 8 | token[1]] = rank
        return found

    @cached_property
    def single(self) -> list[int]:
        """The id of each byte."""
        return [self.ranks[bytes([b])] for b in range(256)]

    def pre_tokens(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The first byte of each pre-token of the texts raw[bounds[i]:bounds[i + 1]]."""
        if self.pattern is not None:
            spans = [(a, m) for a, b in zip(bounds, bounds[1:]) for m in self.pattern.finditer(raw[a:b].tobytes().decode())]
            if sum(len(m[0].encode()) for _, m in spans) != len(raw):
                raise ValueError("the pattern has to match every character")
            sizes = np.array([len(m[0].encode()) for _, m in spans], np.int64)
            return np.cumsum(sizes) - sizes
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
        lead = np.arange(len(raw)) if len(codes) == len(raw) else np.flatnonzero((raw & 0xC0) != 0x80)
        kind = self.classes[codes]
        firsts = np.searchsorted(lead, np.unique(bounds[:-1][np.diff(bounds) > 0]))
        before = np.concatenate(([_END], kind[:-1])).astype(np.uint8)
        before[firsts] = _END
        after = np.concatenate((kind[1:], [_END])).astype(np.uint8)
        after[firsts[1:] - 1] = _END
        white, white_before = (kind == _SPACE) | (kind == _WHITE), (before == _SPACE) | (before == _WHITE)
        begins = np.where(white, ~white_before | (after < _SPACE), (before == _WHITE) | (before == _END) | (~white_before & (before != kind)))
        quote = np.flatnonzero((codes == 0x27) & begins)
        if len(quote):  # 's, 't, 'm, 'd, 're, 've, 'll are tokens of their own
            ends = np.concatenate((firsts[1:], [len(codes)]))[np.searchsorted(firsts, quote, "right") - 1]
            padded = np.concatenate((codes, [0, 0]))
            one, two = padded[quote + 1], padded[quote + 2]
            short = (quote + 1 < ends) & np.isin(one, [ord(c) for c in "stmd"])
            long = (quote + 2 < ends) & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
            begins[quote[short | long] + 1] = False
            next_one = np.concatenate((quote[short] + 2, quote[long] + 3))
            begins[next_one[next_one < len(codes)]] = True
        return lead[begins]

    def merged(self, token: bytes) -> bytes:
        """The ids of a pre-token by merging, as little-endian 32-bit integers."""
        n, get, pairs = len(token), self.ranks.get, self.pairs
        kept = list if n < 4096 else lambda x: array("q", x)
        ids, after, before = kept(map(self.single.__getitem__, token)), kept(range(1, n + 1)), kept(range(-1, n - 1))
        bits = n.bit_length()  # an entry of the heap is rank, left node and end of its right neighbour in one number
        mask, high = (1 << bits) - 1, 2 * bits
        heap = [rank << high | i << bits | i + 2 for i, pair in enumerate(zip(token, token[1:])) if (rank := pairs[pair[0] << 8 | pair[1]]) is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            left, end = entry >> bits & mask, entry & mask
            right = after[left]
            if not 0 < right < end or after[right] != end:
                continue  # one of the two has been merged with something else
            ids[left] = entry >> high
            after[left], after[right] = end, -1
            if end < n:
                before[end] = left
                if (rank := get(token[left : after[end]])) is not None:
                    heappush(heap, rank << high | left << bits | after[end])
            if (first := before[left]) >= 0 and (rank := get(token[first:end])) is not None:
                heappush(heap, rank << high | first << bits | end)
        out, at = array("I"), 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out.tobytes()

    def second_tier(self, token: bytes) -> bytes:
        ids = self.young.get(token)
        if ids is None:
            ids = self.old.get(token)
            if ids is None:
                ids = self.merged(token)
            if len(token) <= 48:
                if len(self.young) >= REMEMBERED:
                    self.young, self.old = {}, self.young
                self.young[token] = ids
        return ids

    def encode_slice(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(bounds) - 1, np.int64)
        starts = self.pre_tokens(raw, bounds)
        ends = np.concatenate((starts[1:], [len(raw)]))
        found = self.perfect.find(raw, starts, ends)
        missed = np.flatnonzero(found < 0)
        text, second, young = raw.tobytes(), self.second_tier, self.young.get
        merged = [young(t) or second(t) for a, b in zip(starts[missed].tolist(), ends[missed].tolist()) if (t := text[a:b])]
        sizes = np.ones(len(starts), np.int64)
        sizes[missed] = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
        places = np.cumsum(sizes) - sizes
        ids = np.empty(int(sizes.sum()), "<u4")
        hit = found >= 0
        ids[places[hit]] = self.ids[found[hit]]
        ids[spread(places[missed], sizes[missed])] = np.frombuffer(b"".join(merged), "<u4")
        token_bounds = np.concatenate((places, [len(ids)]))[np.searchsorted(starts, bounds)]
        return ids, np.diff(token_bounds)

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode_slice, with a text longer than a slice in parts."""
        if len(bounds) > 2 or len(raw) <= SLICE:
            return self.encode_slice(raw, bounds)
        parts, at = [], 0
        while at < len(raw):
            end = _cut(raw, at + SLICE)
            parts.append(self.encode_slice(raw[at:end], np.array([0, end - at]))[0])
            at = end
        ids = np.concatenate(parts)
        return ids, np.array([len(ids)])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' bytes, one after the other, and how many each token has."""
        if len(ids) and int(ids.max()) >= len(self.sizes):
            raise ValueError(f"the vocabulary has no id {ids.max()}")
        sizes = self.sizes[ids]
        return self.blob[spread(self.starts[ids], sizes)], sizes


def _cut(raw: np.ndarray, at: int) -> int:
    """The first place from `at` on where white space follows a visible ASCII character, or the end."""
    while at < len(raw):
        part = raw[at - 1 : at + 65536]
        found = np.flatnonzero(((part[1:] == 0x20) | (part[1:] == 0x0A)) & (part[:-1] > 0x20) & (part[:-1] < 0x7F))
        if len(found):
            return at + int(found[0])
        at += 65536
    return len(raw)


def read_ranks(spark, path: str = RANKS) -> bytes:
    """The rank file's bytes: a local file of the driver, or one in any store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


_compiled: dict[tuple[int, str], Vocabulary] = {}


def vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    """Compiled once per worker process."""
    key = (hash(rank_file), pattern)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Vocabulary(rank_file, pattern)
    return _compiled[key]


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def encode(docs: DataFrame, rank_file: bytes, text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers): one row for each row of `docs`."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(rank_file, pattern)
        for part in text_batches(batches, SLICE):
            ids, counts = v.encode(*utf8_column(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), _binary(ids, counts * 4)], names=["doc_id", "n_tokens", "ids"])

    return docs.select(whole_id("doc_id").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, rank_file: bytes, pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (the tokens' bytes joined) of what `encode` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(rank_file, pattern)
        for part in text_batches(batches, SLICE):
            raw, bounds = utf8_column(part.column(2))
            decoded, sizes = v.decode(np.frombuffer(raw.tobytes(), "<u4"))
            ends = np.concatenate(([0], np.cumsum(sizes)))[bounds // 4]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), _binary(decoded, np.diff(ends))], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
