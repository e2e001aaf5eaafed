"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled once per worker:

* the normaliser as a sequential transducer: from its start an arc without input puts out the dummy prefix, and then each
  character is copied and each space becomes the mark. One that also takes out superfluous spaces has a third state, in
  which a gap has been read and nothing put out yet;
* the pieces as a trie whose arcs consume characters, put out an id at a piece's end and lead back to the root, with byte
  fallback for characters that no piece holds;
* their composition: where the normaliser puts out one character for each one read, each arc of the trie gets the
  characters that the normaliser maps to its own, and texts are read as they are. Otherwise a text is composed with the
  normaliser first;
* for BPE models an acceptor of neighbouring pieces, since no weight of a piece alone can express merging by rank: an arc
  weighs 0 where merging the two neighbours' characters by rank gives these two pieces again, else infinity. A
  segmentation is the one that merging produces exactly if all its neighbours pass, so the only path of finite weight is
  the BPE encoding. In unigram models an arc weighs minus its piece's score.

The composition with an input is never built whole: the shortest path in the tropical semiring (min, +) is searched from
state to state, in one way for both kinds of model. The queue of states is a heap in unigram models; in BPE models, whose
finite weights are all 0, it has one bucket and is a stack. Where no piece crosses a boundary (before a white-space mark, or
between two characters that no piece holds side by side; both read off the pieces) paths pass through one state, so the
parts are solved by themselves and remembered, in a memory of bounded size.

Decoding joins the pieces, turns marks into spaces, byte pieces into bytes, and drops the dummy prefix.

Defined cases: a null or empty text has no pieces and decodes to ""; a text may hold the mark character itself, which
comes back as a space (`exact` is false then); a null or repeated doc_id is just another row; further columns are left
out, and an empty table gives none. Models with a character map are refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
GAPS = " " + MARK  # what stands between words of a text, or of what the normaliser has put out
REMEMBERED = 300_000  # parts a worker keeps, of at most 48 characters
WEIGHTS = 1_000_000  # of arcs that a worker keeps

_INF = float("inf")
_CUT = "\x1f"  # stands between parts in the quick cut; texts that hold it are cut by the pattern


class Normaliser:
    """A sequential transducer: `arcs[state][character]` is what is put out and the next state; ANY stands for all
    characters without an arc of their own, each of which follows what is put out, and NONE for an arc without input."""

    START, TEXT, GAP = 0, 1, 2
    ANY, NONE = "any", ""

    def __init__(self, prefix: bool, collapse: bool):
        start, text, gap, mark = self.START, self.TEXT, self.GAP, MARK if prefix else ""
        if collapse:  # one mark for a gap, none at the ends
            self.arcs = {start: {" ": ("", start), self.ANY: (mark, text)}, text: {" ": ("", gap), self.ANY: ("", text)}, gap: {" ": ("", gap), self.ANY: (MARK, text)}}
        else:
            self.arcs = {start: {self.NONE: (mark, text)}, text: {" ": (MARK, text), self.ANY: ("", text)}}
        #: One character is put out for each one read, in one state: the arcs compose with others one by one.
        self.letterwise = not collapse
        self.prefix = self.arcs[start].get(self.NONE, ("", start))[0]

    def image(self, c: str) -> str:
        """What stands for a character within a text."""
        out, _ = self.arcs[self.TEXT].get(c, (c, 0))
        return out

    def preimage(self, c: str) -> list[str]:
        """The characters within a text that `c` can stand for."""
        return [x for x in sorted({c, *self.arcs[self.TEXT]} - {self.ANY}) if self.image(x) == c]

    def compose(self, text: str) -> str:
        """What the path that reads the text puts out."""
        if not text:
            return ""
        out, state, arcs = [], self.START, self.arcs
        if self.NONE in arcs[state]:
            put, state = arcs[state][self.NONE]
            out.append(put)
        for c in text:
            arc = arcs[state].get(c)
            if arc is None:
                put, state = arcs[state][self.ANY]
                out += (put, c)
            else:
                put, state = arc
                out.append(put)
        return "".join(out)


class Transducer:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap:
            raise ValueError("only models with the identity character map are compiled")
        self.bpe = proto.trainer_spec.model_type == 2
        self.prefix, self.normaliser = spec.add_dummy_prefix, Normaliser(spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        kinds = type(proto.pieces[0]) if proto.pieces else None
        self.pieces: dict[str, int] = {}
        self.score: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_id: dict[int, int] = {}
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            self.score.append(p.score)
            out = p.piece.replace(MARK, " ").encode()
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value] = i
                out = bytes([value])
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.pieces[p.piece] = i
            else:
                if p.type == kinds.UNKNOWN:
                    self.unknown = i
                out = b" \xe2\x81\x87 " if p.type == kinds.UNKNOWN else b""
            self.bytes_of.append(out)
        self.sizes = np.array([len(x) for x in self.bytes_of], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.text_of = {i: p for p, i in self.pieces.items()}
        self.weights: dict[tuple[int, int], float] = {}
        self.spine: dict[int, tuple[list, list]] = {}
        # the trie: a node has its arcs by character, and by "" the piece that ends there
        self.trie: dict = {}
        usable = {p: i for p, i in self.pieces.items() if not self.bpe or self.spines(i)[0]}  # what merging can give
        for piece, i in usable.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        preimage = {c: self.normaliser.preimage(c) for p in usable for c in p} if self.normaliser.letterwise else {}
        self.compose(self.trie, preimage)
        self.worst = 0.0 if self.bpe else 10.0 - min(self.score)  # of byte fallback
        self.alphabet = {c for p in self.pieces for c in p}
        #: Neighbouring characters of a text that some piece holds side by side.
        self.pairs = {x + y for a, b in {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)} for x in preimage.get(a, a) for y in preimage.get(b, b)}
        self.falls_apart = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        edges = "".join(re.escape(c) for c in "\n\t\r" if c not in self.alphabet)
        #: One part: marks and what follows up to the next mark, or characters that no piece holds.
        self.part = re.compile(f"[{edges}]+|[{GAPS}]*[^{GAPS}{edges}]+|[{GAPS}]+" if edges else f"[{GAPS}]*[^{GAPS}]+|[{GAPS}]+")
        self.known: dict[str, bytes] = {}

    def compose(self, trie: dict, preimage: dict[str, list[str]]) -> None:
        """The trie composed with the normaliser: an arc is taken by all characters that the normaliser maps to its own."""
        ahead = [trie]
        while ahead:
            node = ahead.pop()
            for c, onward in [(c, x) for c, x in node.items() if c]:
                ahead.append(onward)
                if preimage.get(c, [c]) != [c]:
                    del node[c]
                    node |= dict.fromkeys(preimage[c], onward)

    # BPE: which neighbours merging leaves apart
    def merged(self, text: str) -> list[str]:
        symbols = list(text)
        while len(symbols) > 1:
            best, at = -_INF, -1
            for i in range(len(symbols) - 1):
                found = self.pieces.get(symbols[i] + symbols[i + 1])
                if found is not None and self.score[found] > best:
                    best, at = self.score[found], i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def spines(self, piece: int) -> tuple[list, list]:
        """The symbols that stand at the left and right edge of a piece while its characters merge, with the scores
        of the merges that bring them; empty for a piece that merging never gives."""
        found = self.spine.get(piece)
        if found is None:
            text = self.text_of[piece]
            symbols, left, right = list(text), [(text[0], _INF)], [(text[-1], _INF)]
            while len(symbols) > 1:
                best, at = -_INF, -1
                for i in range(len(symbols) - 1):
                    merged = self.pieces.get(symbols[i] + symbols[i + 1])
                    if merged is not None and self.score[merged] > best:
                        best, at = self.score[merged], i
                if at < 0:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                if at == 0:
                    left.append((symbols[0], best))
                if at == len(symbols) - 1:
                    right.append((symbols[-1], best))
            found = self.spine[piece] = (left, right) if len(symbols) == 1 else ([], [])
        return found

    def stays(self, left: int, right: int) -> bool:
        """Merging leaves these two neighbours as they are: no merge across comes before the edges' own ones."""
        if MARK * 2 in self.text_of[left] + self.text_of[right]:  # pieces of marks share one score: by merging itself
            return self.merged(self.text_of[left] + self.text_of[right]) == [self.text_of[left], self.text_of[right]]
        a, b = self.spines(left)[1], self.spines(right)[0]
        i = j = 0
        while True:
            next_a = a[i + 1][1] if i + 1 < len(a) else -_INF
            next_b = b[j + 1][1] if j + 1 < len(b) else -_INF
            across = self.pieces.get(a[i][0] + b[j][0])
            if across is not None and self.score[across] > next_a and self.score[across] >= next_b:
                return False
            if next_a == next_b == -_INF:
                return True
            if next_a >= next_b:
                i += 1
            else:
                j += 1

    def fallback(self, c: str) -> list[int]:
        raw = (self.normaliser.image(c) if self.normaliser.letterwise else c).encode("utf-8", "surrogatepass")
        return [self.byte_id[b] for b in raw] if all(b in self.byte_id for b in raw) else [self.unknown]

    def weight(self, last: int, piece: int) -> float:
        """Of the arc that puts out `piece` after `last` (-1: at the start, -2: after byte fallback)."""
        found = -self.score[piece] if not self.bpe else 0.0 if last < 0 or self.stays(last, piece) else _INF
        if len(self.weights) >= WEIGHTS:
            self.weights.clear()
        if self.bpe:
            self.weights[last, piece] = found
        return found

    def shortest_path(self, text: str) -> list[int]:
        """Ids on the shortest path through the composition of `text` with the pieces, in the tropical semiring.

        A state is a position and the piece that leads there. States of one position differ in nothing but their weight
        in a unigram model, and in a BPE model all but one of them are infinitely far, as the start of a text has one
        encoding; so one state a position is enough. No arc weighs less than nothing, so states are taken by weight and a
        position's first state is its nearest; in a BPE model all finite weights are equal, and the longest arc of the
        newest state is taken first. Of equally short paths the last piece is the longer one. Weights are worked out when
        an arc is taken.
        """
        trie, weight, known, bpe, n = self.trie, self.weight, self.weights, self.bpe, len(text)
        ahead: list[tuple[float, int, int, int, int]] = []  # weight, end, start, piece, piece before
        way: dict[int, tuple[int, int]] = {}
        here, at, last, start = 0.0, 0, -1, 0
        while True:
            way[at] = last, start
            if at == n:
                break
            node, end, single = trie, at, False
            while end < n:
                node = node.get(text[end])
                if node is None:
                    break
                end += 1
                piece = node.get("")
                if piece is not None:
                    single |= end == at + 1
                    if bpe:
                        ahead.append((here, end, at, piece, last))
                    else:
                        heappush(ahead, (here + weight(last, piece), end, at, piece, last))
            if not single:  # byte fallback
                if bpe:
                    ahead.append((here, at + 1, at, -2, last))
                else:
                    heappush(ahead, (here + self.worst, at + 1, at, -2, last))
            while True:  # the next state that hasn't been reached
                here, at, start, piece, last = ahead.pop() if bpe else heappop(ahead)
                if at in way:
                    continue
                if bpe and piece >= 0 and last >= 0:
                    step = known.get((last, piece))
                    if (weight(last, piece) if step is None else step) == _INF:
                        continue
                last = piece
                break
        ids: list[int] = []
        end = n
        while end > 0:
            piece, start = way[end]
            ids += [piece] if piece >= 0 else self.fallback(text[start])[::-1]
            end = start
        return ids[::-1]

    def solved(self, part: str) -> bytes:
        """The ids of a part, which falls into smaller ones where no piece holds both of two neighbouring characters."""
        pairs = self.pairs
        inner = [] if part.lstrip(GAPS).isalpha() else [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in pairs]
        cuts = [0, *inner, len(part)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            small = part[a:b]
            ids = self.known.get(small) if b - a < len(part) else None
            if ids is None:
                ids = array("i", self.shortest_path(small)).tobytes()
                self.remember(small, ids)
            out.append(ids)
        ids = b"".join(out)
        self.remember(part, ids)
        return ids

    def remember(self, part: str, ids: bytes) -> None:
        if len(part) <= 48:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[part] = ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.normaliser.letterwise:  # the dummy prefix is read as what stands for it
            text = " " + text if self.normaliser.prefix else text
        else:
            text = self.normaliser.compose(text)
        if not self.falls_apart:
            parts = [text]
        elif MARK in text or "  " in text or _CUT in text or "\n" in self.alphabet:
            parts = self.part.findall(text)
        else:  # the same parts, cut by the built-in split: one space before each word, each line's end by itself
            parts = text.replace(" ", _CUT + " ").replace("\n", _CUT + "\n" + _CUT).split(_CUT)
        found = list(map(self.known.get, parts))
        try:
            return b"".join(found)
        except TypeError:  # a part that isn't known yet
            solved, known = self.solved, self.known
            return b"".join([ids if ids is not None else known.get(part) or solved(part) for part, ids in zip(parts, found)])

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes that the pieces stand for, without the dummy prefix."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes)
        at += np.arange(len(at), dtype=at.dtype)
        raw = self.blob[at].tobytes()
        return raw[1:] if self.prefix and raw.startswith(b" ") else raw

    def decode(self, ids: list[int]) -> str:
        return self.decoded(np.array(ids, dtype=np.int64)).decode("utf-8", "replace")


def read_model(spark, path: str = MODEL) -> bytes:
    """The model file's bytes: a local file of the driver, or one in any store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


_compiled: dict[int, Transducer] = {}


def transducer(model: bytes) -> Transducer:
    """Compiled once per worker process."""
    key = hash(model)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(model)
    return _compiled[key]


def encode_decode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids, exact (decoding the ids gives the text again): one row for each row of `docs`."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for part in text_batches(batches, 4 << 20):
            raw, exact = [], []
            for x in part.column(1).to_pylist():
                ids = t.encode(x)
                raw.append(ids)
                exact.append(t.decoded(np.frombuffer(ids, dtype="<i4")) == (x or "").encode("utf-8", "surrogatepass"))
            sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), ids, pa.array(exact, pa.bool_())], names=["doc_id", "n_pieces", "ids", "exact"])

    return docs.select(whole_id("doc_id").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_pieces bigint, ids array<int>, exact boolean")
