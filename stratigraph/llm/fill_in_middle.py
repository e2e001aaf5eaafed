"""Fill-in-middle transformation with cuts found on a wavelet matrix over character classes.

A text is a row of units: runs of ASCII letters and single other characters ("token"), lines ("line") or characters
("char"). A document is cut after two numbers of units drawn from its id into prefix, middle and suffix, which are put in
prefix-suffix-middle or suffix-prefix-middle order between sentinels; some documents stay plain.

The classes of the characters (inner letter, last letter of a run, line feed, rest) are two bits each, held in a wavelet
matrix over a slice of texts: per level one bit vector, with its ones summed by block. The number of units that end among
the first p characters is the sum of the ranks of the classes that end a unit; bisection on these ranks finds where the
k-th unit ends, for all documents of a slice in one go. A unit that the end of the text closes (a last line) has no
character of a closing class after it and is counted apart.

Defined cases: a null or empty text is plain with no units; a text that holds a sentinel is plain; a null doc_id draws
as the empty string; repeated rows get equal results; further columns are left out; an empty table gives none. A text is
worked on whole, with a few bytes for each of its characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches, whole_id
from .hashing import utf8_column

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
SLICE = 1 << 20  # bytes of text that share a wavelet matrix

INNER, LAST, LINE, REST = range(4)
#: The classes whose characters end a unit.
ENDS = {"token": (LAST, LINE, REST), "line": (LINE,), "char": (INNER, LAST, LINE, REST)}
_BLOCK = 256


class WaveletMatrix:
    """rank(c, p): how many of the first p symbols are c, for arrays of p."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.levels, self.zeros = len(symbols), [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.packbits(np.concatenate((bit, np.zeros(-len(bit) % _BLOCK + _BLOCK, bool))))
            ones = np.bitwise_count(packed).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
            self.levels.append((packed, np.concatenate(([0], np.cumsum(ones)))))
            self.zeros.append(len(bit) - int(ones.sum()))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    @staticmethod
    def _ones(level: tuple[np.ndarray, np.ndarray], p: np.ndarray) -> np.ndarray:
        """Ones among the first p bits: those of whole blocks, and of the block in which p stands."""
        packed, before = level
        block, rest = p // _BLOCK, p % _BLOCK
        own = np.unpackbits(packed[(block * (_BLOCK // 8))[:, None] + np.arange(_BLOCK // 8)], axis=1)
        return before[block] + (own * (np.arange(_BLOCK) < rest[:, None])).sum(axis=1, dtype=np.int64)

    def rank(self, symbol: int, p: np.ndarray) -> np.ndarray:
        """The symbol's own stretch of the last level is narrowed level by level."""
        first = np.zeros_like(p)
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one_first, one_p = self._ones(level, first), self._ones(level, p)
            if symbol >> (len(self.levels) - 1 - i) & 1:
                first, p = zeros + one_first, zeros + one_p
            else:
                first, p = first - one_first, p - one_p
        return p - first


class Units:
    """The units of the texts raw[bounds[i]:bounds[i + 1]] (UTF-8); places are in characters of the whole slice."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, unit: str = "token"):
        lead = raw[(raw & 0xC0) != 0x80]  # one byte for each character; only ASCII ones have a class of their own
        before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        self.first, self.end = before[bounds[:-1]], before[bounds[1:]]
        lower = lead | 0x20
        letter = (lower >= 0x61) & (lower <= 0x7A)
        more = np.concatenate((letter[1:], [False]))  # a letter of the same text follows
        more[self.end[self.end > self.first] - 1] = False
        symbols = np.where(letter, np.where(more, INNER, LAST), np.where(lead == 0x0A, LINE, REST)).astype(np.uint8)
        self.matrix, self.ends = WaveletMatrix(symbols, 2), ENDS[unit]
        self.base = self.ended(self.first)
        closed = self.ended(self.end) - self.base
        last = symbols[np.maximum(self.end - 1, 0)] if len(symbols) else np.zeros(len(self.end), np.uint8)
        self.open = (self.end > self.first) & ~np.isin(last, self.ends)
        self.count = closed + self.open

    def ended(self, p: np.ndarray) -> np.ndarray:
        """The number of units that end among the first p characters."""
        return sum(self.matrix.rank(c, p) for c in self.ends)

    def after(self, units: np.ndarray) -> np.ndarray:
        """The characters that the first `units` units of each text hold."""
        low, high = self.first.copy(), self.end.copy()
        wanted = self.base + units
        while (go := low < high).any():
            middle = (low + high) // 2
            enough = np.zeros(len(low), bool)
            enough[go] = self.ended(middle[go]) >= wanted[go]
            high = np.where(go & enough, middle, high)
            low = np.where(go & ~enough, middle + 1, low)
        return low - self.first


def _draws(doc_id: Column, seed: str) -> list[Column]:
    """Four whole numbers from the SHA-256 of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "token", seed: str = "1", plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output: one row for each row of `docs`."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, SLICE):
            units = Units(*utf8_column(part.column(1)), unit)
            one, two = (part.column(c).to_numpy() % (units.count + 1) for c in (2, 3))
            plain = part.column(4).to_numpy(zero_copy_only=False) | (units.count == 0)
            first, second = (units.after(np.where(plain, 0, f(one, two))) for f in (np.minimum, np.maximum))
            prefixes, middles, forms, outputs = [], [], [], []
            for text, stays, swapped, a, b in zip(part.column(1).to_pylist(), plain.tolist(), part.column(5).to_pylist(), first.tolist(), second.tolist()):
                forms.append("plain" if stays else "spm" if swapped else "psm")
                prefixes.append(None if stays else a)
                middles.append(None if stays else b - a)
                if stays:
                    outputs.append(text or "")
                elif swapped:
                    outputs.append(f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}")
                else:
                    outputs.append(f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}")
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(units.count), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    doc_id, text = whole_id("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2, h3, h4 = _draws(doc_id, seed)
    plain = (h3 % 100 >= plain_from) | (F.greatest(*[F.locate(s, text) for s in (PREFIX, SUFFIX, MIDDLE)]) > 0)
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"), plain.alias("plain"), (h4 % 100 < spm_below).alias("swapped"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone. The parts hold no sentinel, and none arises where two of them meet."""
    parts = F.split(output, "<[PSM]>", -1)
    order = F.when(form == "psm", F.array(F.lit(1), F.lit(3), F.lit(2))).otherwise(F.array(F.lit(2), F.lit(3), F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(*[F.get(parts, F.get(order, i)) for i in range(3)]))
