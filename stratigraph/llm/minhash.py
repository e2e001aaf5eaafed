"""MinHash near-duplicate detection with tensored banding.

A document is the set of its distinct word shingles (64-bit hashes). Instead of hashing for every table anew, two small
collections of `halves` sub-signatures of `half_rows` min-hashes each are computed; the key of table (i, j) combines
sub-signature i of the first with j of the second, so halves**2 tables cost 2 * halves * half_rows min-hashes.

1. Documents with the same set form a class; only one row of it goes on, so copies are never paired.
2. Every bucket of every table is a star: each member is paired with the bucket's first class. The pairs pass a sound
   bound on 16-bit prints of the sets, are confirmed on full sets, and connected components are taken.
3. What stars cannot see: members of one bucket in different components. Per bucket, these are dealt out in blocks (a
   large bucket by bands of set size first, as sets that differ too much in size can't be linked) and each pair of blocks
   is compared across components by the same bound and then confirmed on full sets, so a link is lost only where all
   tables miss it (below 0.1 % at a similarity of exactly 0.8, far less above).

Buckets are counted before they are joined (sums before the shuffle), and joins on bucket, class or centre keys are ones
that adaptive execution can split. No group is gathered in one task. Texts are joined only to pairs that pass the bound.

Defined cases: null, empty or wordless texts have an empty set, link with nothing and stand for themselves; fewer words
than a shingle make one shingle of all; rows that repeat a doc_id are one document, linked with whatever one of its
texts is linked with, and each comes out; rows with a null doc_id come out with a null component and are not kept apart
or linked; further columns are left out, and an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, small_batches, text_batches, whole_id, written
from .components import connected_components

SHINGLE = 5
SIMILARITY = 80  # percent
HALVES = 8
HALF_ROWS = 2
BLOCK = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    return x ^ (x >> _SHIFT)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of word shingles; words are runs of anything but [\\x20\\x09-\\x0D], A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - size + 1)
    out = h[:n].copy() if len(h) >= size else h[:1].copy()
    for k in range(1, min(size, len(h))):
        out = _mixed(out * _MIX + h[k : k + n])
    if len(h) < size:
        out = _mixed(out + np.uint64(len(h)))
    return np.unique(out)


class Sketch:
    """Seeds of the min-hashes, and what is taken from a set."""

    def __init__(self, halves: int, half_rows: int, seed: int = 1):
        self.halves, self.half_rows = halves, half_rows
        rng = np.random.default_rng(seed)
        n = 2 * halves * half_rows
        self.xor = rng.integers(0, 2**63, n, dtype=np.uint64)
        self.factor = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.xor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for start in range(0, len(shingles), 8192):  # a very long text doesn't fill the memory
            part = shingles[start : start + 8192]
            least = np.minimum(least, ((part[None, :] ^ self.xor[:, None]) * self.factor[:, None]).min(axis=1))
        return least

    def halves_of(self, minima: np.ndarray) -> np.ndarray:
        """2 * halves sub-signatures: first the one collection, then the other."""
        rows = minima.reshape(2 * self.halves, self.half_rows)
        out = rows[:, 0].copy()
        for k in range(1, self.half_rows):
            out = _mixed(out * _MIX + rows[:, k])
        return _mixed(out)


def sketches(docs: DataFrame, shingle: int, sketch: Sketch) -> DataFrame:
    """doc_id, row_key (of the text), n_shingles, d1, d2 (digest of the set), halves (sub-signatures)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 8 << 20):
            sizes, digests, halves = [], [], []
            for text in part.column(2).to_pylist():
                shingles = shingle_set(text, shingle)
                sizes.append(len(shingles))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype=np.int64))
                halves.append(sketch.halves_of(sketch.minima(shingles)).view(np.int64) if len(shingles) else None)
            d = np.array(digests).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(halves, pa.list_(pa.int64()))], names=["doc_id", "row_key", "n_shingles", "d1", "d2", "halves"])

    return docs.select("doc_id", "row_key", "text").mapInArrow(run, "doc_id bigint, row_key bigint, n_shingles bigint, d1 bigint, d2 bigint, halves array<bigint>")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def prints_of(shingles: np.ndarray) -> bytes:
    """The distinct 16-bit hashes of a set, sorted."""
    return np.unique((shingles >> np.uint64(48)).astype(np.uint16)).tobytes()


def bounded(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be linked: shingles that share a print with another of their set count as shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 8 << 20):
            keep = []
            for n, m, x, y in zip(*(part.column(k).to_pylist() for k in (2, 3, 4, 5))):
                if 100 * min(n, m) < percent * max(n, m):
                    keep.append(False)
                    continue
                x, y = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum()) + min(n - len(x), m - len(y))
                keep.append(100 * both >= percent * (n + m - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])

    left, right = (texts.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("prints").alias(f"prints_{x}")) for x in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "prints_a", "prints_b").mapInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for part in text_batches(batches, 8 << 20):
            keep = []
            for b, text_a, text_b in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                if b != last:  # rows come sorted or in runs by b
                    last, last_set = b, shingle_set(text_b, shingle)
                keep.append(linked(shingle_set(text_a, shingle), last_set, percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])

    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def bucket_rows(reps: DataFrame, halves: int) -> DataFrame:
    """rep and its key in each table, i and j the table's place."""
    one = reps.select("rep", "halves", F.posexplode(F.slice("halves", 1, halves)).alias("i", "first"))
    two = one.select("rep", "i", "first", F.posexplode(F.slice("halves", halves + 1, halves)).alias("j", "second"))
    return two.select("rep", F.col("i").cast("tinyint").alias("i"), F.col("j").cast("tinyint").alias("j"), F.xxhash64("i", "j", "first", "second").alias("key"))


def dealt(contested: DataFrame, percent: int, block: int) -> DataFrame:
    """Rows of `contested` (key, size, rep, n, ...) once for each pair of cells of their bucket that they belong to: low
    and high name the two cells, own the row's. A bucket of up to `block` rows is one cell; the rows of a larger one are
    cut by bands of set size, at most the next of which can hold a link, and each band into blocks."""
    band = F.when(F.col("size") > block, F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)).otherwise(0).cast("int")
    rows = contested.withColumn("band", band)
    cells = rows.where(F.col("size") > block).groupBy("key", "band").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cell = lambda x, y: F.struct(x.alias("band"), y.alias("block"))
    out = [rows.where(F.col("size") <= block).withColumns({c: cell(F.lit(0), F.lit(0)) for c in ("own", "low", "high")})]
    large = rows.where(F.col("size") > block).join(cells, ["key", "band"]).withColumn("own", cell(F.col("band"), F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    for step in (-1, 0, 1):
        other = cells.select("key", (F.col("band") - step).alias("band"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        meets = large.join(other, ["key", "band"]).withColumn("other", cell(F.col("band") + step, F.col("block")))
        out.append(meets.select(*rows.columns, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    return reduce(DataFrame.unionByName, out)


def across(contested: DataFrame, halves: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of one bucket, in different components, that may be linked by a bound on prints.

    contested: key, i, j, size (of the bucket), rep, component, n, halves, prints.
    """

    def pairs_in(part: pa.RecordBatch) -> list[tuple[int, int]]:
        """Of the rows of one pair of cells."""
        side, component, rep, n = part.column(1).to_pylist(), *(part.column(k).to_numpy() for k in (4, 5, 6))
        i, j = part.column(2)[0].as_py(), part.column(3)[0].as_py()
        one_cell = part.column(0)[0].as_py()[1] == part.column(0)[0].as_py()[2]
        own = np.array([hash(x) for x in side])
        table = part.column(7).flatten().to_numpy().reshape(len(n), 2 * halves)
        prints = [np.frombuffer(p, dtype=np.uint16) for p in part.column(8).to_pylist()]
        lengths = np.array([len(p) for p in prints])
        lost = n - lengths  # shingles that share a print with another of their set
        a_side, b_side = table[:, :halves], table[:, halves:]
        found = []
        for x in range(len(n) - 1):
            ok = (component[x + 1 :] != component[x]) & (100 * np.minimum(n[x], n[x + 1 :]) >= percent * np.maximum(n[x], n[x + 1 :]))
            if not one_cell:
                ok &= own[x + 1 :] != own[x]
            at = x + 1 + np.flatnonzero(ok)
            if not len(at):
                continue
            # a pair that meets in more tables is compared in the first of them
            at = at[(np.argmax(a_side[at] == a_side[x], axis=1) == i) & (np.argmax(b_side[at] == b_side[x], axis=1) == j)]
            if not len(at):
                continue
            present[prints[x]] = 1
            ends = np.cumsum(lengths[at])
            both = np.add.reduceat(present[np.concatenate([prints[y] for y in at])], ends - lengths[at]) + np.minimum(lost[x], lost[at])
            present[prints[x]] = 0
            at = at[100 * both >= percent * (n[x] + n[at] - both)]
            found += [(int(rep[x]), int(rep[y])) for y in at]
        return found

    present = np.zeros(1 << 16, dtype=np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of rows of one pair of cells, at most two blocks long."""
        held: list[pa.RecordBatch] = []

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        def whole() -> list[tuple[int, int]]:
            return pairs_in(pa.Table.from_batches(held).combine_chunks().to_batches()[0]) if held else []

        now = None
        for batch in batches:
            meets = batch.column(0).to_pylist()
            found, start = [], 0
            for at in range(len(meets)):
                if meets[at] != now:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    found += whole()
                    held, now, start = [], meets[at], at
            if len(meets) > start:
                held.append(batch.slice(start))
            yield out(found)
        yield out(whole())

    name = lambda c: F.concat_ws(":", F.col(c)["band"], F.col(c)["block"])
    rows = dealt(contested, percent, block).select(F.array(F.col("key").cast("string"), name("low"), name("high")).alias("meet"), name("own").alias("side"), "i", "j", "component", "rep", "n", "halves", "prints")
    return rows.repartition("meet").sortWithinPartitions("meet", "rep").mapInArrow(compare, "a bigint, b bigint")


def read_texts(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """rep, n, prints, text of the wanted rows (rep, doc_id, row_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_batches(batches, 8 << 20):
            sets = [shingle_set(t, shingle) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(map(prints_of, sets)), pa.binary()), part.column(1)], names=["rep", "n", "prints", "text"])

    found = docs.join(wanted, ["doc_id", "row_key"]).groupBy("doc_id", "row_key").agg(F.first("rep").alias("rep"), F.first("text").alias("text"))  # repeated rows have one text
    return found.select("rep", "text").mapInArrow(run, "rep bigint, n bigint, prints binary, text string")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILARITY, halves: int = HALVES, half_rows: int = HALF_ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of `docs`."""
    small_batches(docs.sparkSession, "8m")  # pairs carry two texts a row
    docs = docs.select(whole_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_key", row_key())
    marks = written(sketches(docs, shingle, Sketch(halves, half_rows)), "sketches")
    some = marks.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row_key")).alias("one"), F.first("halves").alias("halves"))
    classes = written(classes.select("d1", "d2", "one.*", "halves").withColumn("rep", F.monotonically_increasing_id()), "classes")
    owners = written(some.select("doc_id", "d1", "d2").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep").distinct(), "owners")
    rows = bucket_rows(classes, halves)
    shared = rows.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre <> last").select("key", "centre")
    members = written(rows.join(shared, "key"), "members")
    pairs = members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    texts = written(read_texts(docs, classes.select("rep", "doc_id", "row_key").join(members.select("rep").distinct(), "rep", "left_semi"), shingle), "texts")
    links = written(confirmed(written(bounded(pairs, texts, percent), "pairs"), texts, shingle, percent), "links")

    # texts of one doc_id are one document
    several = owners.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b <> last").select("doc_id", "b")
    links = written(links.union(owners.join(several, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")), "links")
    found = connected_components(links)

    # members of one bucket in different components
    known = members.select("key", "rep", "i", "j").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_keys = known.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x <> y").select("key", "size")
    contested = written(known.join(open_keys, "key"), "contested")
    candidates = contested.join(texts.select("rep", "n", "prints"), "rep").join(classes.select("rep", "halves"), "rep")
    more = confirmed(written(across(candidates, halves, percent, block), "pairs"), texts, shingle, percent)
    links = written(links.union(more), "links")
    found = connected_components(links)

    least = classes.select("rep", "doc_id").join(found.withColumnRenamed("node", "rep"), "rep").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = found.join(least, "component").select(F.col("node").alias("rep"), "component_id")
    whole = classes.select("d1", "d2", "rep", "doc_id").join(label, "rep", "left").select("d1", "d2", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = marks.select("doc_id", "n_shingles", "d1", "d2").join(whole, ["d1", "d2"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("component_id").isNotNull() & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
