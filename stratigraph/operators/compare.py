"""Comparison of runs and graphs: keyed round trips, set differences, order-insensitive fingerprints."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import normalise_snapshot
from ..sources.scratch import carried, in_ranges, stored
from ..sources.writers import ntriples_line

TERM = ["s", "p", "o", "o_kind", "o_dt", "o_lang"]


def distinct_triples(t: DataFrame) -> DataFrame:
    """Set semantics over the full term: value, kind, datatype and language."""
    return t.dropDuplicates(TERM)


def merge_graphs(*ts: DataFrame) -> DataFrame:
    return distinct_triples(reduce(DataFrame.unionByName, ts))


def graph_diff(a: DataFrame, b: DataFrame, limit: int = 6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, sample only in a, sample only in b)."""
    only_a, only_b = a.select(*TERM).subtract(b.select(*TERM)), b.select(*TERM).subtract(a.select(*TERM))
    counts = only_a.agg(F.count("*").alias("only_a")).crossJoin(only_b.agg(F.count("*").alias("only_b")))
    return counts, only_a.orderBy(*TERM).limit(limit), only_b.orderBy(*TERM).limit(limit)


def match_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer match on keys (null keys equal each other): in_a, in_b, and both sides' columns as a_* and b_*."""
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns], F.lit(True).alias("in_a"))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns], F.lit(True).alias("in_b"))
    on = reduce(lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys])
    joined = left.join(right, on, "full_outer")
    return joined.withColumns({"in_a": F.coalesce("in_a", F.lit(False)), "in_b": F.coalesce("in_b", F.lit(False))})


def key_symmetric_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side: what only one relation has."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.subtract(y).withColumn("side", F.lit("a")).unionByName(y.subtract(x).withColumn("side", F.lit("b")))


def round_trip(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]], keys: list[tuple[str, str]], tol: float = 1e-6) -> DataFrame:
    """field, worst, null_mismatches, flag for each pair of columns: OK under 1e-9, ~ under tol, else XX. A value
    against a null, or a row without its counterpart, is XX."""
    left = a.select(*[F.col(x).alias(f"k{i}") for i, (x, _) in enumerate(keys)], *[F.col(x).cast("double").alias(f"a{i}") for i, (x, _) in enumerate(pairs)])
    right = b.select(*[F.col(y).alias(f"k{i}") for i, (_, y) in enumerate(keys)], *[F.col(y).cast("double").alias(f"b{i}") for i, (_, y) in enumerate(pairs)])
    m = match_keys(left, right, [f"k{i}" for i in range(len(keys))])
    sums = m.agg(F.count_if(~F.col("in_a") | ~F.col("in_b")).alias("unmatched"), *[F.max(F.abs(F.col(f"a_a{i}") - F.col(f"b_b{i}"))).alias(f"d{i}") for i in range(len(pairs))], *[F.count_if(F.col(f"a_a{i}").isNull() != F.col(f"b_b{i}").isNull()).alias(f"n{i}") for i in range(len(pairs))])
    rows = sums.select("unmatched", F.explode(F.array(*[F.struct(F.lit(y).alias("field"), F.coalesce(f"d{i}", F.lit(0.0)).alias("worst"), F.col(f"n{i}").alias("null_mismatches")) for i, (_, y) in enumerate(pairs)])).alias("r")).select("r.*", "unmatched")
    return rows.withColumn("flag", F.when((F.col("null_mismatches") > 0) | (F.col("unmatched") > 0), "XX").when(F.col("worst") < 1e-9, "OK").when(F.col("worst") < tol, "~").otherwise("XX"))


def compare_runs(old: DataFrame, new: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """column, changed, null_moved over the groups of both runs; and the row counts of each."""
    m = match_keys(old.select(*keys, *cols), new.select(*keys, *cols), keys)
    sums = m.agg(F.count_if("in_a").alias("n_old"), F.count_if("in_b").alias("n_new"), *[F.count_if(F.col("in_a") & F.col("in_b") & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(f"x_{c}") for c in cols], *[F.count_if(F.col("in_a") & F.col("in_b") & (F.col(f"a_{c}").isNull() != F.col(f"b_{c}").isNull())).alias(f"z_{c}") for c in cols])
    return sums.select("n_old", "n_new", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"x_{c}").alias("changed"), F.col(f"z_{c}").alias("null_moved")) for c in cols])).alias("r")).select("r.*", "n_old", "n_new")


def _masked_line() -> Column:
    """A triple's line with what changes from export to export masked; only lines that can hold such a thing are searched."""
    line = ntriples_line()
    return F.when(line.contains("dataset_") | line.rlike(r'"\d{4}-\d\d-\d\d'), normalise_snapshot(line)).otherwise(line)


def graph_fingerprint(t: DataFrame, mask_snapshot: bool = True) -> DataFrame:
    """One row that is equal for equal graphs in any order: number, xor and sum of the hashes of the distinct lines, which
    are told apart by their MD5, so that no line is shuffled."""
    h = F.conv(F.substring("md5", 1, 15), 16, 10).cast("bigint")
    lines = t.select(F.md5(_masked_line() if mask_snapshot else ntriples_line()).alias("md5")).distinct()
    return lines.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("total"))


def digest_lines(lines: DataFrame, leaf: int = 1 << 18) -> DataFrame:
    """One row: n, sha256 of the distinct lines of column `line` in order, joined by line feeds. Up to `leaf` lines that is
    the SHA-256 of the whole; beyond, the lines of each leaf (so many in a row) are hashed, then the leaves' digests in
    their order as lines again, up to one root. The order comes from ranges, and a leaf is read as a sorted stream, so
    nothing is gathered; the result depends on the lines alone."""
    rows, first = lines.select("line").distinct(), None
    while True:
        ranges = in_ranges(rows, "line") if first is None else rows
        if first is None:
            before = carried(ranges, F.count("*"), F.sum)
            at = F.row_number().over(Window.partitionBy("_part").orderBy("line")) + F.coalesce("carried", F.lit(0)) - 1
            rows = ranges.join(before, "_part").select(at.alias("at"), "line")
        leaves = rows.select(F.floor(F.col("at") / leaf).alias("leaf"), "at", "line").repartition("leaf").sortWithinPartitions("leaf", "at")
        hashed = stored(leaves.mapInArrow(_leaf_digests, "at bigint, n bigint, line string"), "digests")
        if first is None:
            first = hashed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        top = hashed.limit(2).collect()
        if len(top) < 2:
            return first.select("n", F.lit(top[0].line if top else hashlib.sha256(b"").hexdigest()).alias("sha256"))
        rows = hashed.select("at", "line")


def _leaf_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """at (the leaf's number), n, line (its digest) of each leaf; the rows come leaf by leaf, in order."""
    row = lambda leaf, n, h: pa.RecordBatch.from_pydict({"at": [leaf], "n": [n], "line": [h.hexdigest()]}, pa.schema([("at", pa.int64()), ("n", pa.int64()), ("line", pa.string())]))
    now, n, digest = None, 0, None
    for batch in batches:
        for leaf, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if leaf != now:
                if now is not None:
                    yield row(now, n, digest)
                now, n, digest = leaf, 0, hashlib.sha256()
            digest.update(("\n" if n else "").encode() + line.encode())
            n += 1
    if now is not None:
        yield row(now, n, digest)


#: Lines travel to the digest in packs of about so many bytes, compressed.
PACK = 1 << 14


def digest_stream(lines: DataFrame, pack: int = PACK) -> DataFrame:
    """One row: n, sha256 of the distinct lines of column `line` in order, joined by line feeds: one digest of the whole,
    however many lines. They are put in order, made distinct and packed by ranges, in parallel; as SHA-256 goes on from
    byte to byte, one task then reads the packs in their order. It sorts them by spilling and holds one batch of them."""
    ranges = lines.select("line").repartitionByRange("line").withColumn("part", F.spark_partition_id()).sortWithinPartitions("line")
    packs = ranges.mapInArrow(_packer(pack), "part int, at bigint, n bigint, pack binary")
    ended = packs.repartition(1).sortWithinPartitions("part", "at").mapInArrow(_whole_digest, "n bigint, sha256 string")
    return ended.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.max("sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("sha256"))


def _packer(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("pack", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sorted lines of one range, each once, in packs numbered by `at`."""
        part, at, before, held, length = None, 0, None, [], 0
        row = lambda: pa.RecordBatch.from_pydict({"part": [part], "at": [at], "n": [len(held)], "pack": [zlib.compress(b"\n".join(held), 1)]}, schema)
        for batch in batches:
            for part, line in zip(batch.column("part").to_pylist(), batch.column("line").cast(pa.binary()).to_pylist()):
                if line is None or line == before:
                    continue
                before = line
                held.append(line)
                length += len(line) + 1
                if length >= size:
                    yield row()
                    at, held, length = at + 1, [], 0
        if held:
            yield row()

    return packed


def _whole_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, digest = 0, hashlib.sha256()
    for batch in batches:
        for lines, pack in zip(batch.column("n").to_pylist(), batch.column("pack")):
            digest.update(b"\n" if n else b"")
            digest.update(zlib.decompress(pack.as_buffer()))
            n += lines
    yield pa.RecordBatch.from_pydict({"n": [n], "sha256": [digest.hexdigest()]}, pa.schema([("n", pa.int64()), ("sha256", pa.string())]))


def graph_digest(t: DataFrame, mask_snapshot: bool = True) -> DataFrame:
    """One row: n and the exact digest of the graph's N-Triples lines in order (see digest_stream)."""
    line = _masked_line() if mask_snapshot else ntriples_line()
    return digest_stream(t.select(line.alias("line")))


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: equal, and both fingerprints."""
    x, y = (graph_fingerprint(t).select(F.struct("n", "xor", "total").alias(name)) for t, name in ((a, "a"), (b, "b")))
    return x.crossJoin(y).select((F.col("a") == F.col("b")).alias("equal"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
