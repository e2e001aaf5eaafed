"""Exact top-k inner-product search as a Voronoi kNN join.

Rows that repeat an id and a vector become one with a count. Data and queries are grouped by their nearest pivot; the
number of pivots grows with the square root of the data. The summary of a data group is its pivot, its size, its radius,
and the distances of its nearest members to the pivot, of unlike ids; neighbouring pivots' queries form a query group of
bounded size with a centre and a radius.

1. From the summaries each query gets a score that its k-th best partner reaches at least, and is sent only to the data
   groups that may hold a better one.
2. A data row is replicated only to the query groups that sent a query to its group, and of those only where the row's
   own bound (centre and radius of the query group) reaches the least score that any of them still needs.
3. Data groups are cut into slices of bounded size; each query group and slice is solved locally and exactly, and the
   local lists are merged by rank.

Where vectors lie in clusters most groups and rows drop out; where they don't (random directions in many dimensions), no
bound can exclude anything, and every query group meets every row once.

Vectors are integers (floor of `scale` times each component); scores are exact up to 2**63: products beyond 2**53 are
summed as integers. Defined cases: rows with a null id, a null vector, or a null or non-finite component take no part; of
vectors of unlike length the shorter is filled with zeros, so an empty one scores 0; rows that repeat an id each count as a candidate (never of
their own id) and rows that repeat a query's id share one list; equal scores rank by id; with fewer than k candidates all
are returned; further columns are left out, and an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_id, written

BLOCK = 8192
EXACT = 2.0**53
SCALE = 256


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of whole numbers as double) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vectors.select(whole_id("vec_id").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale).cast("double")).alias("v"))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as a matrix."""
    out = np.zeros((len(column), width))
    if len(column):
        sizes = np.diff(column.offsets.to_numpy())
        at = np.repeat(np.arange(len(column)), sizes)
        out[at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def _cells(data: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, n, cell, distance, v (bytes) from vec_id, v, count."""
    width = pivots.shape[1]
    half = (pivots**2).sum(axis=1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), width)
            cell = np.argmax(x @ pivots.T - half, axis=1) if len(x) else np.zeros(0, int)
            distance = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(cell.astype(np.int32)), pa.array(distance), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "n", "cell", "distance", "v"])

    return data.mapInArrow(run, "vec_id bigint, n bigint, cell int, distance double, v binary")


def _chain(at: np.ndarray) -> list[int]:
    """The points from one to its nearest that isn't in the chain yet."""
    left = np.ones(len(at), dtype=bool)
    out = [0]
    left[0] = False
    while left.any():
        some = np.flatnonzero(left)
        nearest = int(some[np.argmin(((at[some] - at[out[-1]]) ** 2).sum(axis=1))])
        out.append(nearest)
        left[nearest] = False
    return out


class Groups:
    """Summaries of the data groups and of the query groups: a few numbers a pivot each."""

    def __init__(self, cells: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int, block: int):
        sums = {r.cell: r for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
        near = Window.partitionBy("cell", "part").orderBy("distance")
        ids = cells.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))  # an id counts once, as it may be the query's own
        parts = ids.select("cell", "vec_id", "distance", F.pmod(F.xxhash64("vec_id"), F.lit(32)).alias("part")).withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
        over = Window.partitionBy("cell").orderBy("distance")  # 32 * (k + 1) rows a group at most
        nearest: dict[int, list[tuple[float, int]]] = {}
        for r in parts.withColumn("r", F.row_number().over(over)).where(F.col("r") <= k + 1).collect():
            nearest.setdefault(r.cell, []).append((r.distance, r.vec_id))
        self.used = np.array(sorted(sums), dtype=np.int32)
        self.radius = np.array([sums[c].radius for c in self.used])
        self.centre = pivots[self.used]
        self.close = [np.array([d for d, _ in sorted(nearest[c])]) for c in self.used]
        self.owner = np.array([i for c in self.used for _, i in sorted(nearest[c])])
        self.slices = np.array([max(1, -(-sums[c].n // block)) for c in self.used], dtype=np.int32)
        # query groups: neighbouring pivots with up to `block` queries together, or parts of one pivot's
        asks = {r.cell: r for r in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
        self.first, self.parts = np.zeros(len(pivots), dtype=np.int32), np.ones(len(pivots), dtype=np.int32)
        held: list[list[int]] = []
        size = block + 1
        asked = sorted(asks)
        for c in [asked[i] for i in _chain(pivots[asked])] if asked else []:
            n = asks[c].n
            if n > block:
                self.first[c], self.parts[c] = len(held), -(-n // block)
                held += [[c]] * int(self.parts[c])
                size = block + 1
            else:
                if size + n > block:
                    held.append([])
                    size = 0
                held[-1].append(c)
                self.first[c] = len(held) - 1
                size += n
        self.middle = np.array([pivots[g].mean(axis=0) for g in held]).reshape(-1, pivots.shape[1])
        self.spread = np.array([max(np.linalg.norm(pivots[c] - m) + asks[c].radius for c in g) for g, m in zip(held, self.middle)])

    def group_of(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        part = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % self.parts[cell]
        return (self.first[cell] + part).astype(np.int32)

    def needed(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the score that its k-th partner reaches at least, and the data groups that may hold a better."""
        base, length = q @ self.centre.T, np.linalg.norm(q, axis=1)
        slack = 1e-9 * (1 + np.abs(base).max(axis=1) + length * self.radius.max())
        surely = np.concatenate([base[:, [j]] - length[:, None] * self.close[j][None, :] for j in range(len(self.used))], axis=1)
        surely[ids[:, None] == self.owner[None, :]] = -np.inf  # the query's own rows are no partners
        least = -np.partition(-surely, k - 1, axis=1)[:, k - 1] - slack if surely.shape[1] >= k else np.full(len(q), -np.inf)
        return least, base + length[:, None] * self.radius[None, :] + slack[:, None] >= least[:, None]


def routed(queries: DataFrame, groups: Groups, width: int, k: int) -> DataFrame:
    """query_id, query_group, q, least, cells, slices: a row a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (4 << 20) // (len(groups.used) * (k + 1)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column(0).to_numpy()
                q = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.float64).reshape(-1, width)
                least, wanted = groups.needed(ids, q, k)
                i, j = np.nonzero(wanted)
                offsets = pa.array(np.concatenate(([0], np.cumsum(wanted.sum(axis=1)))).astype(np.int32))
                cells = pa.ListArray.from_arrays(offsets, pa.array(groups.used[j])), pa.ListArray.from_arrays(offsets, pa.array(groups.slices[j]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(groups.group_of(part.column(1).to_numpy(), ids)), part.column(2), pa.array(least), *cells], names=["query_id", "query_group", "q", "least", "cells", "slices"])

    return queries.select("vec_id", "cell", "v").mapInArrow(run, "query_id bigint, query_group int, q binary, least double, cells array<int>, slices array<int>")


def replicated(cells: DataFrame, asked: DataFrame, groups: Groups, width: int) -> DataFrame:
    """Data rows once for each query group (asked: cell, query_group, least, slices) that may need them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.float64).reshape(-1, width)
            group = batch.column(3).to_numpy()
            base, far = np.einsum("ij,ij->i", x, groups.middle[group]), groups.spread[group] * np.linalg.norm(x, axis=1)
            keep = base + far + 1e-9 * (1 + np.abs(base) + far) >= batch.column(5).to_numpy()
            yield batch.select(["vec_id", "n", "cell", "query_group", "v", "slice"]).filter(pa.array(keep))

    pairs = cells.join(asked, "cell").select("vec_id", "n", "cell", "query_group", "v", "least", F.pmod(F.xxhash64("vec_id", "v"), F.col("slices")).cast("int").alias("slice"))
    return pairs.mapInArrow(run, "vec_id bigint, n bigint, cell int, query_group int, v binary, slice int")


def solve(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, times: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query its k best (query id, ids, scores) among x, sorted by id; times: rows that each stands for."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) >= EXACT:
        q, x = q.astype(np.int64), x.astype(np.int64)
    n = min(k, len(ids))
    for start in range(0, len(q), 512):
        mine = own[start : start + 512]
        score = q[start : start + 512] @ x.T
        none = np.iinfo(np.int64).min if score.dtype == np.int64 else -np.inf
        score[mine[:, None] == ids[None, :]] = none
        least = np.partition(score, len(ids) - n, axis=1)[:, len(ids) - n]
        for i in range(len(mine)):
            found = np.flatnonzero((score[i] >= least[i]) & (score[i] > none))
            best = np.repeat(found, times[found])  # each row of an id is a candidate
            best = best[np.lexsort((best, -score[i, best]))[:k]]
            yield np.full(len(best), mine[i]), ids[best], score[i, best].astype(np.int64)


def join_plan(vectors: DataFrame, is_query: Column, k: int, pivots: int | None, block: int, scale: int) -> tuple[DataFrame, DataFrame, int] | None:
    """Queries by (query_group, cell, slice), data rows by the same, and the vectors' width; None without vectors."""
    data = written(quantised(vectors, scale), "quantised")
    n, width = data.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return None
    width = max(1, width)
    wanted = pivots or max(8, round(math.sqrt(n) / 6))
    chosen = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()  # grows with the root of the data
    at = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        at[i, : len(r.v)] = r.v
    at = np.unique(at, axis=0)
    cells = written(_cells(data.groupBy("vec_id", "v").count(), at), "cells")
    queries = cells.where(is_query).select("vec_id", "cell", "distance", "v").dropDuplicates()
    groups = Groups(cells, queries, at, k, block)
    sent = written(routed(queries, groups, width, k), "routed")
    each = sent.select("query_group", "least", F.explode(F.arrays_zip("cells", "slices")).alias("z")).select("query_group", "least", F.col("z.cells").alias("cell"), F.col("z.slices").alias("slices"))
    asked = written(each.groupBy("query_group", "cell").agg(F.min("least").alias("least"), F.max("slices").alias("slices")), "asked")
    of = sent.select("query_id", "query_group", "q", F.explode(F.arrays_zip("cells", "slices")).alias("z")).select("query_id", "query_group", "q", F.col("z.cells").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("z.slices") - 1)).alias("slice"))
    return of, replicated(cells, asked, groups, width), width


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int | None = None, block: int = BLOCK, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best partners of each query among all other rows."""
    plan = join_plan(vectors, is_query, k, pivots, block, scale)
    if plan is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sent, data, width = plan

    def local(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = []
        if left.num_rows and right.num_rows:
            right = right.sort_by("vec_id")
            q, x = (np.frombuffer(b"".join(t.to_pylist()), dtype=np.float64).reshape(-1, width) for t in (left["q"], right["v"]))
            found = list(solve(q, left["query_id"].to_numpy(), x, right["vec_id"].to_numpy(), np.minimum(right["n"].to_numpy(), k), k))
        columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else [()] * 3)]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    key = ["query_group", "cell", "slice"]
    lists = sent.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(local, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
