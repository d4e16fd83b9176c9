"""Exact top-k inner-product search with k-d trees per shard.

Shards are the cells of a few median splits fitted on a bounded sample; a cell with many vectors is
dealt over several shards. In each shard median splits build a tree whose nodes keep tight bounding
boxes. The inner product of a query with anything in a box is at most the sum of the larger of
q * low and q * high; nodes are visited best first, and neither nodes nor whole cells whose bound is
below the k-th score known so far are opened. The k-th score of a query in one shard of its best cell
goes with it to all others. Components are integers: sums below 2**53 are exact as floats, larger ones
are made with Python integers, and bounds are widened by more than their rounding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import staged
from .vectors import matrix, usable

#: Bounds: vectors of the sample that fits the splits, of a shard and of a leaf; queries bounded at once, and those that meet one copy of a shard; cells; boxes that are broadcast.
SAMPLE, SHARD, LEAF, BLOCK, QUERIES, CELLS, FEW = 20_000, 20_000, 128, 1_024, 4_096, 1_024, 4_096
#: Sums of floats below this are exact integers; a bound is widened by this share of what it adds up.
EXACT, WIDER = 2.0**53, 1e-12


def integers(vector: Column) -> Column:
    """floor(256 * x) of each component, computed in double precision (a double of that size or more is an integer)."""
    whole = lambda y: F.when(F.abs(y) >= EXACT, y).otherwise(F.floor(y).cast("double"))
    return F.transform(vector, lambda x: whole(x.cast("double") * 256))


def clipped(score: int) -> int:
    """The nearest 64-bit integer."""
    return max(-(1 << 63), min((1 << 63) - 1, score))


class Tree:
    """Median splits along the widest side of each box, down to leaves."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.low, self.high, self.children, self.leaves = [], [], [], []
        self.ids, self.rows = ids, rows
        self._build(np.arange(len(rows)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, at: np.ndarray) -> int:
        node, part = len(self.low), self.rows[at]
        self.low.append(part.min(0))
        self.high.append(part.max(0))
        self.children.append(None)
        self.leaves.append(None)
        wide = self.high[node] - self.low[node]
        if len(at) <= LEAF or not wide.any():
            self.leaves[node] = at[np.argsort(self.ids[at], kind="stable")]
            return node
        order = np.argsort(part[:, int(wide.argmax())], kind="stable")
        half = len(at) // 2
        self.children[node] = (self._build(at[order[:half]]), self._build(at[order[half:]]))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product of each query with what each node holds."""
        out = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        size = np.maximum(np.abs(self.low), np.abs(self.high))
        return out if self.exact(queries) else out + WIDER * (np.abs(queries) @ size.T)

    def exact(self, queries: np.ndarray) -> bool:
        """Whether sums of products with these queries are below EXACT."""
        return np.abs(self.rows).max() * np.abs(queries).max() * self.rows.shape[1] < EXACT

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, least: float, exact: bool = True) -> list[tuple[int, int]]:
        """The k best (score, row) but row ``own``, ties to the smaller id; none below ``least``."""
        best: list[tuple[float, int, int]] = []  # a heap with the worst on top
        heap = [(-bounds[0], 0)]
        size = np.abs(query)
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            at = self.leaves[node]
            scores = self.rows[at] @ query
            open_ = scores if exact else scores + WIDER * (np.abs(self.rows[at]) @ size)
            for j in np.flatnonzero(open_ >= least).tolist():
                row = int(at[j])
                score = scores[j].item() if exact else clipped(sum(int(a) * int(b) for a, b in zip(self.rows[row].tolist(), query.tolist(), strict=True)))
                got = (score, -int(self.ids[row]), -row)
                if row == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, got)
                elif got > best[0]:
                    heapq.heapreplace(best, got)
                if len(best) == k and best[0][0] > least:
                    least = best[0][0]
        return [(int(s), -r) for s, _, r in sorted(best, reverse=True)]


def fit_splits(sample: np.ndarray, cells: int) -> list[tuple[int, float] | None]:
    """A binary heap of (dimension, median) splits into at most ``cells`` cells."""
    out: list[tuple[int, float] | None] = []
    parts = {0: sample}
    node = 0
    while 2 * node + 1 < 2 * cells - 1:
        part = parts.pop(node, np.zeros((0, sample.shape[1])))
        wide = part.max(0) - part.min(0) if len(part) > 1 else np.zeros(1)
        if not wide.any():
            out.append(None)
        else:
            d = int(wide.argmax())
            median = float(np.median(part[:, d]))
            out.append((d, median))
            parts[2 * node + 1], parts[2 * node + 2] = part[part[:, d] <= median], part[part[:, d] > median]
        node += 1
    return out


def cell_of(vector: Column, splits: list[tuple[int, float] | None]) -> Column:
    """The cell in which a vector falls."""

    def walk(node: int) -> Column:
        if node >= len(splits) or splits[node] is None:
            return F.lit(node)
        d, median = splits[node]
        return F.when(F.get(vector, F.lit(d)) <= median, walk(2 * node + 1)).otherwise(walk(2 * node + 2))

    return walk(0)


def _search(k: int):
    """One copy of a shard against its queries, as a function for cogrouped tables."""

    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if shard.num_rows and asked.num_rows:
            shard = shard.sort_by("row")
            ids, keys = shard.column("id").to_numpy(), shard.column("row").to_numpy()
            tree = Tree(ids, matrix(shard.column("v")))
            own, least = asked.column("query").to_numpy(), asked.column("least").to_pylist()
            rows = matrix(asked.column("q"))
            place = np.searchsorted(keys, own)
            place = np.where((place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == own), place, -1)
            for at in range(0, len(own), BLOCK):
                part = rows[at : at + BLOCK]
                bounds, exact = tree.bounds(part), tree.exact(part)
                for j in range(len(part)):
                    floor = least[at + j]
                    found = tree.search(part[j], int(place[at + j]), bounds[j], k, -np.inf if floor is None else float(floor), exact)
                    out += [(int(own[at + j]), int(keys[r]), int(ids[r]), s) for s, r in found]
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query", "row", "vec_id", "score"), columns, strict=True)})

    return run


RESULT = "query long, row long, vec_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _few(rows: DataFrame) -> DataFrame:
    """``rows`` to be broadcast if they are few, else as they are."""
    return F.broadcast(rows) if rows.limit(FEW + 1).count() <= FEW else rows


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, shard_size: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows for each row whose vec_id is divisible by ``every``.

    Rows with a null id, and vectors that are null, empty or hold null or non-finite components, take no
    part; vectors meet only those of equal length. Rows are told apart by a key of their own: each row
    with a divisible id is a query, and rows that repeat an id, or a whole row, are candidates of their own.
    Scores are compared exactly as 64-bit integers; one outside their range counts as the nearest of them. An empty table gives no rows; columns other than vec_id and embedding are not read.
    A query goes to the cells that may still hold something better, at most CELLS for each vector length.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = staged(rows.select(F.monotonically_increasing_id().alias("row"), "id", integers(F.col("v")).alias("v"), F.size("v").alias("d")), "vectors")
    count = rows.count()
    lucky = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < F.lit(float(1 << 20) * SAMPLE / max(count, 1))
    sample = [np.array(r["v"]) for r in rows.where(lucky).select("v").limit(2 * SAMPLE).collect()]
    length = max((len(v) for v in sample), default=0)
    splits = fit_splits(np.array([v for v in sample if len(v) == length]), max(1, min(CELLS, count // shard_size))) if length else []
    cell = ["d", "cell"]
    rows = rows.withColumn("cell", cell_of(F.col("v"), splits))
    sides = rows.select(*cell, F.posexplode("v").alias("i", "x")).groupBy(*cell, "i").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
    cells = sides.groupBy(*cell).agg(F.array_sort(F.collect_list(F.struct("i", "low", "high"))).alias("box"), F.ceil(F.max("n") / shard_size).cast("int").alias("pieces"))
    cells = staged(cells, "cells")
    small = _few(cells)
    rows = rows.join(_few(cells.select(*cell, "pieces")), cell)
    rows = staged(rows.select("row", "id", "v", *cell, F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int").alias("piece")), "shards")
    shard = [*cell, "piece"]
    queries = rows.where(F.col("id") % every == 0).select(F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("q"), "d")

    def side(q: Column, b: Column) -> Column:
        low, high = q * b["low"], q * b["high"]
        return F.greatest(low, high) + WIDER * F.greatest(F.abs(low), F.abs(high))

    bound = F.aggregate(F.zip_with("q", "box", side), F.lit(0.0), lambda a, x: a + x)
    # the best cell of a query is found before any shuffle: the maximum is combined where the bounds are made.
    # One of its shards is asked first, so the queries of a popular cell are dealt over its shards
    first_piece = F.pmod(F.xxhash64("query", F.lit(1)), F.col("pieces")).cast("int").alias("piece")
    asked = queries.join(small, "d").select("query", "query_id", "q", F.struct(*cell, first_piece).alias("own"), bound.alias("bound"))
    best = asked.groupBy("query", "query_id", "q").agg(F.max_by("own", F.struct("bound", "own")).alias("own"))
    best = staged(best, "asked")

    def searched(part: DataFrame) -> DataFrame:
        """A shard that many queries ask for is copied, so that no task has more than about QUERIES of them."""
        part = staged(part, "part")
        load = staged(part.groupBy(*shard).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies")), "load")
        copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
        left = rows.join(load, shard).select("row", "id", "v", *shard, copy)
        right = part.join(load, shard).withColumn("copy", F.pmod(F.xxhash64("query"), F.col("copies")).cast("int"))
        return left.groupBy(*shard, "copy").cogroup(right.groupBy(*shard, "copy")).applyInArrow(_search(k), RESULT)

    first = staged(searched(best.select("query", "q", "own.*", F.lit(None).cast("double").alias("least"))), "found")
    worst = F.min("score").cast("double")
    floors = first.groupBy("query").agg(F.when(F.count("*") >= k, worst - F.abs(worst) * F.lit(WIDER)).alias("least"))
    # only the pairs of query and cell that may still give a better score go on, to each shard of the cell but the one asked
    rest = best.join(floors, "query", "left").withColumn("d", F.col("own.d")).join(small, "d").withColumn("bound", bound).where(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
    rest = rest.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).where(F.struct(*shard) != F.col("own")).select("query", "q", *shard, "least")
    names = best.select("query", "query_id")
    return _best(first.unionByName(searched(rest)), k).join(names, "query").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
