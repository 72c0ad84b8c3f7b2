"""Approximate nearest neighbours by collision counting on single projections.

Every vector is projected on `projections` random lines; each line has an array of the projections, sorted. A query opens a
window around its own projection on every line. A vector collides with the query on a line if it lies in the window there;
vectors that collide on at least `threshold` lines are verified by their exact inner product. While fewer than `wanted`
vectors have been verified, the windows widen by `growth` (virtual rehashing: the arrays stay as they are).

Largest inner product is turned into smallest distance first: vectors are scaled by the largest norm and get one more
component that brings them to length 1, queries are scaled to length 1. That component must stay small for collisions to tell
vectors apart, so each block is cut into ranges of norm, none wider than `NORM_RATIO` unless it has at most `wanted` vectors
and all are verified. Each range is scaled by its own largest norm and searched from the longest vectors on; the others are
left once their largest norm times the query's cannot reach the k-th inner product so far.

Vectors are dealt into blocks by a hash of their id; each pair of a block of vectors and a block of queries is one bounded
task that returns each query's best of that block, and the best of those are the result. Projections depend on the seed
and the number of components alone. Work grows with queries times blocks, as a stated query set against all rows does.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an
id; vectors meet those with as many components only. Ties go to the smaller id, equal vectors under different ids are all
candidates, and repeated rows of one id count once. Fewer candidates than `k` are all returned. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerprice.llm.columns import written

PROJECTIONS = 96
THRESHOLD = 58
FIRST_WIDTH = 0.05
GROWTH = 1.2
LEVELS = 24
START = 0.85
WANTED = 600
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
NORM_RATIO = 1.05

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`vec_id`, `vector` (doubles) and `norm` of the vectors that take part, one row for each id."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), finite.alias("finite"))
        .where("vec_id IS NOT NULL AND vector IS NOT NULL AND finite AND size(vector) > 0")
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("norm", F.sqrt(square))
        .where("norm > 0")
    )


def lines(components: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, components]).standard_normal((components + 1, count))


class CollisionIndex:
    """Sorted projections of a block of vectors on every line, and each vector's place in them."""

    def __init__(self, vectors: np.ndarray, norms: np.ndarray, largest: float, projections: int, seed: int):
        self.lines = lines(vectors.shape[1], projections, seed)
        rest = np.sqrt(np.maximum(0.0, 1.0 - (norms / largest) ** 2))
        projected = np.column_stack([vectors / largest, rest]) @ self.lines
        order = np.argsort(projected, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(projected.T, order, axis=1)
        self.places = np.empty(order.shape, np.uint16 if len(vectors) < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(vectors), dtype=self.places.dtype)[None, :], axis=1)

    def _windows(self, at: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and size of the windows around `at` (by query and line), as wide as each query's level says."""
        width = FIRST_WIDTH * GROWTH**level
        first, size = np.empty(at.shape, self.places.dtype), np.empty(at.shape, self.places.dtype)
        for line, row in enumerate(self.sorted):
            first[:, line] = low = np.searchsorted(row, at[:, line] - width)
            size[:, line] = np.searchsorted(row, at[:, line] + width, "right") - low
        return first, size

    def verified(self, queries: np.ndarray, threshold: int, wanted: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each query's number and the vectors that collide often enough, from the narrowest windows that give `wanted`.

        Windows that hold too small a share of the vectors for `threshold` collisions to be usual are passed over. With
        no window wide enough all vectors are verified.
        """
        count, n = self.places.shape
        if n <= wanted:
            yield from ((query, np.arange(n)) for query in range(len(queries)))
            return
        at = np.column_stack([queries / np.linalg.norm(queries, axis=1)[:, None], np.zeros(len(queries))]) @ self.lines
        level, beyond = np.zeros(len(queries), np.int64), np.full(len(queries), LEVELS)
        while (level < beyond).any():  # bisect for the first level with the share
            middle = (level + beyond) // 2
            enough = self._windows(at, middle)[1].mean(axis=1) >= START * threshold / count * n
            beyond, level = np.where(enough, middle, beyond), np.where(enough, level, np.minimum(middle + 1, beyond))
        left = np.arange(len(queries))
        while len(left):
            first, size = self._windows(at[left], level[left])
            again = []
            for i, query in enumerate(left.tolist()):
                inside = (self.places - first[i][:, None]) < size[i][:, None]  # places before the window wrap around
                found = np.flatnonzero(inside.view(np.uint8).sum(axis=0, dtype=np.uint8 if count < 256 else np.uint32) >= threshold)
                if len(found) >= wanted:
                    yield query, found
                elif level[query] + 1 < LEVELS:
                    again.append(query)
                else:
                    yield query, np.arange(n)
            left = np.array(again, np.int64)
            level[left] += 1


def norm_ranges(norms: np.ndarray, wanted: int) -> Iterator[tuple[int, int]]:
    """First place and end of the ranges of falling `norms`."""
    start = 0
    while start < len(norms):
        end = max(int(np.searchsorted(-norms, -norms[start] / NORM_RATIO, "right")), min(start + wanted, len(norms)))
        yield start, end
        start = end


def best_of_block(
    ids: np.ndarray,
    rows: np.ndarray,
    norms: np.ndarray,
    asked_ids: np.ndarray,
    asking: np.ndarray,
    k: int,
    projections: int = PROJECTIONS,
    threshold: int = THRESHOLD,
    wanted: int = WANTED,
    seed: int = 1,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and scores of each query's best `k` of a block but itself, best first."""
    order = np.lexsort((ids, -norms))
    ids, rows, norms = ids[order], rows[order], norms[order]
    lengths, least = np.linalg.norm(asking, axis=1), np.full(len(asking), -np.inf)
    best = [(np.zeros(0, np.int64), np.zeros(0))] * len(asking)
    for start, end in norm_ranges(norms, wanted):
        open_ = np.flatnonzero(norms[start] * lengths * (1 + 1e-9) >= least)
        if not len(open_):
            break
        index = CollisionIndex(rows[start:end], norms[start:end], norms[start], projections, seed)
        for number, at in index.verified(asking[open_], threshold, wanted):
            asked, at = open_[number], at + start
            query = asking[asked]
            scores = rows[at] @ query
            if len(at) > k + 1:
                at = at[scores >= np.partition(scores, -k - 1)[-k - 1] - 1e-12 * np.abs(scores).max()]
            at = at[ids[at] != asked_ids[asked]]
            scores = np.array([math.fsum(x) for x in (rows[at] * query).tolist()])
            found, scores = np.append(best[asked][0], ids[at]), np.append(best[asked][1], scores)
            first = np.lexsort((found, -scores))[:k]
            best[asked] = found[first], scores[first]
            if len(first) == k:
                least[asked] = scores[first[-1]]
    return best


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = PROJECTIONS,
    threshold: int = THRESHOLD,
    wanted: int = WANTED,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = 1,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id` and `score` of each query's `k` best vectors but itself.

    `is_query` is a condition on `vec_id`. `wanted` vectors are verified at least for each query in each block.
    """
    table = written(usable(vectors, id_col, vector_col).withColumn("components", F.size("vector")), "vectors")
    sizes = table.agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("q")).first()
    blocks, query_blocks = max(1, -(-sizes["n"] // block_rows)), max(1, -(-(sizes["q"] or 0) // query_rows))
    dealt = F.xxhash64("vec_id", F.lit(seed))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")
    stored = table.withColumn("block", F.pmod(dealt, F.lit(blocks)).cast("int")).select("*", every_query_block)
    asked = (
        table.where(is_query)
        .withColumn("query_block", F.pmod(dealt, F.lit(query_blocks)).cast("int"))
        .select("vec_id", "vector", "components", "query_block", every_block)
    )

    def search(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, rows, norms = block["vec_id"].to_numpy(), np.stack(block["vector"].to_list()), block["norm"].to_numpy()
        asked_ids, asking = queries["vec_id"].to_numpy(), np.stack(queries["vector"].to_list())
        best = best_of_block(ids, rows, norms, asked_ids, asking, k, projections, threshold, wanted, seed)
        out = [(np.full(len(found), i), found, scores) for i, (found, scores) in zip(asked_ids, best, strict=True)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)), strict=True)))

    keys = ["block", "query_block", "components"]
    found = asked.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInPandas(search, FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
