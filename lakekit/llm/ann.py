"""Nearest neighbours by largest inner product from a forest of hash prefixes.

Each tree gives a vector a string of bits, the sides of random planes on which it lies, and
holds its strings in a sorted array. A query descends in every tree to the longest prefix
that any string shares with its own; then all trees ascend together, one bit at a time,
until the ranges below their prefixes hold enough entries. The distinct vectors in those
ranges are compared exactly, in double precision.

Vectors are dealt into shards of bounded size by a hash of their id, each with its own
forest over all its rows; queries come in blocks of bounded size, and every block meets
every shard. So neither a dense region nor a vector held by many rows makes a large
task. The entries to gather are a share of the shard, for vectors without clusters
as in the supplied tables; clustered ones need a smaller share for the same recall.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES = 40
BITS = 32
# Entries of all trees together, as a share of the rows of a shard.
ENTRY_SHARE = 1.2
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
COMPARED_QUERIES = 64


def takes_part(vector: Column) -> Column:
    """Finite in every component, and not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """The sorted hash strings of some vectors, in every tree."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int):
        planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        self._planes, self._trees, self._bits = planes, trees, bits
        codes = self.codes(vectors)
        self._order = np.argsort(codes, axis=0, kind="stable")
        self._sorted = np.take_along_axis(codes, self._order, axis=0)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        sides = (vectors @ self._planes > 0).reshape(len(vectors), self._trees, self._bits)
        return sides @ (1 << np.arange(self._bits - 1, -1, -1, dtype=np.int64))

    def ranges(self, queries: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree the range of its prefix, at the longest common prefix
        length at which all trees together hold ``enough`` entries, or else at none."""
        codes = self.codes(queries)
        low = np.zeros(codes.shape, dtype=np.int64)
        high = np.full(codes.shape, len(self._sorted), dtype=np.int64)
        open_ = np.arange(len(codes))
        for depth in range(self._bits, 0, -1):
            shift = self._bits - depth
            first = codes[open_] >> shift << shift
            a, b = np.empty_like(first), np.empty_like(first)
            for t in range(self._trees):
                a[:, t] = np.searchsorted(self._sorted[:, t], first[:, t])
                b[:, t] = np.searchsorted(self._sorted[:, t], first[:, t] + (1 << shift))
            done = (b - a).sum(axis=1) >= enough
            low[open_[done]], high[open_[done]] = a[done], b[done]
            open_ = open_[~done]
            if not len(open_):
                break
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The distinct rows in one query's ranges."""
        hit = np.zeros(len(self._order), dtype=bool)
        for t in range(self._trees):
            hit[self._order[low[t] : high[t], t]] = True
        return np.flatnonzero(hit)


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, **forest
) -> pd.DataFrame:
    """The ``k`` nearest found in one shard for each query."""
    share = forest.pop("entry_share")
    index = Forest(vectors.astype(np.float64), **forest)
    wide = vectors.astype(np.float64)
    parts = []
    # Never fewer than a few times k, so that a small shard is searched whole.
    enough = max(share * len(ids), 8.0 * k)
    low, high = index.ranges(queries.astype(np.float64), enough)
    for i, (query_id, query) in enumerate(zip(query_ids, queries.astype(np.float64), strict=True)):
        rows = index.candidates(low[i], high[i])
        rows = rows[ids[rows] != query_id]
        # Row by row, so that equal vectors have equal scores to the last bit.
        scores = (wide[rows] * query).sum(axis=1)
        if len(rows) > k:
            edge = np.partition(scores, len(rows) - k)[len(rows) - k]
            near = scores >= edge
            rows, scores = rows[near], scores[near]
        top = np.lexsort((ids[rows], -scores))[:k]
        parts.append(
            pd.DataFrame({"query_id": query_id, "vec_id": ids[rows[top]], "score": scores[top]})
        )
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.concat([empty, *parts]).astype({"query_id": "int64", "vec_id": "int64"})


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    trees: int = TREES,
    bits: int = BITS,
    entry_share: float = ENTRY_SHARE,
    seed: int = 0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` nearest found for each query, ties to the
    smaller vec_id. Both frames have vec_id and embedding and are read several times.

    Null ids and vectors that are null, empty, zero or not finite take no part. A query does
    not find rows of its own id. Vectors are compared with those of equal length only. A
    repeated row counts once; an id with several vectors keeps all of them as candidates,
    and as a query has the smallest. Other columns are ignored; no rows, no result.
    """
    fit = takes_part(F.col("embedding")) & F.col("vec_id").isNotNull()
    columns = [F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>").alias("embedding")]
    rows = vectors.filter(fit).select(*columns).distinct()
    asked = queries.filter(fit).select(*columns).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    size = F.size("embedding").alias("_size")
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    rows = rows.select("*", size).withColumn("_block", every(blocks))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
    asked = asked.select("*", size).withColumn("_shard", every(shards))
    forest = {"trees": trees, "bits": bits, "entry_share": entry_share, "seed": seed}

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_shard(
            left["vec_id"].to_numpy(),
            np.stack(left["embedding"].to_numpy()),
            right["vec_id"].to_numpy(),
            np.stack(right["embedding"].to_numpy()),
            k,
            **forest,
        )

    keys = ["_shard", "_block", "_size"]
    found = (
        rows.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    # An id with several vectors is reported once, by its best one.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
