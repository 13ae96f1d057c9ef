"""Hard negatives by threshold joins over pruned inverted indexes.

An anchor's positives are the rows of its label that score highest with it; a positive's hard negatives are
the highest scores of other labels within a window below the positive's own. Both are
threshold joins: all rows whose inner product with the anchor reaches a bound. The bound
starts high and is lowered, for the anchors that still need it, until their windows are full or
it has reached the window's lower end.

The join of a block of rows and a block of anchors follows L2AP. The index holds a list per dimension, but leaves out
of a row the dimensions at its end whose norm times the largest anchor's cannot reach the bound: what they add
is covered by that product. Scores are accumulated list by list; a pair is dropped
when its partial score and the product of both remaining norms stay below the bound, and what is left is
scored exactly in whole numbers.

Rows are dealt into blocks of bounded size by a hash of their id, so no label or repeated vector makes a
large task, and each block of anchors meets each block of rows (for positives, of its label). A block
hands on the best few of each window, no more than the result can hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.session import stage

BLOCK_ROWS = 8192
BLOCK_ANCHORS = 1024
# Dimensions that are accumulated between two rounds of pruning.
LISTS_AT_ONCE = 8
# The first bound, in products of norms, and what it is multiplied by when windows stay open.
FIRST_BOUND, LOWERED = 0.6, 0.8
# Rounding of norms and of partial scores, as a share of the product of norms.
SLACK = 1e-9
# Components are whole numbers of at most this size, so that scores of up to 4,096 dimensions fit 63 bits.
LARGEST = 1 << 25


class Index:
    """Inverted lists over a block of rows, dimension by dimension in the order of ``dims``."""

    def __init__(self, rows: np.ndarray, dims: np.ndarray):
        self.rows = rows
        self.wide = rows[:, dims].astype(np.float64)
        self.left = _remaining(self.wide)

    def over(self, bound: float, largest: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows by descending number of indexed dimensions, and these numbers.

        A dimension is left out with all behind it if their norm times ``largest`` is below ``bound``.
        """
        kept = (self.left[:, :-1] * largest * (1 + SLACK) >= bound).sum(axis=1)
        order = np.argsort(-kept, kind="stable")
        return order, kept[order]


def _remaining(wide: np.ndarray) -> np.ndarray:
    """The norm of each row from each dimension on, 0 behind the last."""
    squares = np.zeros((len(wide), wide.shape[1] + 1))
    squares[:, :-1] = np.cumsum((wide * wide)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(squares)


def reaching(
    index: Index, anchors: np.ndarray, bounds: np.ndarray, dims: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row, score) allowed together whose score reaches the anchor's bound."""
    wide = anchors[:, dims].astype(np.float64)
    left = _remaining(wide)
    order, kept = index.over(float(bounds.min()), float(left[:, 0].max()))
    ends = np.searchsorted(-kept, -np.arange(wide.shape[1]), side="left")  # rows that a list holds
    live = int(ends[0]) if len(ends) else 0
    order = order[:live]
    score = np.zeros((len(wide), live))
    alive = allowed[:, order].copy()
    rows, norms = index.wide[order], index.left[order]
    at = 0
    a = r = part = None
    while at < wide.shape[1]:
        upto = min(at + LISTS_AT_ONCE, wide.shape[1])
        if a is None:
            for d in range(at, upto):
                # The list of a dimension is a prefix of the rows in this order.
                score[:, : ends[d]] += wide[:, d, None] * rows[: ends[d], d]
            # What a row has left is all that its lists do not hold, and the lists to come.
            reach = norms[np.arange(live), np.minimum(upto, kept[:live])]
            rest = left[:, upto, None] * reach
            short = kept[:live] < upto
            if short.any():
                rest[:, short] = left[:, kept[:live][short]] * reach[short]
            alive &= score + rest + SLACK * left[:, :1] * norms[:, 0] >= bounds[:, None]
            if alive.sum() * 8 < alive.size:
                a, r = np.nonzero(alive)
                part = score[a, r]
        else:
            part += (wide[a, at:upto] * np.where(np.arange(at, upto) < kept[r, None], rows[r, at:upto], 0.0)).sum(axis=1)
            till = np.minimum(upto, kept[r])
            rest = left[a, till] * norms[r, till]
            fit = part + rest + SLACK * left[a, 0] * norms[r, 0] >= bounds[a]
            a, r, part = a[fit], r[fit], part[fit]
        at = upto
    if a is None:
        a, r = np.nonzero(alive)
    exact = np.empty(len(a), dtype=np.int64)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        exact[s] = (anchors[a[s]] * index.rows[order[r[s]]]).sum(axis=1)
    hit = exact >= bounds[a]
    return a[hit], order[r[hit]], exact[hit]


def _best(a: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of each ``a``, ties to the smaller id."""
    order = np.lexsort((ids, -score, a))
    first = np.searchsorted(a[order], a[order])
    return order[np.arange(len(order)) - first < k]


def lowering(
    index: Index, anchors: np.ndarray, floor: np.ndarray, start: np.ndarray, allowed: np.ndarray, dims: np.ndarray,
    full: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs for each anchor at the first bound at which its windows are ``full``, or at its floor.

    ``start`` is the first bound. Scores may be negative: a bound that has come close to zero goes
    to the floor at once, and a floor of minus infinity takes all rows.
    """
    open_ = np.arange(len(anchors))
    bounds = np.maximum(start, floor)
    while len(open_):
        a, r, score = reaching(index, anchors[open_], bounds[open_], dims, allowed[open_])
        done = (bounds[open_] <= floor[open_]) | full(open_, a, r, score)
        hit = done[a]
        yield open_[a[hit]], r[hit], score[hit]
        open_ = open_[~done]
        lower = np.where(bounds[open_] * LOWERED < 1, -np.inf, np.floor(bounds[open_] * LOWERED))
        bounds[open_] = np.maximum(lower, floor[open_])


def _positives_of(rows: pd.DataFrame, anchors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` rows for each anchor, both of one label."""
    x, q = np.stack(rows["v"].to_numpy()), np.stack(anchors["v"].to_numpy())
    ids, own = rows["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
    dims = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    index = Index(x, dims)
    allowed = ids != own[:, None]

    def full(which, a, r, score):
        return np.bincount(a, minlength=len(which)) >= np.minimum(k, allowed[which].sum(axis=1))

    start = np.floor(FIRST_BOUND * _norms(q) * index.left[:, 0].max())
    floor = np.full(len(q), -np.inf)
    out = []
    for a, r, score in lowering(index, q, floor, start, allowed, dims, full):
        best = _best(a, ids[r], score, k)
        out.append(pd.DataFrame({"anchor_id": own[a[best]], "positive_id": ids[r[best]], "positive_score": score[best]}))
    return pd.concat(out) if out else _none(["anchor_id", "positive_id", "positive_score"])


def _negatives_of(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """The best ``k`` rows of other labels in the window of each anchor and positive."""
    x, q = np.stack(rows["v"].to_numpy()), np.stack(anchors["v"].to_numpy())
    ids, own = rows["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
    sizes = anchors["positives"].map(len).to_numpy()
    owner = np.repeat(np.arange(len(q)), sizes)
    listed = [p for positives in anchors["positives"] for p in positives]
    positive = np.array([p["positive_id"] for p in listed], dtype=np.int64)
    top = np.array([p["positive_score"] for p in listed], dtype=np.int64)
    bottom = -(-top * low // 100)
    ceiling = top * high // 100
    firsts = np.cumsum(sizes) - sizes
    dims = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    index = Index(x, dims)
    allowed = rows["label"].to_numpy() != anchors["label"].to_numpy()[:, None]
    floor = np.minimum.reduceat(bottom, firsts).astype(np.float64)

    def windows(a, r, score):
        """Each found pair once for each of its anchor's windows that it lies in."""
        times = sizes[a]
        pair = np.repeat(np.arange(len(a)), times)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times) + firsts[a][pair]
        inside = (score[pair] >= bottom[place]) & (score[pair] <= ceiling[place])
        return place[inside], pair[inside]

    def full(which, a, r, score):
        place, _ = windows(which[a], r, score)
        filled = np.bincount(place, minlength=len(owner)) >= k
        return np.logical_and.reduceat(filled, firsts)[which]

    # The lowest window's upper end: above it no row can fill that window.
    start = np.minimum.reduceat(top, firsts).astype(np.float64) * (1 + LOWERED) / 2
    out = []
    for a, r, score in lowering(index, q, floor, np.floor(start), allowed, dims, full):
        place, pair = windows(a, r, score)
        best = _best(place, ids[r[pair]], score[pair], k)
        place, pair = place[best], pair[best]
        out.append(
            pd.DataFrame(
                {
                    "anchor_id": own[owner[place]],
                    "positive_id": positive[place],
                    "positive_score": top[place],
                    "negative_id": ids[r[pair]],
                    "negative_score": score[pair],
                }
            )
        )
    return pd.concat(out) if out else _none(
        ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    )


def _norms(q: np.ndarray) -> np.ndarray:
    return np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))


def _none(columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], task: Callable, schema: str) -> DataFrame:
    """``task`` on each pair of blocks with equal ``keys``."""

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return task(left, right, True)
        return task(left, right, False)

    return rows.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInPandas(both, schema)


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _dealt(key: str, n: Column | int, salt: int) -> Column:
    blocks = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.xxhash64(key, F.lit(salt)), blocks).cast("int")


def _every(n: Column | int) -> Column:
    blocks = F.lit(n) if isinstance(n, int) else n
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has vec_id, label and embedding; ``anchors`` is a condition on vec_id. Components
    become ``floor(scale * x)``, a score is the integer inner product, and higher scores come first,
    ties by smaller vec_id. The anchor's first ``positives`` other rows of its label (all, if fewer) each
    get the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows with a null id or label, a null or empty vector, a null or non-finite component, or one whose
    scaled size exceeds ``LARGEST`` take no part. A repeated row counts once; of an id with different
    rows the smallest (label, then vector) counts. Vectors meet those of equal length only. Pairs
    without a negative give no row, and no rows give none. Other columns are ignored.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= LARGEST)
    )
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & sound
    rows = vectors.filter(fit).select(
        F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), whole.cast("array<long>").alias("v")).alias("_row")
    )
    rows = rows.groupBy("vec_id").agg(F.min("_row").alias("_row"))
    rows = stage(rows.select("vec_id", "_row.label", "_row.v", F.size("_row.v").alias("size")), "whole-vectors")
    asked = stage(rows.filter(anchors), "anchors")

    # Positives: blocks of one label, as many as it has rows for.
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("_rows"))
    asked_sizes = asked.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).cast("int").alias("_asked"))
    sizes = sizes.join(asked_sizes, "label")
    keys = ["label", "size", "_block", "_part"]
    members = rows.join(sizes, "label").withColumn("_block", _dealt("vec_id", F.col("_rows"), 1))
    members = members.withColumn("_part", _every(F.col("_asked"))).select(*keys, "vec_id", "v")
    searching = asked.join(sizes, "label").withColumn("_part", _dealt("vec_id", F.col("_asked"), 2))
    searching = searching.withColumn("_block", _every(F.col("_rows"))).select(*keys, "vec_id", "v")

    def find_positives(left: pd.DataFrame, right: pd.DataFrame, none: bool) -> pd.DataFrame:
        if none:
            return _none(["anchor_id", "positive_id", "positive_score"])
        return _positives_of(left, right, positives)

    found = _met(members, searching, keys, find_positives, "anchor_id long, positive_id long, positive_score long")
    place = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= positives)
    # Below zero the window is empty, whatever the rows.
    found = found.filter("positive_score >= 0").groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    searching = stage(asked.withColumnRenamed("vec_id", "anchor_id").join(found, "anchor_id"), "anchor-windows")

    # Negatives: every block of rows.
    blocks, parts = _blocks(rows.count(), BLOCK_ROWS), _blocks(searching.count(), BLOCK_ANCHORS)
    keys = ["size", "_block", "_part"]
    members = rows.withColumn("_block", _dealt("vec_id", blocks, 3)).withColumn("_part", _every(parts))
    searching = searching.withColumn("_part", _dealt("anchor_id", parts, 4)).withColumn("_block", _every(blocks))
    searching = searching.withColumnRenamed("anchor_id", "vec_id")
    columns = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def find_negatives(left: pd.DataFrame, right: pd.DataFrame, none: bool) -> pd.DataFrame:
        return _none(columns) if none else _negatives_of(left, right, negatives, low, high)

    mined = _met(
        members.select(*keys, "vec_id", "label", "v"),
        searching.select(*keys, "vec_id", "label", "v", "positives"),
        keys,
        find_negatives,
        ", ".join(f"{c} long" for c in columns),
    )
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
