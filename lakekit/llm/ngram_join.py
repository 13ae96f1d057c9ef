"""Documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Documents with equal sets are folded into one class first, so copies are never paired.

**Meeting.** Shingles are hashed into groups. Two sets of at most ``hi`` shingles whose
similarity reaches the limit differ in at most ``(|A| + |B|) / 9 <= 2 hi / 9`` shingles, so
of more groups than that one at least holds the same shingles in both. Sets of like size
use the same number of groups; a set that may pair with the next sizes takes part there too.
Every group's content is a key, and classes with a key in common meet in a bucket. Empty
groups are left out: there are ``spare`` groups more than needed, so a linked pair has as
many common groups more, and a set with more empty groups than that gives keys for these
as well. A linked pair therefore shares ``1 + spare - empty`` keys, and each set may leave
out all but one of that many, the most common ones, by one order of all keys. No pair is
lost, and a passage that many documents share brings few of them together, as its shingles
mostly stand among others in their groups and what is left are the common keys.

**Bounding.** In a bucket every class is a point: its counts of shingles in ``DIMENSIONS``
groups. An R-tree holds the points; the overlap of two sets is at most the sum of the
smaller counts, and for a node the sum over its greatest counts, so whole subtrees fall away. For
pairs that the tree leaves the same sum over the parts of the groups, each split further, is a closer bound.

**Verifying.** Pairs that survive are verified with their sets.

Near copies meet in hundreds of buckets of nearly the same classes. Buckets with the same least
class are searched as one where that is less work, so a pair is found a few times, not in each.

For the groups alone, first every class is verified with one class of its buckets, the
one it shares most with, and again with another while that connects classes; then the trees
search only for pairs of classes not yet connected. A group of thousands of near copies costs
its size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.components import components
from lakekit.llm.encoding import HASHED_BYTES, blob_batches, slices, small_batches
from lakekit.llm.words import mix, shingle_sets
from lakekit.operators.lookup import join_lookup
from lakekit.session import stage

SHINGLE_WORDS = 5
# The limit as a fraction: linked when LIMIT[1] * intersection >= LIMIT[0] * union.
LIMIT = (4, 5)
DIMENSIONS = 64
# Each of these groups is split so often for a closer bound on the pairs that the tree leaves.
SPLIT = 4
NODE_ROWS = 16
# Classes of a bucket that one task holds; larger buckets are searched in pairs of blocks.
BLOCK_CLASSES = 2048
FLUSHED_KEYS = 2_000_000
# Classes are verified with one other of their buckets at most so many times before the search.
ROUNDS = 2
# So many of its cells a class names, the first by number: pairs it shares in none of them are given again.
NAMED_CELLS = 32
_CLASS_GROWTH = 1.5
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)

DOC_ROWS = "doc_id long, n long, cls long, point binary"
KEY_ROWS = "part int, blob binary"


def _size_classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The smallest size of each class of sizes, its number of groups, and the spare ones."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, int(least[-1] * _CLASS_GROWTH)))
    low = np.array(least, dtype=np.int64)
    # (|A| + |B|) (1 - limit) / (1 + limit), at most 2 hi / 9.
    a, b = LIMIT
    needed = 2 * (low[1:] - 1) * (b - a) // (b + a) + 1
    spare = needed // 5 + 4
    return low, needed + spare, spare


_LOW, _GROUPS, _SPARE = _size_classes()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on two ascending sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and LIMIT[1] * both >= LIMIT[0] * (len(a) + len(b) - both)


def group_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The keys under which sets meet, the set of each key, its class of sizes, and how many
    keys of that class the set must share to have a link."""
    own = np.searchsorted(_LOW, counts, side="right") - 1
    parts = []
    for step in (0, 1):
        size_class = own + step
        # The next class only where a set 1.25 times as large lies in it.
        takes = counts > 0
        if step:
            takes &= LIMIT[1] * counts >= LIMIT[0] * _LOW[size_class]
        keep = np.repeat(takes, counts)
        owner = np.repeat(np.arange(len(counts)), counts)[keep]
        keys, holders, need = _class_keys(hashes[keep], owner, size_class, np.flatnonzero(takes))
        parts.append((keys, holders, size_class[holders], need[holders]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _class_keys(hashes, owner, size_class, sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    groups = _GROUPS[size_class]
    # The group rises with the hash, so a group is a run of the ascending set.
    group = ((hashes >> np.uint64(32)) * groups[owner].astype(np.uint64)) >> np.uint64(32)
    begins = np.ones(len(hashes), dtype=bool)
    begins[1:] = (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(size_class), np.int64)
    content = np.add.reduceat(mix(hashes), starts)
    holder, place = owner[starts], group[starts]
    empty = groups - np.bincount(holder, minlength=len(size_class))
    need = np.maximum(1 + _SPARE[size_class] - empty, 1)
    salt = mix(size_class.astype(np.uint64) * _A + np.uint64(1))
    keys = mix(content ^ (mix(place * _B + np.uint64(3)) + salt[holder]))
    extra_keys, extra_holders = [keys], [holder]
    for i in sets[empty[sets] > _SPARE[size_class[sets]]]:
        missing = np.setdiff1d(np.arange(groups[i], dtype=np.uint64), place[holder == i])
        extra_keys.append(mix(mix(missing * _B + np.uint64(3)) + salt[i]))
        extra_holders.append(np.full(len(missing), i))
    return np.concatenate(extra_keys), np.concatenate(extra_holders), need


def set_ids(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One number for each set, equal for equal sets."""
    ends = np.concatenate([[0], np.cumsum(counts)])

    def total(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
        return sums[ends[1:]] - sums[ends[:-1]]

    size = mix(counts.astype(np.uint64) + _A)
    return mix(total(mix(hashes ^ _A)) ^ mix(total(mix(hashes ^ _B)) + size))


def count_vectors(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The points: how many shingles of each set fall into each part of the groups."""
    owner = np.repeat(np.arange(len(counts)), counts)
    cells = DIMENSIONS * SPLIT
    cell = owner * cells + (hashes >> np.uint64(56)).astype(np.int64)
    return np.bincount(cell, minlength=len(counts) * cells).reshape(-1, cells)


def coarse(points: np.ndarray) -> np.ndarray:
    """The counts in ``DIMENSIONS`` groups, which the tree goes by."""
    return points.reshape(len(points), DIMENSIONS, SPLIT).sum(axis=2)


# --- the R-tree ---------------------------------------------------------------


class CountTree:
    """Points in leaves of ``NODE_ROWS``, nodes with the greatest count of each group."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # Points of like size and like counts stand together.
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self._points, self._sizes = points[self.order], sizes[self.order]
        self._levels = []
        top, low, high = self._points, self._sizes, self._sizes
        while len(top) > 1:
            cuts = np.arange(0, len(top), NODE_ROWS)
            top = np.maximum.reduceat(top, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self._levels.append((top, low, high))

    def within(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose overlap with a set may be enough, by the bound and by size."""
        nodes = np.arange(len(self._levels[-1][0])) if self._levels else np.arange(len(self._points))
        for top, low, high in reversed(self._levels):
            fits = (low[nodes] * LIMIT[0] <= size * LIMIT[1]) & (high[nodes] * LIMIT[1] >= size * LIMIT[0])
            nodes = nodes[fits]
            bound = np.minimum(top[nodes], point).sum(axis=1)
            # The least overlap with the smallest set of the node.
            nodes = nodes[bound * (LIMIT[0] + LIMIT[1]) >= LIMIT[0] * (size + low[nodes])]
            nodes = (nodes[:, None] * NODE_ROWS + np.arange(NODE_ROWS)).ravel()
            below = self._below(top)
            nodes = nodes[nodes < below]
        bound = np.minimum(self._points[nodes], point).sum(axis=1)
        enough = bound * (LIMIT[0] + LIMIT[1]) >= LIMIT[0] * (size + self._sizes[nodes])
        return self.order[nodes[enough]]

    def _below(self, top: np.ndarray) -> int:
        """How many nodes or points the level below has."""
        at = next(i for i, level in enumerate(self._levels) if level[0] is top)
        return len(self._levels[at - 1][0]) if at else len(self._points)


# --- passes -------------------------------------------------------------------


def _described(docs: DataFrame) -> DataFrame:
    """Each document's number of shingles, class and point."""
    small_batches(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", HASHED_BYTES)):
            hashes, counts = shingle_sets(batch.column("text"), SHINGLE_WORDS)
            columns = [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(set_ids(hashes, counts).view(np.int64)),
                pa.array(_packed_points(count_vectors(hashes, counts)), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "cls", "point"])

    return docs.select("doc_id", "text").mapInArrow(describe, DOC_ROWS)


def _packed_points(points: np.ndarray) -> list[bytes]:
    """As few bytes a count as are enough."""
    most = points.max(axis=1, initial=0)
    kinds = np.where(most < 1 << 8, "<u1", np.where(most < 1 << 16, "<u2", "<u4")).tolist()
    return [p.astype(kind).tobytes() for p, kind in zip(points, kinds, strict=True)]


def _points(packed: list[bytes]) -> np.ndarray:
    cells = DIMENSIONS * SPLIT
    if all(len(p) == cells for p in packed):
        return np.frombuffer(b"".join(packed), "<u1").reshape(-1, cells).astype(np.int32)
    rows = [np.frombuffer(p, f"<u{len(p) // cells}") for p in packed]
    return np.stack(rows).astype(np.int64)


def _keys(docs: DataFrame, parts: int) -> DataFrame:
    """The keys of classes, packed by part."""
    small_batches(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, kept = [], 0
        for batch in (part for whole in batches for part in slices(whole, "text", HASHED_BYTES)):
            hashes, counts = shingle_sets(batch.column("text"), SHINGLE_WORDS)
            ids = set_ids(hashes, counts)
            # A copy within the task gives no keys again.
            fresh = np.array([not (i in seen or seen.add(i)) for i in ids.tolist()], dtype=bool)
            fresh &= counts > 0
            found, owner, size_class, need = group_keys(
                hashes[np.repeat(fresh, counts)], np.where(fresh, counts, 0)
            )
            held.append((found, ids[owner], size_class.astype(np.uint8), need.astype(np.uint32)))
            kept += len(found)
            if kept >= FLUSHED_KEYS:
                yield from blob_batches("part", "blob", _blobs(held, parts))
                kept = 0
        if kept:
            yield from blob_batches("part", "blob", _blobs(held, parts))

    return docs.select("text").mapInArrow(describe, KEY_ROWS)


_MEMBER = np.dtype([("cls", "<u8"), ("size_class", "u1"), ("need", "<u4")])


def _blobs(held: list[tuple], parts: int) -> Iterator[tuple[int, bytes]]:
    """Keys by the part that will compare them: classes once, then 6 bytes of each key, which
    the part completes well enough, and the place of its class. The held ones are given up."""
    keys, owners, size_class, need = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    part = (keys % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        rows = order[cuts[p] : cuts[p + 1]]
        # A class and its class of sizes in one number, as a set takes part in two.
        named = owners[rows] ^ mix(size_class[rows].astype(np.uint64) + _B)
        _, first, at = np.unique(named, return_index=True, return_inverse=True)
        members = np.empty(len(first), dtype=_MEMBER)
        members["cls"], members["size_class"] = owners[rows][first], size_class[rows][first]
        members["need"] = need[rows][first]
        head = np.array([len(members), len(rows)], dtype="<u4").tobytes()
        tail = (keys[rows] // np.uint64(parts)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        places = at.astype("<u2" if len(members) <= 1 << 16 else "<u4")
        yield int(p), head + members.tobytes() + tail.tobytes() + places.tobytes()


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the member of each."""
    n_members, n = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    members = np.frombuffer(blob, _MEMBER, n_members, 8)
    at = 8 + _MEMBER.itemsize * n_members
    keys = np.zeros((n, 8), dtype=np.uint8)
    keys[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at).reshape(n, 6)
    width = "<u2" if n_members <= 1 << 16 else "<u4"
    return keys.view("<u8").ravel(), members[np.frombuffer(blob, width, n, at + 6 * n)]


def _meetings(keys: DataFrame, parts: int) -> DataFrame:
    """``bucket, cls``: the classes that share a key. Keys shared by the same classes are one
    bucket, named by a hash of them; ``weight`` counts them."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (p, *_unblob(blob))
            for batch in batches
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist(), strict=True)
        ]
        for p in sorted({x[0] for x in found}):
            keys = np.concatenate([x[1] for x in found if x[0] == p])
            members = np.concatenate([x[2] for x in found if x[0] == p])
            order = np.lexsort((members["cls"], keys))
            keys, members = keys[order], members[order]
            classes = members["cls"]
            fresh = np.ones(len(keys), dtype=bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
            keys, members = keys[fresh], members[fresh]
            classes = members["cls"].astype(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
            sizes = np.diff(np.append(starts, len(keys))).astype(np.int64)
            if not len(sizes) or sizes.max() < 2:
                continue
            names = mix(classes ^ _A) + mix(members["size_class"] + _B)
            names = np.add.reduceat(names, starts) ^ np.add.reduceat(mix(classes ^ _B), starts)
            many = np.repeat(sizes > 1, sizes)
            rows = pd.DataFrame(
                {
                    "bucket": np.repeat(names, sizes)[many].view(np.int64),
                    "cls": classes[many].view(np.int64),
                    "size_class": members["size_class"][many].astype(np.int64),
                    "need": members["need"][many].astype(np.int64),
                }
            )
            keys_of = ["bucket", "cls", "size_class", "need"]
            rows = rows.groupby(keys_of, sort=False).size().rename("weight").reset_index()
            yield pa.RecordBatch.from_pandas(rows.astype("int64"), preserve_index=False)

    dealt = keys.select("part", "blob").repartition(parts, "part")
    rows = dealt.mapInArrow(meet, "bucket long, cls long, size_class long, need long, weight long")
    rows = rows.groupBy("bucket", "cls", "size_class", "need").agg(F.sum("weight").alias("weight"))
    rows = stage(rows, "keys_in_common")
    # A link of a set has ``need`` keys at least, so the rarest of them is not among the
    # ``need - 1`` most common keys of either side: these bring no pair together that the
    # others do not, and a set with fewer keys in all has no link.
    holders = rows.groupBy("bucket").agg(F.count("*").alias("_n"))
    common_first = Window.partitionBy("cls", "size_class").orderBy(F.desc("_n"), F.desc("bucket"))
    upto = F.sum("weight").over(common_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.join(holders, "bucket").withColumn("_upto", upto).filter("_upto >= need")
    rows = stage(rows.select("bucket", "cls", "weight"), "rarer_keys")
    several = rows.groupBy("bucket").agg(F.count("*").alias("_n")).filter("_n > 1").select("bucket")
    return rows.join(several, "bucket")


def _sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``cls, shingles`` of some classes, from the text of one document each. The document is
    found by its id; among rows of one id the class tells them apart."""
    small_batches(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", HASHED_BYTES)):
            hashes, counts = shingle_sets(batch.column("text"), SHINGLE_WORDS)
            ids = set_ids(hashes, counts).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            sets = [hashes[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(sets, pa.binary())], names=["cls", "shingles"]
            )

    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    # Rows without an id may hold a class of their own: all of these are looked at.
    chosen = join_lookup(texts, classes.select("rep").distinct(), ["rep"], "left_semi")
    chosen = chosen.select("text").union(texts.filter("rep IS NULL").select("text"))
    sets = chosen.mapInArrow(describe, "cls long, shingles binary")
    return join_lookup(sets, classes.select("cls"), ["cls"], "left_semi").dropDuplicates(["cls"])


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes and points allow a link."""
    for side in ("a", "b"):
        own = classes.select(
            F.col("cls").alias(side), F.col("size").alias(f"_size_{side}"), F.col("point").alias(f"_point_{side}")
        )
        pairs = pairs.join(own, side)
    small, large = F.least("_size_a", "_size_b"), F.greatest("_size_a", "_size_b")
    pairs = pairs.filter(small * LIMIT[1] >= large * LIMIT[0])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (_points(batch.column(f"_point_{s}").to_pylist()) for s in ("a", "b"))
            total = np.asarray(batch.column("_size_a")) + np.asarray(batch.column("_size_b"))
            bound = np.minimum(left, right).sum(axis=1)
            good = bound * (LIMIT[0] + LIMIT[1]) >= LIMIT[0] * total
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.mapInArrow(check, "a long, b long")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are linked, by the sets of their documents."""
    pairs = stage(pairs.select("a", "b").distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = stage(_sets(docs, stage(classes.join(ends, "cls").select("cls", "rep"), "ends")), "sets")
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("_b"))
    joined = pairs.join(left, "a").join(right, "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("_a"), batch.column("_b"), strict=True)
            good = [
                linked(*(np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in pair)) for pair in sides
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return stage(joined.mapInArrow(check, "a long, b long"), "links")


def _cells(meetings: DataFrame, buckets: DataFrame) -> DataFrame:
    """What the trees search: ``whole, cell, _n, cls, comp``. A cell is a bucket, or all buckets of
    one least class (``whole``), if the pairs of their classes are no more than those of the buckets.

    ``buckets`` has bucket, ``_n`` and ``least``."""
    rows = meetings.join(buckets, "bucket")
    merged = rows.groupBy("least", "cls").agg(F.min("comp").alias("comp"))
    work = buckets.groupBy("least").agg(F.sum(F.col("_n") * F.col("_n")).alias("_work"))
    fewer = merged.groupBy("least").agg(F.count("*").alias("_n")).join(work, "least")
    fewer = stage(fewer.filter("_n * _n <= _work").select("least", "_n"), "merged_buckets")
    whole = merged.join(fewer, "least").selectExpr("true AS whole", "least AS cell", "_n", "cls", "comp")
    apart = rows.join(fewer.select("least"), "least", "left_anti")
    return whole.union(apart.selectExpr("false AS whole", "bucket AS cell", "_n", "cls", "comp"))


def _searched(meetings: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes of different components that share a bucket and pass the bounds, and
    others that pass them. ``meetings`` has bucket, cls and comp; it is read several times."""
    counts = meetings.groupBy("bucket").agg(
        F.count("*").alias("_n"), F.min("cls").alias("a"), F.max("cls").alias("b")
    )
    # Two classes are a pair as they are; more are searched with a tree.
    pairs = _bounded(counts.filter("_n = 2").select("a", "b").distinct(), classes)
    rows = _cells(meetings, counts.filter("_n > 2").select("bucket", "_n", F.col("a").alias("least")))
    rows = rows.withColumn("place", F.xxhash64("whole", "cell"))
    places = F.slice(F.array_sort(F.collect_list("place")), 1, NAMED_CELLS)
    rows = rows.join(rows.groupBy("cls").agg(places.alias("places")), "cls")
    rows = rows.join(classes.select("cls", "size", "point"), "cls")
    blocks = F.ceil(F.col("_n") / BLOCK_CLASSES)
    rows = rows.withColumn("_blocks", blocks)
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("cls"), F.col("_blocks")))
    # A row meets every block of its cell, as the smaller or the larger one.
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    rows = rows.withColumns(
        {"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}
    ).select("whole", "cell", "_i", "_j", "_own", "cls", "comp", "size", "point", "place", "places")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        points = _points(rows["point"].tolist())
        size, comp, cls = (rows[c].to_numpy() for c in ("size", "comp", "cls"))
        own = rows["_own"].to_numpy()
        across = rows["_i"].iat[0] != rows["_j"].iat[0]
        # The named cells before this one; the cell itself, which is left out, fills the rows.
        place, named = rows["place"].iat[0], rows["places"].tolist()
        earlier = np.full((len(rows), NAMED_CELLS), place)
        for i, places in enumerate(named):
            earlier[i, : len(places)] = np.minimum(places, place)
        tops = coarse(points)
        tree = CountTree(tops, size)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(len(rows)):
            near = tree.within(tops[i], size[i])
            near = near[(cls[near] > cls[i]) & (comp[near] != comp[i])]
            if across:
                near = near[own[near] != own[i]]
            # The closer bound, over all parts of the groups.
            bound = np.minimum(points[near], points[i]).sum(axis=1)
            near = near[bound * (LIMIT[0] + LIMIT[1]) >= LIMIT[0] * (size[i] + size[near])]
            before = earlier[i][earlier[i] < place]
            if len(before) and len(near):
                near = near[~np.isin(earlier[near], before).any(axis=1)]
            a.append(np.full(len(near), cls[i]))
            b.append(cls[near])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    found = rows.groupBy("whole", "cell", "_i", "_j").applyInPandas(search, "a long, b long")
    return pairs.union(found)


def _prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, the classes and the meetings."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = stage(_described(docs), "shingles")
    classes = members.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("size"), F.min("point").alias("point")
    )
    meetings = stage(_meetings(_keys(docs, parts), parts), "meetings")
    return members, stage(classes, "classes"), meetings


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, ``a, b`` by class, and ``doc_id, n, cls`` of the
    documents. Copies share a class and are not paired."""
    members, classes, meetings = _prepared(docs)
    pairs = _searched(meetings.select("bucket", "cls", F.col("cls").alias("comp")), classes)
    return _verified(docs, pairs, classes), members.select("doc_id", "n", "cls")


def _partners(meetings: DataFrame, turn: int) -> DataFrame:
    """``a, b``: each class with one other, of another component. Every bucket names one of its
    classes, in every turn by another order; of those that a class meets it takes the one it has most keys
    in common with."""
    order = F.xxhash64("cls", F.lit(turn)) if turn else F.col("cls")
    named = meetings.groupBy("bucket").agg(F.min_by(F.struct("cls", "comp"), F.struct(order, "cls")).alias("_b"))
    pairs = meetings.join(named, "bucket").filter("comp <> _b.comp")
    pairs = pairs.groupBy("cls", F.col("_b.cls").alias("b")).agg(F.sum("weight").alias("_w"))
    best = pairs.groupBy("cls").agg(F.max_by("b", F.struct("_w", "b")).alias("b"))
    return best.select(F.least("cls", "b").alias("a"), F.greatest("cls", "b").alias("b"))


def _open_meetings(meetings: DataFrame, links: DataFrame) -> DataFrame:
    """``bucket, cls, weight, comp`` of the buckets that hold several components."""
    found = components(links).select(F.col("vertex").alias("cls"), F.col("component").alias("_c"))
    known = meetings.join(found, "cls", "left")
    known = known.select("bucket", "cls", "weight", F.coalesce("_c", "cls").alias("comp"))
    mixed = known.groupBy("bucket").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y"))
    return stage(known.join(mixed.filter("_x <> _y").select("bucket"), "bucket"), "open_meetings")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``: for each document the smallest doc_id that links
    reach, itself included.

    ``docs`` has doc_id and text; other columns are ignored. Null, empty and blank texts have
    no shingles and stand alone; a text of fewer words than a shingle is one shingle.
    Repeated rows are separate documents of one class; those of one id with different
    texts are in their own classes. A null doc_id is never the smallest; alone it
    stays null.
    """
    members, classes, meetings = _prepared(docs)
    open_, found = meetings.withColumn("comp", F.col("cls")), []
    for turn in range(ROUNDS):
        found.append(_verified(docs, _bounded(_partners(open_, turn), classes), classes))
        if turn and found[-1].isEmpty():
            break
        links = reduce(DataFrame.union, found)
        open_ = _open_meetings(open_.drop("comp"), links)
    # Then, in buckets that still hold several components, what lies between these.
    links = links.union(_verified(docs, _searched(open_, classes), classes))
    found = components(links).select(F.col("vertex").alias("cls"), F.col("component").alias("_c"))
    named = classes.join(found, "cls", "left").withColumn("_c", F.coalesce("_c", "cls"))
    least = named.groupBy("_c").agg(F.min("rep").alias("_least"))
    ids = named.join(least, "_c").select("cls", "_least")
    alone = members.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    joined = members.filter("n > 0").join(ids, "cls")
    joined = joined.select("doc_id", "n", F.col("_least").alias("component_id"))
    return joined.unionByName(alone).withColumnRenamed("n", "n_shingles")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one document of each group: the one with the smallest id stays.

    Of repeated rows with one id and text one stays; different texts under one id that is
    the smallest of their groups all stay. Texts without words are linked with nothing
    and stay, as do those in a group without any id.
    """
    groups = jaccard_groups(docs.select("doc_id", "text"))
    kept = groups.filter("component_id IS NULL OR doc_id = component_id")
    kept = kept.groupBy("doc_id").agg(F.count("*").alias("_rows")).withColumnRenamed("doc_id", "_kept")
    kept = stage(kept, "kept_ids")

    def rows_of(ids: DataFrame) -> DataFrame:
        return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")

    if kept.filter("_rows > 1").isEmpty():
        return rows_of(kept)
    again = rows_of(kept.filter("_rows > 1"))
    spoken = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = again.filter(spoken & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    rest = again.filter(~(spoken & F.col("doc_id").isNotNull()))
    return rows_of(kept.filter("_rows = 1")).unionByName(once).unionByName(rest)
