"""Near copies among vectors, by passes over sorted random projections.

A vector's sketch is the sides of random planes on which it lies, a bit each. A pass orders all vectors
lexicographically by their sketches with the bits in an order of the pass's own, and
compares each with a bounded window of its next neighbours. Vectors whose sketches differ in few
enough bits are candidates, are verified by their cosine, and the links of all
passes are united. How many passes there are follows from the number of vectors, so that
the share of links found stays the same: a pass finds a pair at the threshold if
they share the bits that set a window's worth of vectors apart.

Only sketches travel through the passes. Equal vectors are one class and take part once.
In a dense group a window holds a part of a vector's links only. The rest is exact: inside a
component vectors close enough to one centre are all linked with each other, by the
triangle inequality of angles, and are counted without being paired; what
lies further out is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.ann import takes_part
from lakekit.llm.components import components
from lakekit.session import stage

COSINE = 0.95
SKETCH_BYTES = 32
WINDOW = 32
# The share of pairs right at the threshold that all passes together are to find.
FOUND = 0.98
# Pairs at the threshold whose sketches differ more than others do: in so many deviations.
SPREAD = 4.0
ROWS_A_PART = 50_000
# A component with more vectors away from its centres than this gets a further centre.
LOOSE = 128
COMPARED = 4096


def bit_share(cosine: float) -> float:
    """The probability that a random plane parts two vectors."""
    return math.acos(max(-1.0, min(1.0, cosine))) / math.pi


def passes_for(n: int, cosine: float, window: int = WINDOW, found: float = FOUND) -> int:
    """Passes after which a pair at ``cosine`` has been neighbours with probability ``found``."""
    bits = max(math.log2(max(n, 2) / window), 0.0)
    once = (1 - bit_share(cosine)) ** bits
    return 1 if once >= found else math.ceil(math.log(1 - found) / math.log(1 - once))


def farthest(cosine: float, bits: int) -> int:
    """So many bits may differ between the sketches of a pair at ``cosine``."""
    p = bit_share(cosine)
    return math.ceil(bits * p + SPREAD * math.sqrt(bits * p * (1 - p)))


def unit_scaled(vectors: np.ndarray) -> np.ndarray:
    """Doubles scaled by a power of two per row, which no product of two overflows."""
    wide = vectors.astype(np.float64)
    most = np.abs(wide).max(axis=1, initial=0.0)
    return np.ldexp(wide, -np.frexp(np.where(most > 0, most, 1.0))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, so that a pair's cosine does not depend on the batch it comes in."""
    a, b = unit_scaled(a), unit_scaled(b)
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / norms


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal vector length, and their vectors."""
    lengths = np.asarray(column.value_lengths())
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, _matrix(column.take(pa.array(rows)))


def sketched(vectors: DataFrame, seed: int) -> DataFrame:
    """``vec_id, same, size, sketch, embedding``; ``same`` is a 128-bit hash of the vector."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            out = np.zeros((batch.num_rows, SKETCH_BYTES), dtype=np.uint8)
            for rows, part in _by_length(batch.column("embedding")):
                if part.shape[1] not in planes:
                    draw = np.random.default_rng([seed, part.shape[1]])
                    planes[part.shape[1]] = draw.standard_normal((part.shape[1], SKETCH_BYTES * 8))
                sides = unit_scaled(part) @ planes[part.shape[1]] > 0
                out[rows] = np.packbits(sides, axis=1)
            fixed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(SKETCH_BYTES), len(out), [None, pa.py_buffer(out.tobytes())]
            )
            columns = [*batch.columns, fixed.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sketch"])

    same = F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(seed), "embedding"))
    rows = vectors.select("vec_id", same.alias("same"), F.size("embedding").alias("size"), "embedding")
    kind = vectors.schema["embedding"].dataType.simpleString()
    pair = rows.schema["same"].dataType.simpleString()
    return rows.mapInArrow(
        sketch, f"vec_id long, same {pair}, size int, embedding {kind}, sketch binary"
    )


def _orders(passes: int, seed: int) -> np.ndarray:
    """The order of the bits in each pass: whole permutations, each leading with other bits."""
    bits = SKETCH_BYTES * 8
    draw = np.random.default_rng([seed, 1])
    first = draw.permutation(bits)
    step = max(1, bits // passes)
    return np.stack([np.roll(first, -step * i) if i * step < bits else draw.permutation(bits) for i in range(passes)])


def _keyed(reps: DataFrame, passes: int, seed: int) -> DataFrame:
    """One row for each vector and pass, with the sketch in the pass's order of bits."""
    orders = _orders(passes, seed)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8)
            bits = np.unpackbits(raw.reshape(batch.num_rows, SKETCH_BYTES), axis=1)
            for number, order in enumerate(orders):
                packed = np.packbits(bits[:, order], axis=1).tobytes()
                keys = [packed[i : i + SKETCH_BYTES] for i in range(0, len(packed), SKETCH_BYTES)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(batch.num_rows, number, np.int32)),
                        batch.column("size"),
                        pa.array(keys, pa.binary()),
                        batch.column("vec_id"),
                    ],
                    names=["pass", "size", "key", "vec_id"],
                )

    return reps.select("size", "sketch", "vec_id").mapInArrow(key, "pass int, size int, key binary, vec_id long")


def _near(ids: np.ndarray, group: np.ndarray, keys: np.ndarray, window: int, most: int) -> tuple:
    """Pairs of rows at most ``window`` apart, of one pass and size, whose sketches are near."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for apart in range(1, min(window, len(ids) - 1) + 1):
        differing = np.bitwise_count(keys[:-apart] ^ keys[apart:]).sum(axis=1)
        hit = (differing <= most) & (group[:-apart] == group[apart:]).all(axis=1)
        rows = np.flatnonzero(hit)
        a.append(ids[rows])
        b.append(ids[rows + apart])
    return np.concatenate(a), np.concatenate(b)


_SCANNED = "a long, b long, border int, place int, pass int, size int, key binary"


def _windows(keyed: DataFrame, parts: int, window: int, most: int) -> DataFrame:
    """Candidate pairs of all passes.

    All passes are one sort by range; every task compares its own rows and hands on its first and
    last window of rows, which are compared across the border in a second step. A task with
    fewer rows than a window hands on all it has.
    """
    order = ["pass", "size", "key", "vec_id"]
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def frame(rows: pd.DataFrame) -> tuple:
        keys = np.frombuffer(b"".join(rows["key"]), dtype=np.uint64).reshape(len(rows), -1)
        return rows["vec_id"].to_numpy(), rows[["pass", "size"]].to_numpy(), keys

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, tail, head = TaskContext.get().partitionId(), None, []
        for batch in (b for b in batches if len(b)):
            missing = window - sum(map(len, head))
            if missing > 0:
                head.append(batch.head(missing))
            # The rows carried over have met each other; pairs found again fall away later.
            rows = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            a, b = _near(*frame(rows), window, most)
            yield pd.DataFrame({"a": a, "b": b})
            tail = rows.tail(window)
        if tail is not None:
            yield _handed(pd.concat(head), part - 1)
            yield _handed(tail, part)

    def _handed(rows: pd.DataFrame, border: int) -> pd.DataFrame:
        return rows.assign(a=rows["vec_id"], border=border, place=range(len(rows)))

    columns = ["a", "b", "border", "place", "pass", "size", "key"]

    def typed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in scan(frames):
            out = out.reindex(columns=columns)
            yield out.astype({c: "Int64" for c in columns if c != "key"})

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.rename(columns={"a": "vec_id"}).sort_values(order[:-1] + ["vec_id"], ignore_index=True)
        a, b = _near(*frame(rows), window, most)
        return pd.DataFrame({"a": a, "b": b})

    scanned = stage(ranged.mapInPandas(typed, _SCANNED), "projection-pass")
    across = scanned.filter("border IS NOT NULL").groupBy("border").applyInPandas(meet, "a long, b long")
    inside = scanned.filter("border IS NULL").select("a", "b")
    pairs = inside.union(across).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _compared(pairs: DataFrame, kept: list[str]) -> DataFrame:
    """``pairs`` with the cosine of their columns ``u`` and ``v``, in place of these."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, COMPARED) for i in range(0, whole.num_rows, COMPARED)):
                out = np.zeros(batch.num_rows)
                for rows, u in _by_length(batch.column("u")):
                    out[rows] = cosines(u, _matrix(batch.column("v").take(pa.array(rows))))
                columns = [*(batch.column(c) for c in kept), pa.array(out)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "cosine"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*kept).schema)
    return pairs.select(*kept, "u", "v").mapInArrow(compare, f"{fields}, cosine double")


def _with_vector(df: DataFrame, vectors: DataFrame, key: str, name: str) -> DataFrame:
    named = vectors.select(F.col("vec_id").alias(key), F.col("embedding").alias(name))
    return df.join(named, key)


def _balls(members: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """``vec_id, component, n, centre``: each vector of a component with the centre it is so close to
    that all of that centre's vectors are linked; alone under its own id where there is none."""
    # Half the angle, less what rounding could take.
    tight = math.cos(math.acos(cosine) / 2 - 1e-7)
    state = members.withColumn("centre", F.lit(None).cast("long"))
    least, first = 0, True
    while True:
        free = state.filter("centre IS NULL")
        centres = free.groupBy("component").agg(F.min("vec_id").alias("c"), F.count("*").alias("left"))
        centres = centres.filter(F.col("left") > least).select("component", "c")
        if not first and centres.isEmpty():
            break
        pairs = free.join(centres, "component")
        pairs = _with_vector(_with_vector(pairs, vectors, "vec_id", "u"), vectors, "c", "v")
        near = _compared(pairs, ["vec_id", "c"]).filter((F.col("cosine") >= tight) | (F.col("vec_id") == F.col("c")))
        joined = state.join(near.select("vec_id", F.col("c").alias("_c")), "vec_id", "left")
        state = stage(
            joined.select("vec_id", "component", "n", F.coalesce("centre", "_c").alias("centre")), "balls"
        )
        least, first = LOOSE, False
    return state.withColumn("centre", F.coalesce("centre", "vec_id"))


def _other_balls(balls: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """``vec_id, linked``: the vectors outside its own ball that a vector is linked with, copies counted."""
    half, whole = math.acos(cosine) / 2, math.acos(cosine)
    sizes = balls.groupBy("component", "centre").agg(F.sum("n").alias("n"), F.count("*").alias("members"))
    left = sizes.select("component", F.col("centre").alias("a"), F.col("members").alias("ma"))
    right = sizes.select("component", F.col("centre").alias("b"), F.col("n").alias("nb"), F.col("members").alias("mb"))
    pairs = left.join(right, "component").filter("a <> b")
    with_vectors = _with_vector(_with_vector(pairs, vectors, "a", "u"), vectors, "b", "v")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cosine"))))
    reach = F.when(F.col("ma") > 1, half).otherwise(0.0) + F.when(F.col("mb") > 1, half).otherwise(0.0)
    judged = _compared(with_vectors, ["a", "b", "nb", "ma", "mb"]).withColumns({"_angle": angle, "_reach": reach})
    alone = (F.col("ma") == 1) & (F.col("mb") == 1)
    judged = stage(
        judged.withColumn(
            "verdict",
            F.when(alone, F.when(F.col("cosine") >= cosine, 1).otherwise(0))
            .when(F.col("_angle") - F.col("_reach") > whole + 1e-7, 0)
            .when(F.col("_angle") + F.col("_reach") < whole - 1e-7, 1),
        ).filter("verdict IS NULL OR verdict = 1"),
        "ball-pairs",
    )
    member = balls.select("vec_id", F.col("centre").alias("a"))
    all_of = member.join(judged.filter("verdict = 1").select("a", "nb"), "a").select("vec_id", F.col("nb").alias("linked"))
    other = balls.select(F.col("vec_id").alias("w"), F.col("centre").alias("b"), "n")
    single = member.join(judged.filter("verdict IS NULL").select("a", "b"), "a").join(other, "b")
    single = _with_vector(_with_vector(single, vectors, "vec_id", "u"), vectors, "w", "v")
    found = _compared(single, ["vec_id", "n"]).filter(F.col("cosine") >= cosine)
    linked = all_of.union(found.select("vec_id", F.col("n").alias("linked")))
    return linked.groupBy("vec_id").agg(F.sum("linked").alias("linked"))


def near_copies(
    vectors: DataFrame,
    *,
    cosine: float = COSINE,
    window: int = WINDOW,
    found: float = FOUND,
    passes: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Two vectors are linked when their cosine, in double precision, is at least ``cosine``;
    ``found`` is the share of pairs right at that bound which the passes are made to find, closer
    ones are found more often. ``n_links`` counts all linked vectors of the component.
    ``component_id`` is the smallest id of the component, ``kept`` marks it.

    Vectors that are null, empty, zero, or hold a null or non-finite component, and rows with a
    null id, are linked with nothing; the latter have a null component and are kept. Vectors of different
    lengths are not linked. Equal vectors are linked even where they are rows of one id, which
    come back as often as they are there; an id with different vectors is one vertex
    that has the links of the first of them (by order of the vectors) and its copies. Other columns are left out.
    """
    fit = takes_part(F.col("embedding")) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    table = stage(sketched(rows.filter(fit), seed), "sketches")
    # One row a class of equal vectors, under its smallest id.
    classes = table.groupBy("same").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )
    classes = stage(classes, "vector-classes")
    reps = classes.groupBy(F.col("rep").alias("vec_id")).agg(
        F.min(F.struct("same", "size", "sketch", "n")).alias("_one")
    )
    reps = stage(reps.select("vec_id", "_one.same", "_one.size", "_one.sketch", "_one.n"), "vector-representatives")
    count = reps.count()
    passes = passes or passes_for(count, cosine, window, found)
    parts = max(1, -(-count * passes // ROWS_A_PART))
    pairs = _windows(_keyed(reps, passes, seed), parts, window, farthest(cosine, SKETCH_BYTES * 8))
    named = stage(pairs, "vector-pairs")
    # Only vectors of candidate pairs are read again; repeated rows of an id are one.
    ends = named.select(F.col("a").alias("vec_id")).union(named.select("b")).distinct()
    wanted = reps.select("vec_id", "same").join(ends, "vec_id", "left_semi")
    own = table.select("vec_id", "same", "embedding").join(wanted, ["vec_id", "same"], "left_semi")
    own = stage(own.drop("same").dropDuplicates(["vec_id"]), "pair-vectors")
    compared = _with_vector(_with_vector(named, own, "a", "u"), own, "b", "v")
    links = _compared(compared, ["a", "b"]).filter(F.col("cosine") >= cosine).select("a", "b")
    above = components(links)
    named_components = above.select(F.col("vertex").alias("vec_id"), "component").union(
        above.select(F.col("component").alias("vec_id"), "component").distinct()
    )
    members = stage(named_components.join(reps.select("vec_id", "n"), "vec_id"), "component-members")
    balls = _balls(members, own, cosine)
    of_ball = balls.groupBy("component", "centre").agg(F.sum("n").alias("_all"))
    counted = balls.join(of_ball, ["component", "centre"]).join(_other_balls(balls, own, cosine), "vec_id", "left")
    counted = counted.select(
        F.col("vec_id").alias("rep"), "component", (F.col("_all") + F.coalesce("linked", F.lit(0))).alias("_links")
    )
    per_class = classes.select("same", "rep", "n").join(counted, "rep", "left")
    judged = per_class.select(
        "same",
        (F.coalesce("_links", "n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = table.select("vec_id", "same").join(judged, "same").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(fit, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept: Column = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).withColumn("kept", kept)
