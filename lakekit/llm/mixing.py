"""Mixing of sources to target sizes by weighted sampling without replacement.

A source's documents stand in the order of exponential keys ``-ln(u) / weight``, where u
is a hash of the document: the order of weighted sampling without replacement. Of a
source with a target of ``e`` whole sizes and a rest, every document is taken ``e``
times, and the rest is filled from the front of that order. The document at the edge is
taken for the words that are still missing, so a source meets its target to the word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.prefix import before, running_totals, source_key

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Weights of the sources in the order of their names, repeating.
SOURCE_WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
# Equal steps of the sampling order; a source's rows in one step are sorted together.
STEPS = 4096
LEAST_WEIGHT = 0.05


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_share(text: Column) -> Column:
    """A quality weight from the text alone: less for texts strewn with marks."""
    marks = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    share = 1 - 8 * marks / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(share, F.lit(LEAST_WEIGHT)), F.lit(1.0))


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``_key, source_size, target`` from ``_key, source_size``, one row per source.

    ``share`` of all sizes is dealt by weight; a target stops at ``most_epochs`` times its
    source's size and the excess is dealt again. That ends at ``min(cap, level * weight)``
    for one level. By ascending cap per weight a source is capped if its ratio is below
    the level that would hold with all before it capped.
    """
    rank = F.row_number().over(Window.orderBy("_key")) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("_weight", F.get(cycle, rank % len(weights)))
    rows = rows.withColumn("_cap", F.col("source_size") * float(most_epochs))
    rows = rows.withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    every = Window.partitionBy()
    order = ["_ratio", "_key"]
    left = F.sum("source_size").over(every) * float(share) - before("_cap", [], order)
    level = left / (F.sum("_weight").over(every) - before("_weight", [], order))
    rows = rows.withColumn("_level", level).withColumn("_capped", F.col("_ratio") < F.col("_level"))
    # All that are not capped have the level of the first of them.
    first = F.min(F.when(~F.col("_capped"), F.struct(*order, "_level"))).over(every)["_level"]
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least("_cap", F.col("_weight") * first))
    return rows.select("_key", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    quality: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken``, one row per row.

    ``docs`` has doc_id, text and source, and no columns of those four names or that
    begin with an underscore. ``taken`` counts words, repeats included. ``quality`` is a
    column of positive weights (default: from the text). Null text: size 0, nothing
    taken; a null source is a source of its own, last in order; a source without words has
    target 0. Repeated rows have one key and are taken in a row; which of two equal rows
    is at the edge makes no difference. The same rows give the same mix.
    """
    quality = plain_share(F.col("text")) if quality is None else quality
    hashed = F.xxhash64("doc_id", "text", F.lit(seed))
    u = (F.shiftrightunsigned(hashed, 11) + 0.5) / float(1 << 53)
    key = -F.log(u) / F.greatest(quality.cast("double"), F.lit(1e-6))
    rows = docs.withColumns({"_key": source_key(), "size": words(F.col("text")), "_order": key})
    step = F.least(F.floor((1 - F.exp(-F.col("_order"))) * STEPS), F.lit(STEPS - 1))
    rows = rows.withColumn("_step", step)
    sizes = rows.groupBy("_key").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, share, most_epochs)
    ordered = running_totals(rows, ["_key"], "_step", ["_order", "doc_id"], "size", "_before")
    placed = ordered.join(aims, "_key")
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.round("target").cast("long") - epochs * F.col("source_size")
    # The document at the edge is taken if that brings the source nearer to its target. If it is
    # left, it stands before all that follow, so none of these is taken for it.
    once_more = 2 * (rest - F.col("_before")) > F.col("size")
    extra = F.when(once_more, F.col("size")).otherwise(0)
    taken = placed.withColumn("taken", (epochs * F.col("size") + extra).cast("long"))
    return taken.drop("_key", "_order", "_step", "_before")


def materialize(mixed: DataFrame) -> DataFrame:
    """The mixture as documents: each row of :func:`mix` once per copy taken, with its whole text.

    Rows of which nothing is taken, as those without words, are not in it. No rows give none.
    """
    copies = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    rows = mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return rows.drop("_copy", "size", "source_size", "target", "taken")
