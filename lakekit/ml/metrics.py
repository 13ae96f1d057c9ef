"""Quality of predictions, from counts: no task sorts or holds the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.stats import ranked_in_order, ratio


def class_metrics(predictions: DataFrame) -> DataFrame:
    """One row with ``f1`` and ``accuracy`` of ``prediction`` against ``label``.

    Each class's f1 weighs as much as the class has rows. Every row counts once for the class it has and
    once for the class it was given, so one grouped count tells all.
    """
    hit = (F.col("label") == F.col("prediction")).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.lit(1).alias("has"), F.lit(0).alias("given"), hit.alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("has"), F.lit(1).alias("given"), F.lit(0).cast("long").alias("hit")),
    )
    known = predictions.filter("label IS NOT NULL AND prediction IS NOT NULL")
    classes = known.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("has", "given", "hit")]
    )
    f1 = ratio(2 * F.col("hit"), F.col("has") + F.col("given"))
    return classes.agg(
        ratio(F.sum(f1 * F.col("has")), F.sum("has")).alias("f1"),
        ratio(F.sum("hit"), F.sum("has")).alias("accuracy"),
    )


def area_under_roc(
    predictions: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """One row (for each value of ``by``) with ``area_under_roc``: the probability that a row of label 1 scores above one of
    label 0, ties counting half. Null if there is no row of either label.

    It is a sum over distinct scores of the ranks that their rows of label 1 take among those of label 0.
    """
    is_one = F.col(label) == 1
    counts = predictions.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(
        F.count_if(~is_one).alias("n"), F.count_if(is_one).alias("ones")
    )
    ranked = ranked_in_order(counts, list(by), score)
    # Rows of label 0 with a lower score, and half of those with the same one, in halves.
    above = F.sum(F.col("ones") * (2 * F.col("_upto") - F.col("n")))
    pairs = F.sum("ones") * F.sum("n")
    return ranked.groupBy(*by).agg(ratio(above, 2 * pairs).alias("area_under_roc"))
