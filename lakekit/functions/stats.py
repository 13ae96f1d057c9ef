"""Ratios and percentiles shared by gold tables, views and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.joins import join_same


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division of counts as doubles; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def net_sentiment(positive: Column, negative: Column, total: Column) -> Column:
    return ratio(positive - negative, total)


# Percentiles are members of the data and exact: the smallest value whose rank
# reaches p times the number of values. They are read off counts per distinct
# value, so what meets in one task is distinct values, not rows, and the result does
# not depend on how rows are spread.


def with_value_ranks(counts: DataFrame, keys: Sequence[str], column: str, n: str = "n") -> DataFrame:
    """Add ``_upto``, the rows up to a value, and ``_of``, the rows of its group.

    ``counts`` holds one row per key and distinct value; a null value counts nothing. A
    group's distinct values are sorted in one task: for groups as fine as a channel's day.
    """
    rows = F.when(F.col(column).isNotNull(), F.col(n)).otherwise(0)
    group = Window.partitionBy(*keys)
    upto = group.orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns({"_upto": F.sum(rows).over(upto), "_of": F.sum(rows).over(group)})


def ranked_percentile(column: str, p: float) -> Column:
    """Aggregate over rows with ``_upto`` and ``_of``, with the rank in whole numbers."""
    share = Fraction(str(p))
    reached = f"_upto * {share.denominator}L >= _of * {share.numerator}L"
    return F.expr(f"min(CASE WHEN {reached} THEN {column} END)")


# Ranks in groups of any size go by buckets that follow the order of the values. The
# rows of a bucket are added up first; running totals of these, a row a bucket, tell how many rows
# come before each; and only within a bucket are values sorted.

# So many buckets to each factor of e: values of one bucket differ by less than half a percent.
BUCKETS = 256
_LAST_BUCKET = (1 << 63) - 1


def value_bucket(column: str) -> Column:
    """A whole number that never falls where the value rises; equal values have equal ones.

    Logarithmic, as counts and scores spread over many orders of magnitude. NaN comes last, as in a sort.
    """
    value = F.col(column).cast("double")
    place = F.floor(F.signum(value) * F.log1p(F.abs(value)) * BUCKETS)
    return F.when(F.isnan(value), F.lit(_LAST_BUCKET)).otherwise(place)


def _in_buckets(
    counts: DataFrame, keys: Sequence[str], column: str
) -> tuple[DataFrame, DataFrame]:
    """``counts`` with ``_bucket`` and ``_rows``, and for each bucket ``_before``, the rows of
    its group in earlier ones, ``_in``, its own, and ``_of``, the group's."""
    rows = F.when(F.col(column).isNotNull(), F.col("n")).otherwise(0)
    dealt = counts.withColumns({"_bucket": value_bucket(column), "_rows": rows})
    totals = dealt.groupBy(*keys, "_bucket").agg(F.sum("_rows").alias("_in"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_in").over(earlier), F.lit(0))
    return dealt, totals.withColumns({"_before": before, "_of": F.sum("_in").over(group)})


def _ranked_in_buckets(dealt: DataFrame, buckets: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows of the given buckets with ``_upto`` and ``_of``."""
    on = [*keys, "_bucket"]
    upto = (
        Window.partitionBy(*on)
        .orderBy(column)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = join_same(dealt, buckets.select(*on, "_before", "_of"), on, "inner")
    return rows.withColumn("_upto", F.col("_before") + F.sum("_rows").over(upto))


def ranked_in_order(counts: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``counts`` (``n`` rows per key and distinct value) with ``_upto``, the rows up to a value, and
    ``_of``, the rows of its group. Groups may be of any size."""
    return _ranked_in_buckets(*_in_buckets(counts, keys, column), keys, column)


def counted_percentiles(
    counts: DataFrame, keys: Sequence[str], column: str, points: dict[str, float]
) -> DataFrame:
    """:func:`percentiles` from ``n`` rows per key and distinct value.

    Values are looked at only in the buckets that hold a wanted rank. Groups without a known value
    stay, with nulls.
    """
    dealt, buckets = _in_buckets(counts, keys, column)

    def holds(p: float) -> str:
        share = Fraction(str(p))
        # At least the first value, so that p = 0 is the smallest.
        rank = f"greatest(_of * {share.numerator}L, 1L)"
        within = f"(_before + _in) * {share.denominator}L >= {rank}"
        return f"_before * {share.denominator}L < {rank} AND {within}"

    wanted = " OR ".join(f"({holds(p)})" for p in points.values())
    ranked = _ranked_in_buckets(dealt, buckets.filter(f"_of = 0 OR {wanted}"), keys, column)
    picks = [ranked_percentile(column, p).alias(name) for name, p in points.items()]
    return ranked.groupBy(*keys).agg(*picks)


def percentiles(
    df: DataFrame, keys: Sequence[str], column: str, points: dict[str, float]
) -> DataFrame:
    """One row per key with a named percentile per entry of ``points``; groups may be of any size."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    return counted_percentiles(counts, keys, column, points)


def value_ranks(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Each distinct value of a group with its rank from the greatest down, nulls last: one
    more than the number of rows with a greater value. Groups may be of any size."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked_in_order(counts, keys, column)
    greater = F.when(F.col(column).isNull(), F.col("_of")).otherwise(F.col("_of") - F.col("_upto"))
    return ranked.select(*keys, column, (greater + 1).cast("int").alias(name))
