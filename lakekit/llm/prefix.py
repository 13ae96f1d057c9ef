"""Running totals over any number of rows without sorting a whole group in one task.

Rows are dealt into buckets that follow the wanted order. Sums per bucket are a small
aggregate; their own running totals are taken in two steps (buckets within a block of
buckets, blocks within a group), so that no window holds more than ``BLOCK`` buckets of
a block or the blocks of a group. Only the rows of one bucket are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def source_key(column: str = "source") -> Column:
    """A key without nulls whose order is by code point, null last."""
    return F.when(F.col(column).isNull(), "t").otherwise(F.concat(F.lit("s"), F.col(column)))


def before(value: str, partition: Sequence, order: Sequence) -> Column:
    """The sum over earlier rows of the window, 0 for the first."""
    window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def bucket_starts(df: DataFrame, groups: Sequence[str], bucket: str, value: str) -> DataFrame:
    """One row for each group and bucket: ``_start``, the group's sum in earlier buckets."""
    keys = list(groups)
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_block", F.floor(F.col(bucket) / BLOCK))
    blocks = sums.groupBy(*keys, "_block").agg(F.sum("_sum").alias("_all"))
    blocks = blocks.select(*keys, "_block", before("_all", keys, ["_block"]).alias("_base"))
    inside = before("_sum", [*keys, "_block"], [bucket])
    starts = sums.withColumn("_inside", inside).join(blocks, [*keys, "_block"])
    return starts.select(*keys, bucket, (F.col("_base") + F.col("_inside")).alias("_start"))


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    bucket: str,
    order: Sequence,
    value: str,
    name: str,
) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same groups that come
    before the row by ``bucket``, then by ``order``. Groups and bucket must not be null."""
    starts = bucket_starts(df, groups, bucket, value)
    keys = [*groups, bucket]
    total = F.col("_start") + before(value, keys, order)
    return df.join(starts, keys).withColumn(name, total).drop("_start")
