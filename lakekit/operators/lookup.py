"""Joins to a side that is expected to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.joins import join_same

# A lookup row here is a key, a few numbers and at most a short term list, so this
# many rows stay far below the executors' broadcast limits.
MAX_BROADCAST_ROWS = 100_000


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    max_rows: int = MAX_BROADCAST_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``lookup``, broadcast only when its counted size allows it.

    Beyond ``max_rows`` the join is left to Spark, which shuffles and splits
    skewed keys. The lookup is read for the count and again for the join: pass a
    stored table, or a checkpointed aggregate. With ``null_safe`` null keys match each other.
    """
    if lookup.limit(max_rows + 1).count() <= max_rows:
        lookup = F.broadcast(lookup)
    if not null_safe:
        return df.join(lookup, list(on), how)
    return join_same(df, lookup, on, how)
