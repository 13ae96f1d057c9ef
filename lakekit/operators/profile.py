"""Exploratory aggregates over the event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.stats import counted_percentiles, ratio

# Fixed values of the report: its columns and its percentiles.
KEY_COLUMNS = ["event_id", "channel", "created_ts", "text", "score", "text_length"]
SCORE_POINTS = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]
WORD_POINTS = [0.5, 0.9, 0.99]


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("events"))


def type_mix(events: DataFrame) -> DataFrame:
    return events.groupBy("topic", "event_type").agg(
        F.count("*").alias("events"), F.avg("score").alias("avg_score")
    )


def null_ratios(events: DataFrame, columns: Sequence[str] = tuple(KEY_COLUMNS)) -> DataFrame:
    """Share of nulls per column, all columns in one pass."""
    return events.agg(
        *[F.round(F.avg(F.col(c).isNull().cast("int")), 4).alias(c) for c in columns]
    )


def _spread(events: DataFrame, column: str, points: Sequence[float], label: str) -> DataFrame:
    """Percentiles, least, greatest and mean value, from counts per distinct value."""
    counts = events.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = F.sum(F.when(F.col(column).isNotNull(), F.col("n")))
    named = {f"_p{i}": p for i, p in enumerate(points)}
    # Two aggregates of one row each, side by side without a join.
    whole = counts.agg(
        F.min(column).alias(f"min_{label}"),
        F.max(column).alias(f"max_{label}"),
        ratio(F.sum(F.col(column) * F.col("n")), known).alias(f"mean_{label}"),
    )
    picked = counted_percentiles(counts, [], column, named)
    both = picked.unionByName(whole, allowMissingColumns=True)
    return both.agg(
        F.array(*[F.max(name) for name in named]).alias(f"{column}_pcts"),
        *[F.max(name).alias(name) for name in whole.columns],
    )


def score_distribution(events: DataFrame) -> DataFrame:
    return _spread(events, "score", SCORE_POINTS, "score")


def word_distribution(events: DataFrame) -> DataFrame:
    return _spread(events, "word_count", WORD_POINTS, "words").drop("min_words")


def daily_volume(events: DataFrame) -> DataFrame:
    return events.groupBy("created_date").agg(F.count("*").alias("events"))


def top_channels(events: DataFrame, n: int = 25) -> DataFrame:
    """The report's top ``n``; ties are broken by name so that it is repeatable."""
    return (
        events.groupBy("topic", "channel")
        .agg(F.count("*").alias("events"), F.avg("score").alias("avg_score"))
        .orderBy(F.desc("events"), "topic", "channel")
        .limit(n)
    )
