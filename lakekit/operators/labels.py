"""Columns derived per event for the models: flags, weak labels, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.stats import percentiles
from lakekit.operators.lookup import join_lookup
from lakekit.schema import POST
from lakekit.session import checkpointed

# Fixed values of the weak labels.
SENTIMENTS = ["negative", "neutral", "positive"]
SOURCE_MARGIN = 0.05
SCORE_POSITIVE_ABOVE = 5
SCORE_NEGATIVE_BELOW = 0


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def derived_flags(events: DataFrame) -> DataFrame:
    """``has_url``, ``is_question`` and ``is_post`` as 1.0 / 0.0; null counts as 0.0."""
    return events.withColumns(
        {
            "has_url": _flag(F.col("url") != ""),
            "is_question": _flag(F.contains(F.col("text"), F.lit("?"))),
            "is_post": _flag(F.col("event_type") == POST),
        }
    )


def _three_way(value: Column, above: float, below: float) -> Column:
    return F.when(value > above, "positive").when(value < below, "negative").otherwise("neutral")


def weak_sentiment(events: DataFrame) -> DataFrame:
    """``sentiment_label`` from the source's own score, else from the event score.

    A source value that is not a number counts as missing.
    """
    source = F.col("sentiment_source").try_cast("double")
    by_source = _three_way(source, SOURCE_MARGIN, -SOURCE_MARGIN)
    by_score = _three_way(F.col("score"), SCORE_POSITIVE_ABOVE, SCORE_NEGATIVE_BELOW)
    return events.withColumn(
        "sentiment_label", F.when(source.isNotNull(), by_source).otherwise(by_score)
    )


def score_thresholds(events: DataFrame, p: float = 0.90) -> DataFrame:
    """The per-topic score percentile: one row per topic."""
    return percentiles(events, ["topic"], "score", {"score_threshold": p})


def label_by_threshold(events: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``label`` 1.0 where the score reaches its topic's threshold."""
    joined = join_lookup(events, thresholds, on=["topic"], null_safe=True)
    return joined.withColumn("label", _flag(F.col("score") >= F.col("score_threshold")))


def engagement_label(events: DataFrame, p: float = 0.90) -> DataFrame:
    """Label the top of each topic's scores.

    An aggregate joined back, not a window over ``topic``: a window would bring
    all rows of a topic, text included, into one task.
    """
    return label_by_threshold(events, checkpointed(score_thresholds(events, p)))
