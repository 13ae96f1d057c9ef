"""Dashboard tiles: the final queries over the views.

Relative dates count back from ``as_of``; every top-k has a unique tie-break.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.stats import ratio


def _since(as_of: dt.date | None, days: int):
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.col("created_date") >= F.date_sub(today, days)


def kpi_cards(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "topic", "total_events", "channels", "avg_score", "avg_net_sentiment"
    ).orderBy(F.desc("total_events"), "topic")


def volume_trend(trend: DataFrame, as_of: dt.date | None = None, days: int = 90) -> DataFrame:
    return (
        trend.filter(_since(as_of, days))
        .select("topic", "created_date", "events_rolling_7d")
        .orderBy("created_date")
    )


def top_ranked_channels(board: DataFrame, n: int = 15) -> DataFrame:
    return (
        board.filter(F.col("rank_by_volume") <= n)
        .select("channel", "topic", "event_count", "avg_score")
        .orderBy(F.desc("event_count"), "topic", "channel")
    )


def activity_heatmap(heat: DataFrame) -> DataFrame:
    return (
        heat.groupBy("day_label", "hour_of_day", "day_of_week")
        .agg(F.sum("event_count").alias("events"))
        .orderBy("day_of_week", "hour_of_day")
        .select("day_label", "hour_of_day", "events")
    )


def topic_share_over_time(
    shares: DataFrame, as_of: dt.date | None = None, days: int = 60
) -> DataFrame:
    """``topic_share`` sums the shares of all topics and can exceed one;
    ``topic_share_weighted`` is the label's share of all events of the day."""
    in_range = shares.filter(_since(as_of, days))
    per_label = in_range.groupBy("created_date", "topic_label").agg(
        F.sum("topic_share").alias("topic_share"), F.sum("event_count").alias("_events")
    )
    of_day = F.sum("_events").over(Window.partitionBy("created_date"))
    return (
        per_label.withColumn("topic_share_weighted", F.round(F.col("_events") / of_day, 4))
        .drop("_events")
        .orderBy("created_date", "topic_label")
    )


def topic_dictionary(topic_terms: DataFrame) -> DataFrame:
    return topic_terms.select("topic_id", "label", "terms").orderBy("topic_id")


def sentiment_trend(
    breakdown: DataFrame, as_of: dt.date | None = None, days: int = 90
) -> DataFrame:
    return (
        breakdown.filter(_since(as_of, days))
        .groupBy("topic", "created_date")
        .agg(F.avg("net_sentiment").alias("net_sentiment"))
        .orderBy("created_date", "topic")
    )


def sentiment_mix(breakdown: DataFrame, n: int = 20) -> DataFrame:
    return (
        breakdown.groupBy("channel")
        .agg(
            F.sum("positive").alias("positive"),
            F.sum("neutral").alias("neutral"),
            F.sum("negative").alias("negative"),
        )
        .orderBy(
            (F.col("positive") + F.col("neutral") + F.col("negative")).desc(), "channel"
        )
        .limit(n)
    )


def engagement_rate(summary: DataFrame) -> DataFrame:
    rate = F.round(ratio(F.col("predicted_high_events"), F.col("scored_events")), 4)
    return (
        summary.groupBy("topic")
        .agg(
            F.sum("predicted_high").alias("predicted_high_events"),
            F.sum("scored_events").alias("scored_events"),
        )
        .withColumn("high_engagement_rate", rate)
        .orderBy(F.desc("high_engagement_rate"), "topic")
    )


def probability_vs_score(summary: DataFrame, min_events: int = 5, n: int = 500) -> DataFrame:
    return (
        summary.filter(F.col("scored_events") >= min_events)
        .orderBy(F.desc("avg_engagement_proba"), "topic", "channel", "created_date")
        .limit(n)
        .select(
            "channel",
            "avg_engagement_proba",
            F.col("avg_actual_score").alias("avg_score"),
            "scored_events",
        )
    )
