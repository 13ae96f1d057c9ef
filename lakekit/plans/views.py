"""BI views over the gold tables, as functions from frames to a frame.

Windows here run over aggregates (a day per channel, a channel per topic, a
label per day), never over event rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.joins import join_same
from lakekit.functions.stats import net_sentiment, ratio, value_ranks
from lakekit.operators.lookup import join_lookup

# Spark's day numbers start at Sunday.
DAY_LABELS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def daily_trend(daily: DataFrame, *, calendar: bool = False) -> DataFrame:
    """Daily activity with rolling measures and the change to the row before.

    The rolling frame is seven rows; ``calendar`` makes it seven days, which
    differs where a channel has days without events.
    """
    by_date = Window.partitionBy("topic", "channel").orderBy("created_date")
    if calendar:
        last7 = (
            Window.partitionBy("topic", "channel")
            .orderBy(F.unix_date("created_date"))
            .rangeBetween(-6, Window.currentRow)
        )
    else:
        last7 = by_date.rowsBetween(-6, Window.currentRow)
    return daily.select(
        "topic",
        "channel",
        "created_date",
        "event_count",
        "post_count",
        "comment_count",
        "avg_score",
        "median_score",
        "total_score",
        "avg_word_count",
        F.sum("event_count").over(last7).alias("events_rolling_7d"),
        F.avg("avg_score").over(last7).alias("avg_score_rolling_7d"),
        (F.col("event_count") - F.lag("event_count").over(by_date)).alias("event_count_dod_delta"),
    )


def leaderboard(summary: DataFrame) -> DataFrame:
    """Channels ranked within their topic by volume and by average score.

    A rank is one more than the number of channels with a greater value, counted per distinct value
    and range of values, so a topic is not sorted in one task. A filter on either rank leaves few values
    before the channels are joined. ``summary`` is read several times: pass a stored table.
    """
    by_volume = value_ranks(summary, ["topic"], "event_count", "rank_by_volume")
    by_score = value_ranks(summary, ["topic"], "avg_score", "rank_by_avg_score")
    ranked = join_same(summary, by_volume, ["topic", "event_count"])
    ranked = join_same(ranked, by_score, ["topic", "avg_score"])
    return ranked.select(
        "topic",
        "channel",
        "event_count",
        "active_days",
        "avg_score",
        "p90_score",
        "max_score",
        "nsfw",
        "first_seen",
        "last_seen",
        F.round(ratio(F.col("event_count"), F.col("active_days")), 2).alias(
            "events_per_active_day"
        ),
        "rank_by_volume",
        "rank_by_avg_score",
    )


def heatmap(hourly: DataFrame) -> DataFrame:
    labels = F.array(*[F.lit(d) for d in DAY_LABELS])
    return hourly.select(
        "topic",
        F.col("created_dow").alias("day_of_week"),
        F.try_element_at(labels, F.col("created_dow").cast("int")).alias("day_label"),
        F.col("created_hour").alias("hour_of_day"),
        "event_count",
        "avg_score",
    )


def _with_labels(df: DataFrame, topic_terms: DataFrame, *columns: str) -> DataFrame:
    names = topic_terms.select(F.col("topic_id").alias("dominant_topic"), *columns)
    return join_lookup(df, names, on=["dominant_topic"])


def topics_labeled(post_topics: DataFrame, topic_terms: DataFrame) -> DataFrame:
    """Topic assignments with readable labels; unknown topics keep null labels."""
    return _with_labels(post_topics, topic_terms, "label", "terms").select(
        "event_id",
        "topic",
        "channel",
        "created_date",
        "score",
        "dominant_topic",
        "topic_confidence",
        F.col("label").alias("topic_label"),
        F.col("terms").alias("topic_terms"),
    )


def topic_share_daily(post_topics: DataFrame, topic_terms: DataFrame) -> DataFrame:
    """Share of a day's events that each modelled topic takes."""
    daily = post_topics.groupBy("topic", "created_date", "dominant_topic").agg(
        F.count("*").alias("event_count")
    )
    of_day = F.sum("event_count").over(Window.partitionBy("topic", "created_date"))
    shares = daily.withColumn(
        "topic_share", F.round(F.col("event_count") / of_day, 4)
    )
    return _with_labels(shares, topic_terms, "label").select(
        "topic",
        "created_date",
        "dominant_topic",
        F.col("label").alias("topic_label"),
        "event_count",
        "topic_share",
    )


def _sentiment_counts(post_sentiment: DataFrame, *keys: str) -> DataFrame:
    label = F.col("sentiment_label")
    return post_sentiment.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "neutral").alias("neutral"),
        F.count_if(label == "negative").alias("negative"),
    )


def sentiment_breakdown(post_sentiment: DataFrame) -> DataFrame:
    counts = _sentiment_counts(post_sentiment, "topic", "channel", "created_date")
    positive, negative, total = F.col("positive"), F.col("negative"), F.col("total")
    return counts.withColumns(
        {
            "positive_ratio": F.round(ratio(positive, total), 4),
            "negative_ratio": F.round(ratio(negative, total), 4),
            "net_sentiment": F.round(net_sentiment(positive, negative, total), 4),
        }
    )


def engagement_summary(predictions: DataFrame) -> DataFrame:
    """Predicted against actual engagement per channel and day.

    ``high_engagement_rate`` is the share the BI documentation asks for.
    """
    high = F.col("is_high_engagement").cast("int")
    return (
        predictions.groupBy("topic", "channel", "created_date")
        .agg(
            F.count("*").alias("scored_events"),
            F.sum(high).alias("predicted_high"),
            F.round(F.avg("engagement_probability"), 4).alias("avg_engagement_proba"),
            F.round(F.avg("score"), 2).alias("avg_actual_score"),
        )
        .withColumn(
            "high_engagement_rate",
            F.round(ratio(F.col("predicted_high"), F.col("scored_events")), 4),
        )
    )


def topic_kpis(summary: DataFrame, post_sentiment: DataFrame) -> DataFrame:
    """One row per topic.

    ``avg_score`` averages the channels' averages; ``avg_score_weighted`` weighs
    them by their events.
    """
    weighted = F.sum(F.col("avg_score") * F.col("event_count"))
    per_topic = summary.groupBy("topic").agg(
        F.count_distinct("channel").alias("channels"),
        F.sum("event_count").alias("total_events"),
        F.round(F.avg("avg_score"), 2).alias("avg_score"),
        F.round(F.try_divide(weighted, F.sum("event_count")), 2).alias("avg_score_weighted"),
        F.min("first_seen").alias("earliest_event"),
        F.max("last_seen").alias("latest_event"),
    )
    mood = _sentiment_counts(post_sentiment, "topic").select(
        "topic",
        F.round(net_sentiment(F.col("positive"), F.col("negative"), F.col("total")), 4).alias(
            "avg_net_sentiment"
        ),
    )
    # Both sides hold one row per topic and are already partitioned by it.
    return per_topic.join(mood, "topic", "left")


def gold_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight views by name, from gold tables by name."""
    return {
        "vw_channel_daily_trend": daily_trend(tables["daily_activity"]),
        "vw_channel_leaderboard": leaderboard(tables["channel_summary"]),
        "vw_activity_heatmap": heatmap(tables["hourly_activity"]),
        "vw_post_topics_labeled": topics_labeled(tables["post_topics"], tables["topic_terms"]),
        "vw_topic_share_daily": topic_share_daily(tables["post_topics"], tables["topic_terms"]),
        "vw_sentiment_breakdown": sentiment_breakdown(tables["post_sentiment"]),
        "vw_engagement_summary": engagement_summary(tables["engagement_predictions"]),
        "vw_topic_kpis": topic_kpis(tables["channel_summary"], tables["post_sentiment"]),
    }


def register_views(frames: dict[str, DataFrame]) -> list[str]:
    """Make frames queryable from SQL by name in their session."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)
