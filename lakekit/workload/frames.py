"""The supplied tables seen as raw posts, raw comments and timed events.

Every row and every whole text of a table takes part. What the tables lack
(titles, scores, removed bodies) is computed from columns they have.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekit.functions.text import tokens
from lakekit.ml.topics import ASSIGNMENT_COLUMNS, LABEL_TERMS, with_dominant_topic
from lakekit.operators.labels import engagement_label, weak_sentiment
from lakekit.operators.silver import to_events
from lakekit.schema import POST
from lakekit.session import stage
from lakekit.sources.tables import spread_small

AS_OF = dt.date(2024, 1, 31)
FIRST_INGEST = dt.datetime(2024, 2, 1)
SECOND_INGEST = dt.datetime(2024, 2, 2)
EPOCH = 1704067200  # 2024-01-01 UTC
SPAN = 2592000  # 30 days
TOPIC_LETTERS = "aeioun"  # the letters that stand in for modelled topics
WORDS_PER_TOPIC = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose texts are worked on, narrowed to what is used."""
    return spread_small(table(spark, sf_dir, name).select(*columns))


def raw_posts(spark: SparkSession, sf_dir: str, *, labelled: bool = False) -> DataFrame:
    """``documents`` with ``labels``: toxic bodies are removed by moderators, low-quality
    toxic posts lose their title too, short low-quality posts were never scored. With ``labelled``
    those that have a label; texts of others are not moved."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    wanted = documents.join(labels.select("doc_id"), "doc_id", "left_semi") if labelled else None
    joined = spread_small(documents, wanted).join(labels, "doc_id", "left")
    judged = joined.selectExpr(
        "*",
        "coalesce(toxic = 1, false) AS removed",
        "coalesce(quality = 0, false) AS poor",
        "CASE WHEN doc_id % 3 = 0 THEN '?' ELSE '' END AS mark",
    )
    return judged.selectExpr(
        f"'{POST}' AS type",
        "CAST(doc_id AS STRING) AS id",
        "source AS `channel.name`",
        "toxic = 1 AS `channel.nsfw`",
        f"{EPOCH} + (doc_id * 7919) % {SPAN} AS created_utc",
        "CASE WHEN NOT (removed AND poor) THEN concat(source, '  note ', doc_id, mark) END AS title",
        "CASE WHEN removed THEN '[removed]' ELSE text END AS selftext",
        "concat('/d/', doc_id) AS permalink",
        "lang AS domain",
        "CASE WHEN doc_id % 2 = 1 THEN concat('https://e.com/', doc_id) END AS url",
        "CASE WHEN NOT (poor AND NOT removed AND n_chars < 1000) THEN n_chars % 1000 - 100 END AS score",
    )


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``: turns under 60 characters count as deleted; the source
    sentiment is missing for some and not a number for others."""
    return texts(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").selectExpr(
        "'comment' AS type",
        "concat(conv_id, '_', turn) AS id",
        "struct(role AS name, false AS nsfw) AS channel",
        f"{EPOCH} + (conv_id * 3607 + turn * 61) % {SPAN} AS created_utc",
        "CASE WHEN length(text) < 60 THEN '[deleted]' ELSE text END AS body",
        """CASE WHEN conv_id % 7 = 0 THEN NULL WHEN conv_id % 13 = 0 THEN 'bad'
           ELSE CAST(CAST((conv_id * 7 + turn * 13) % 21 - 10 AS DOUBLE) / 10 AS STRING)
           END AS sentiment""",
        "CAST(length(text) % 120 - 20 AS BIGINT) AS score",
    )


def _posts_topic() -> Column:
    return F.col("domain")


def post_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver posts with the language as topic."""
    return to_events(raw_posts(spark, sf_dir), topic=_posts_topic())


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver posts and comments; comments, which have no language, share one topic."""
    posts = raw_posts(spark, sf_dir).withColumn("_topic", F.col("domain"))
    comments = raw_comments(spark, sf_dir).withColumn("_topic", F.lit("chat"))
    return to_events(posts, comments, topic=F.col("_topic"))


def narrow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events without their texts, staged for queries that read them more than once."""
    return stage(silver_events(spark, sf_dir).drop("title", "text"), "narrow_events")


def relabelled_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts that have a label, delivered again with one more point."""
    return raw_posts(spark, sf_dir, labelled=True).withColumn("score", F.col("score") + 1)


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as canonical rows; a user stands for a channel."""
    timed = table(spark, sf_dir, "events").withColumn("created_ts", F.col("ts").cast("timestamp"))
    return timed.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN event_type IN ('signup', 'purchase') THEN 'post' ELSE 'comment' END AS event_type",
        "concat('t', user_id % 3) AS topic",
        "concat('c', user_id) AS channel",
        "CASE WHEN user_id % 20 <> 7 THEN user_id % 20 = 3 END AS channel_nsfw",
        "created_ts",
        "to_date(created_ts) AS created_date",
        "CAST(hour(created_ts) AS BIGINT) AS created_hour",
        "CAST(dayofweek(created_ts) AS BIGINT) AS created_dow",
        "CAST(length(props) AS BIGINT) AS text_length",
        r"CAST(size(split(props, '\\s+')) AS BIGINT) AS word_count",
        "CAST(floor(value) AS BIGINT) - 20 AS score",
    )


def letter_shares(events: DataFrame) -> DataFrame:
    """``shares``: how the counted letters of the whole text divide; zeros if there are none."""
    counts = ", ".join(f"length(text) - length(replace(text, '{c}', ''))" for c in TOPIC_LETTERS)
    return (
        events.withColumn("letters", F.expr(f"array({counts})"))
        .withColumn("total", F.expr("CAST(aggregate(letters, 0, (a, n) -> a + n) AS DOUBLE)"))
        .withColumn(
            "shares", F.expr("transform(letters, n -> coalesce(try_divide(n, total), 0.0D))")
        )
    )


def post_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic assignments in the shape the topic model gives, from letter shares."""
    assigned = with_dominant_topic(letter_shares(post_events(spark, sf_dir)), "shares")
    return assigned.select(*ASSIGNMENT_COLUMNS, "text")


def topic_terms(assigned: DataFrame) -> DataFrame:
    """The most frequent words of each assigned topic, written like the gold table
    that views read."""
    words = (
        assigned.select(F.col("dominant_topic").alias("topic_id"), F.explode(tokens(F.col("text"))).alias("term"))
        .groupBy("topic_id", "term")
        .agg(F.count("*").alias("n"))
    )
    by_count = Window.partitionBy("topic_id").orderBy(F.desc("n"), "term")
    top = words.withColumn("place", F.row_number().over(by_count)).filter(
        F.col("place") <= WORDS_PER_TOPIC
    )
    terms = (
        top.groupBy("topic_id")
        .agg(F.array_sort(F.collect_list(F.struct("place", "term")))["term"].alias("terms"))
        .withColumn("label", F.array_join(F.slice("terms", 1, LABEL_TERMS), ", "))
    )
    return stage(terms, "topic_terms")


def post_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak labels of all silver events."""
    return weak_sentiment(silver_events(spark, sf_dir))


def engagement_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions in the shape the classifier gives: the label itself, and a
    probability that grows with the text."""
    length = F.col("text_length").cast("double")
    return (
        engagement_label(narrow_events(spark, sf_dir))
        .withColumnRenamed("label", "is_high_engagement")
        .withColumn("engagement_probability", length / (length + 1000.0))
    )
