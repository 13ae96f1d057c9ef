import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakekit.operators.labels import derived_flags, engagement_label, weak_sentiment
from lakekit.operators.silver import (
    clean_events,
    dedup_events,
    flatten_community,
    normalize_raw,
    to_events,
)
from lakekit.schema import EVENT_SCHEMA, as_events


def test_golden_counts(events, raw_posts):
    assert events.count() == 98
    assert to_events(raw_posts.union(raw_posts), topic="ds").count() == 50


def test_contract(events):
    assert [(f.name, f.dataType) for f in events.schema] == [
        (f.name, f.dataType) for f in EVENT_SCHEMA
    ]


def test_golden_flags_and_labels(events):
    flags = derived_flags(events).agg(F.sum("has_url"), F.sum("is_question"), F.sum("is_post"))
    assert tuple(flags.first()) == (25.0, 17.0, 50.0)
    counts = weak_sentiment(events).groupBy("sentiment_label").count().collect()
    assert {r[0]: r[1] for r in counts} == {"positive": 63, "negative": 29, "neutral": 6}


def test_needs_an_input():
    with pytest.raises(ValueError):
        to_events(None, None, topic="x")


def test_calendar_parts_and_text(spark):
    raw = spark.createDataFrame(
        [("1", "c", 1704067200 + 3600 * 5, " A  title ", "the\nbody", 3)],
        "id string, channel_name string, created_utc long, title string, selftext string, score int",
    )
    row = to_events(raw, topic="t").first()
    assert row["event_id"] == "post_1"
    assert row["created_date"] == dt.date(2024, 1, 1)
    assert (row["created_hour"], row["created_dow"]) == (5, 2)
    assert row["text"] == "A title the body"
    assert (row["text_length"], row["word_count"]) == (16, 4)
    assert row["url"] is None and row["channel_nsfw"] is None


def test_struct_and_dotted_communities(spark, raw_posts):
    dotted = flatten_community(raw_posts)
    assert {"channel_name", "channel_nsfw", "channel_id"} <= set(dotted.columns)
    nested = spark.createDataFrame(
        [("1", ("x", True), 5)], "id string, board struct<name:string,nsfw:boolean>, score long"
    )
    row = normalize_raw(nested, event_type="post", topic="t", community="board").first()
    assert (row["channel"], row["channel_nsfw"]) == ("x", True)


def test_malformed_values_become_null(spark):
    raw = spark.createDataFrame(
        [("1", "c", "nonsense", "t", "many"), ("2", "c", "1704067200", "t", "4")],
        "id string, channel_name string, created_utc string, title string, score string",
    )
    rows = to_events(raw, topic="t").collect()
    assert [(r["event_id"], r["score"]) for r in rows] == [("post_2", 4)]


def test_null_ids_do_not_fold_into_one_event(spark):
    raw = spark.createDataFrame(
        [(None, "a", 1), (None, "b", 2), ("7", "c", 3)], "id string, title string, score long"
    )
    assert [r["event_id"] for r in to_events(raw, topic="t").collect()] == ["post_7"]


def test_survivor_is_newest_batch_then_highest_score(spark):
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    raw = spark.createDataFrame(
        [
            ("1", "old", 9, first),
            ("1", "new", 1, second),
            ("1", "[removed]", 99, second),
            ("2", "low", 1, first),
            ("2", "high", 5, first),
        ],
        "id string, title string, score long, _ingested_at timestamp",
    )
    rows = {r["event_id"]: r["title"] for r in to_events(raw, topic="t").collect()}
    # An invalid copy never hides a valid one.
    assert rows == {"post_1": "new", "post_2": "high"}


def test_same_id_in_two_topics_is_two_events(spark):
    raw = spark.createDataFrame(
        [("1", "a", "x", 1), ("1", "a", "y", 1)], "id string, title string, _topic string, score long"
    )
    assert to_events(raw, topic=F.col("_topic")).count() == 2


def test_placeholder_handling(spark):
    raw = spark.createDataFrame(
        [("1", "fine", "[removed]", 1), ("2", "[removed]", "[deleted]", 1), ("3", None, "[deleted]", 1)],
        "id string, title string, selftext string, score long",
    )
    kept = {r["event_id"]: r["text"] for r in to_events(raw, topic="t").collect()}
    assert kept == {"post_1": "fine [removed]", "post_2": "[removed] [deleted]"}
    scrubbed = to_events(raw, topic="t", scrub_placeholders=True).collect()
    assert {r["event_id"]: r["text"] for r in scrubbed} == {"post_1": "fine"}


def test_dedup_prunes_copies_before_the_shuffle(spark, raw_posts):
    twice = to_events(raw_posts.union(raw_posts), topic="t")
    plan = twice._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_engagement_label_is_per_topic_and_counts_ties(spark):
    rows = [("a", f"{i}", i) for i in range(10)] + [("b", f"{i}", 5) for i in range(4)]
    df = spark.createDataFrame(rows, "topic string, event_id string, score long")
    got = engagement_label(df, 0.9).groupBy("topic").agg(
        F.max("score_threshold"), F.sum("label")
    )
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == {"a": (8, 2.0), "b": (5, 4.0)}


def test_only_rows_of_repeated_keys_are_sorted(spark, raw_posts):
    """Without repeated keys there is nothing to shuffle; with some, the others pass by."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    once = to_events(raw_posts, topic="ds")
    assert "Window" not in plan(once) and "Sort" not in plan(once) and "Join" not in plan(once)
    few = raw_posts.filter("id = 'p00007'").withColumn("score", F.lit(99).cast("long"))
    both = to_events(raw_posts.unionByName(few), topic="ds")
    assert plan(both).count("Window [") == 1
    rows = {r["event_id"]: r["score"] for r in both.collect()}
    assert len(rows) == both.count() == 50 and rows["post_p00007"] == 99
    # The same rows as from one window over all.
    unified = normalize_raw(raw_posts.unionByName(few), event_type="post", topic="ds")
    whole = as_events(dedup_events(clean_events(unified)).filter("_valid"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, both.collect()))
    unknown = spark.createDataFrame([("a", "one", 1), ("a", "two", 2)], "id string, title string, score long")
    kept = to_events(unknown, topic=F.lit(None).cast("string")).collect()
    assert [r["title"] for r in kept] == ["two"]
