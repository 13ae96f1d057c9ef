"""Results on inputs that the supplied tables lack."""

from datetime import datetime

from pyspark.sql import functions as F

from lakekit.functions.stats import percentiles
from lakekit.operators.gold import channel_summary
from lakekit.operators.labels import engagement_label
from lakekit.operators.silver import to_events


def test_clock_beyond_the_calendar_is_unknown(spark, raw_posts):
    late = raw_posts.limit(1).withColumn("created_utc", F.lit(1_704_153_600_000_000).cast("long"))
    rows = to_events(late, topic="t").collect()
    assert [r["created_ts"] for r in rows] == [None]


def test_flag_before_1970(spark):
    rows = [("t", "c", datetime(1969, 12, 31), datetime(1969, 12, 31).date(), 1, True, "e")]
    schema = "topic string, channel string, created_ts timestamp, created_date date, score long, channel_nsfw boolean, event_id string"
    assert channel_summary(spark.createDataFrame(rows, schema)).first()["nsfw"] is True


def test_null_topic_has_a_threshold(spark):
    rows = [(None, "a", 1), (None, "b", 5), ("t", "c", 2)]
    events = spark.createDataFrame(rows, "topic string, event_id string, score long")
    found = {r["event_id"]: (r["score_threshold"], r["label"]) for r in engagement_label(events).collect()}
    assert found == {"a": (5, 0.0), "b": (5, 1.0), "c": (2, 1.0)}


def test_percentile_rank_is_exact(spark):
    got = percentiles(spark.range(1, 101).withColumn("k", F.lit(1)), ["k"], "id", {"p": 0.07}).first()
    assert got["p"] == 7
