import datetime as dt
import math
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakekit.functions.stats import percentiles, value_bucket, value_ranks
from lakekit.operators import gold, profile
from lakekit.operators.lookup import join_lookup
from lakekit.plans import tiles, views

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        ("t", "c", "post", DAY, 10, 4, 1, True),
        ("t", "c", "comment", DAY, 20, 6, 2, None),
        ("t", "c", "comment", DAY, 31, 8, 3, False),
        ("t", "c", "comment", DAY + dt.timedelta(days=9), 5, 2, 1, False),
        ("t", "d", "comment", DAY, 7, 2, 1, None),
    ]
    df = spark.createDataFrame(
        rows,
        "topic string, channel string, event_type string, created_date date, score long, "
        "text_length long, word_count long, channel_nsfw boolean",
    )
    return df.withColumns(
        {
            "created_ts": F.col("created_date").cast("timestamp")
            + F.expr("make_interval(0, 0, 0, 0, 0, score)"),
            "event_id": F.concat(F.lit("e"), F.col("score").cast("string")),
            "created_dow": F.dayofweek("created_date").cast("long"),
            "created_hour": F.lit(0).cast("long"),
        }
    )


def test_daily_values(small):
    rows = {(r["channel"], r["created_date"]): r for r in gold.daily_activity(small).collect()}
    first = rows["c", DAY]
    assert (first["event_count"], first["post_count"], first["comment_count"]) == (3, 1, 2)
    assert (first["median_score"], first["max_score"], first["total_score"]) == (20, 31, 61)
    assert first["avg_score"] == pytest.approx(61 / 3)
    assert (first["avg_text_length"], first["avg_word_count"]) == (6.0, 2.0)
    assert first["comments_per_post"] == 2.0
    assert rows["d", DAY]["comments_per_post"] == 1.0  # no post: the divisor is 1
    assert len(rows) == 3


def test_summary_values(small):
    rows = {r["channel"]: r for r in gold.channel_summary(small).collect()}
    c = rows["c"]
    assert (c["event_count"], c["active_days"], c["events_per_active_day"]) == (4, 2, 2.0)
    assert (c["p90_score"], c["nsfw"]) == (31, True)
    assert c["first_seen"] < c["last_seen"]
    assert rows["d"]["nsfw"] is None


def test_gold_aggregates_combine_before_every_shuffle(small):
    for build in (gold.daily_activity, gold.channel_summary, gold.hourly_activity):
        plan = build(small)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan, build.__name__
        for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
            if "Exchange hashpartitioning" in line:
                assert "HashAggregate" in below or "Project" in below, build.__name__


def test_percentiles_are_exact_and_keep_null_groups(spark):
    df = spark.range(30_001).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE 'g' END AS g", "CASE WHEN id % 7 > 0 THEN id END AS v"
    )
    got = {r["g"]: (r["lo"], r["hi"]) for r in percentiles(df, ["g"], "v", {"lo": 0.25, "hi": 0.9}).collect()}
    want = {}
    for g, keep in ((None, lambda i: i % 3 == 0), ("g", lambda i: i % 3 > 0)):
        values = [i for i in range(30_001) if keep(i) and i % 7 > 0]
        want[g] = tuple(values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.9))
    assert got == want


def test_buckets_follow_the_order_of_values(spark):
    values = [-1e300, -5.0, -1.01, -1.0, -1e-9, -0.0, 0.0, 1e-9, 0.5, 1.0, 1.001, 7.0, 7.03, 1e18, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["b"] for r in df.orderBy("i").select(value_bucket("v").alias("b")).collect()]
    assert got == sorted(got) and len(set(got)) > 10
    whole = spark.range(-3000, 3000).select(value_bucket("id").alias("b")).collect()
    assert [r["b"] for r in whole] == sorted(r["b"] for r in whole)
    null = spark.createDataFrame([(None,)], "v long").select(value_bucket("v").alias("b"))
    assert null.first()["b"] is None


def _hot(spark):
    """One group with most rows, one value with a third of them, groups and values that are null."""
    return spark.range(20_000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 50 = 1 THEN 'none' ELSE 'hot' END AS g",
        "CASE WHEN id % 50 = 1 OR id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 1.0D"
        " ELSE round((id * 7919 % 6007 - 3000) / 8.0D, 1) END AS v",
    )


def test_percentiles_of_a_hot_group(spark):
    rows = _hot(spark).collect()
    points = {"least": 0.0, "p01": 0.01, "p33": 0.33, "p50": 0.5, "p99": 0.99, "most": 1.0}
    got = {r["g"]: tuple(r[p] for p in points) for r in percentiles(_hot(spark), ["g"], "v", points).collect()}
    for group in ("hot", None, "none"):
        known = sorted(r["v"] for r in rows if r["g"] == group and r["v"] is not None)
        want = tuple(known[max(math.ceil(p * len(known)) - 1, 0)] if known else None for p in points.values())
        assert got[group] == want
    assert len(got) == 3
    whole = percentiles(_hot(spark), [], "v", {"p90": 0.9}).collect()
    known = sorted(r["v"] for r in rows if r["v"] is not None)
    assert [r["p90"] for r in whole] == [known[math.ceil(0.9 * len(known)) - 1]]


def test_value_ranks_equal_the_window_function(spark):
    df = _hot(spark)
    window = Window.partitionBy("g").orderBy(F.desc("v"))
    want = {(r["g"], r["v"], r["rk"]) for r in df.withColumn("rk", F.rank().over(window)).collect()}
    got = [(r["g"], r["v"], r["rk"]) for r in value_ranks(df, ["g"], "v", "rk").collect()]
    assert set(got) == want and len(got) == len(want)


def _windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]


def test_no_task_gets_a_whole_group(spark, small, tmp_path):
    """Windows over values are by bucket; those by group, or by nothing, add up a row a bucket."""
    for df in (
        percentiles(small, ["topic"], "score", {"p": 0.9}),
        percentiles(small, [], "score", {"p": 0.9}),
        profile.score_distribution(small),
        views.leaderboard(gold.channel_summary(small)),
    ):
        for line in _windows(df):
            # A channel's own scores may meet in one task.
            assert "_bucket#" in line or "sum(_in#" in line or "channel#" in line, line


def test_a_filter_on_either_rank_reaches_the_ranks(spark, small, tmp_path):
    path = str(tmp_path / "summary")
    gold.channel_summary(small).write.parquet(path)
    board = views.leaderboard(spark.read.parquet(path))
    for rank in ("rank_by_volume", "rank_by_avg_score"):
        plan = board.filter(f"{rank} <= 1")._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        filters = [i for i, line in enumerate(lines) if "Filter" in line and "<= 1" in line]
        joins = [i for i, line in enumerate(lines) if "Join Inner" in line]
        assert filters and min(filters) > min(joins), rank


def test_state_gives_the_same_aggregates(spark, small):
    more = small.unionByName(small.withColumn("topic", F.lit(None).cast("string")))
    more = more.unionByName(small.withColumns({"created_date": F.lit(None).cast("date"), "score": F.lit(None).cast("long")}))
    state = gold.activity_state(more)
    for direct, derived in (
        (gold.daily_activity(more), gold.daily_from_state(state)),
        (gold.channel_summary(more), gold.summary_from_state(state)),
        (gold.hourly_activity(more), gold.hourly_from_state(state)),
    ):
        assert direct.schema.names == derived.schema.names
        assert sorted(map(str, direct.collect())) == sorted(map(str, derived.collect()))


def test_summary_reads_its_events_once(spark, small, tmp_path):
    path = str(tmp_path / "events")
    small.write.parquet(path)
    df = gold.channel_summary(spark.read.parquet(path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def test_rolling_rows_and_calendar(small):
    daily = gold.daily_activity(small).filter("channel = 'c'")
    rows = views.daily_trend(daily).orderBy("created_date").collect()
    assert [r["events_rolling_7d"] for r in rows] == [3, 4]
    assert [r["event_count_dod_delta"] for r in rows] == [None, -2]
    days = views.daily_trend(daily, calendar=True).orderBy("created_date").collect()
    assert [r["events_rolling_7d"] for r in days] == [3, 1]
    assert tiles.volume_trend(views.daily_trend(daily), as_of=dt.date(2024, 4, 8)).count() == 1


def test_leaderboard_and_top_tile(small):
    board = views.leaderboard(gold.channel_summary(small))
    assert {r["channel"]: r["rank_by_volume"] for r in board.collect()} == {"c": 1, "d": 2}
    assert [r["channel"] for r in tiles.top_ranked_channels(board, 1).collect()] == ["c"]
    heat = views.heatmap(gold.hourly_activity(small))
    assert {r["day_label"] for r in heat.collect()} == {"Mon", "Wed"}
    assert tiles.activity_heatmap(heat).agg(F.sum("events")).first()[0] == 5


def test_topic_views_keep_unlabelled_topics(spark):
    post_topics = spark.createDataFrame(
        [("e1", "t", "c", DAY, 1, 0, 0.9), ("e2", "t", "c", DAY, 2, 0, 0.8), ("e3", "t", "c", DAY, 3, 5, 0.7)],
        "event_id string, topic string, channel string, created_date date, score long, "
        "dominant_topic int, topic_confidence double",
    )
    terms = spark.createDataFrame([(0, ["a", "b"], "a, b")], "topic_id int, terms array<string>, label string")
    labelled = {r["event_id"]: r["topic_label"] for r in views.topics_labeled(post_topics, terms).collect()}
    assert labelled == {"e1": "a, b", "e2": "a, b", "e3": None}
    shares = views.topic_share_daily(post_topics, terms)
    assert {r["dominant_topic"]: r["topic_share"] for r in shares.collect()} == {0: 0.6667, 5: 0.3333}
    tile = tiles.topic_share_over_time(shares, as_of=DAY).collect()
    assert [(r["topic_label"], r["topic_share_weighted"]) for r in tile] == [(None, 0.3333), ("a, b", 0.6667)]
    trend = {r["dominant_topic"]: r["avg_score"] for r in gold.topic_trends(post_topics).collect()}
    assert trend == {0: 1.5, 5: 3.0}
    assert [r["label"] for r in tiles.topic_dictionary(terms).collect()] == ["a, b"]


def test_sentiment_views(spark, small):
    labelled = small.withColumn(
        "sentiment_label", F.when(F.col("score") > 15, "positive").otherwise("negative")
    )
    rows = {(r["channel"], r["created_date"]): r for r in views.sentiment_breakdown(labelled).collect()}
    c = rows["c", DAY]
    assert (c["total"], c["positive"], c["negative"], c["neutral"]) == (3, 2, 1, 0)
    assert (c["positive_ratio"], c["net_sentiment"]) == (0.6667, 0.3333)
    daily = gold.sentiment_daily(labelled).filter("channel = 'd'").first()
    assert daily["net_sentiment"] == -1.0
    kpi = views.topic_kpis(gold.channel_summary(labelled), labelled).first()
    assert (kpi["channels"], kpi["total_events"], kpi["avg_net_sentiment"]) == (2, 5, -0.2)
    assert kpi["avg_score"] == 11.75 and kpi["avg_score_weighted"] == 14.6
    mix = tiles.sentiment_mix(views.sentiment_breakdown(labelled), 1).collect()
    assert [(r["channel"], r["positive"], r["negative"]) for r in mix] == [("c", 2, 2)]
    assert tiles.kpi_cards(views.topic_kpis(gold.channel_summary(labelled), labelled)).count() == 1
    assert tiles.sentiment_trend(views.sentiment_breakdown(labelled), as_of=DAY).count() == 2


def test_engagement_views(small):
    scored = small.withColumns(
        {
            "is_high_engagement": F.when(F.col("score") > 15, 1.0).otherwise(0.0),
            "engagement_probability": F.lit(0.25),
        }
    )
    summary = views.engagement_summary(scored)
    c = summary.filter(f"channel = 'c' AND created_date = DATE '{DAY}'").first()
    assert (c["scored_events"], c["predicted_high"], c["high_engagement_rate"]) == (3, 2, 0.6667)
    assert (c["avg_engagement_proba"], c["avg_actual_score"]) == (0.25, 20.33)
    rate = tiles.engagement_rate(summary).first()
    assert (rate["predicted_high_events"], rate["scored_events"], rate["high_engagement_rate"]) == (2, 5, 0.4)
    assert tiles.probability_vs_score(summary, min_events=3).count() == 1


def test_profile(small):
    assert profile.row_count(small).first()[0] == 5
    assert profile.null_ratios(small, ["channel_nsfw", "score"]).first().asDict() == {
        "channel_nsfw": 0.4,
        "score": 0.0,
    }
    spread = profile.score_distribution(small).first()
    assert spread["score_pcts"] == [5, 7, 10, 20, 31, 31]
    assert profile.word_distribution(small).first()["max_words"] == 3
    assert profile.daily_volume(small).count() == 2
    assert [r["channel"] for r in profile.top_channels(small, 1).collect()] == ["c"]
    assert profile.type_mix(small).count() == 2


def test_lookup_is_broadcast_only_within_its_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    names = spark.range(5).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        small_plan = join_lookup(big, names, ["k"])._jdf.queryExecution().executedPlan().toString()
        large = join_lookup(big, names, ["k"], max_rows=3)
        large_plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in small_plan
        assert "BroadcastHashJoin" not in large_plan
        assert large.filter("name IS NULL").count() == 0 and large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_are_queryable_from_sql(spark, small):
    names = views.register_views({"vw_board": views.leaderboard(gold.channel_summary(small))})
    assert names == ["vw_board"]
    assert spark.sql("SELECT max(rank_by_volume) FROM vw_board").first()[0] == 2
