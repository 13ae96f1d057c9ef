import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.session import shared_folder, stage, staged
from lakekit.sources.bronze import add_lineage, bronze_frames, read_optional
from lakekit.plans import sql, views
from lakekit.sources.tables import (
    Buckets,
    clustered,
    merge_rows,
    read_parquet,
    read_table,
    spread_small,
    table_exists,
    upsert,
    write_clustered,
    write_path,
    write_table,
)
from lakekit.sources.versions import read_version

SCHEMA = "k long, topic string, day date, v string"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _rows(spark, path):
    df = read_version(spark, path, _parse(SCHEMA))
    return sorted((r["k"], r["topic"], r["day"], r["v"]) for r in df.collect())


def _parse(ddl):
    return StructType.fromDDL(ddl)


def test_read_optional(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "none" / "*.parquet")) is None
    spark.range(3).write.parquet(str(tmp_path / "a_posts.parquet"))
    assert read_optional(spark, str(tmp_path / "*posts*.parquet")).count() == 3
    (tmp_path / "bad.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        read_optional(spark, str(tmp_path / "bad.parquet")).count()
    assert not (isinstance(error.value, AnalysisException) and "PATH_NOT_FOUND" in str(error.value))


def test_bronze_frames_omit_missing_kinds(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "x_posts_1.parquet"))
    at = dt.datetime(2024, 2, 3, 4, 5)
    found = bronze_frames(spark, base_dir=str(tmp_path), topic="t", batch_id="b", ingested_at=at)
    assert list(found) == ["posts"]
    row = found["posts"].first()
    assert (row["_topic"], row["_batch_id"], row["_ingested_at"]) == ("t", "b", at)
    assert row["_ingest_date"] == at.date()


def test_lineage_uses_the_clock_by_default(spark):
    row = add_lineage(spark.range(1), topic="t", batch_id="b").first()
    assert row["_ingest_date"] == row["_ingested_at"].date()


def test_merge_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k long, v string")
    source = spark.createDataFrame([(3, "C"), (4, "D"), (None, "m")], "k long, v string")
    got = merge_rows(target, source, ["k"]).collect()
    assert sorted(r["v"] for r in got) == ["C", "D", "a", "b", "m", "n"]


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame(
        [(1, "a", D1, "x"), (2, "a", D2, "x"), (3, "b/c d", D1, "x"), (4, "b/c d", D2, "x")], SCHEMA
    )
    upsert(first, path, ["topic", "k"], partition_by=["topic", "day"])
    before = set(read_version(spark, path, _parse(SCHEMA)).inputFiles())
    source = spark.createDataFrame([(2, "a", D2, "y"), (5, "a", D2, "y")], SCHEMA)
    upsert(source, path, ["topic", "k"], partition_by=["topic", "day"])
    assert _rows(spark, path) == [
        (1, "a", D1, "x"),
        (2, "a", D2, "y"),
        (3, "b/c d", D1, "x"),
        (4, "b/c d", D2, "x"),
        (5, "a", D2, "y"),
    ]
    after = set(read_version(spark, path, _parse(SCHEMA)).inputFiles())
    assert len(before & after) == 3


@pytest.mark.parametrize("topic", ["a", "b/c d", "50%:x", "a+b é}{", None])
def test_upsert_moves_a_key_between_partitions(spark, tmp_path, topic):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([(1, topic, D1, "x"), (2, "z", D2, "x")], SCHEMA), path, ["k"], partition_by=["topic", "day"])
    moved = spark.createDataFrame([(1, "z", D2, "y")], SCHEMA)
    upsert(moved, path, ["k"], partition_by=["topic", "day"])
    assert _rows(spark, path) == [(1, "z", D2, "y"), (2, "z", D2, "x")]


def test_upsert_rejects_duplicate_keys(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a", D1, "x"), (1, "a", D1, "y")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate"):
        upsert(twice, str(tmp_path / "t"), ["k"], partition_by=["day"])
    with pytest.raises(ValueError, match="partition"):
        upsert(twice, str(tmp_path / "t"), ["k"], partition_by=[])


batches = st.lists(
    st.dictionaries(st.integers(0, 6), st.sampled_from("abc"), max_size=5), min_size=1, max_size=3
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_upsert_laws(spark, tmp_path_factory, data):
    """Keys stay unique, the last write wins, untouched keys stay, a repeat changes nothing."""
    path = str(tmp_path_factory.mktemp("laws") / "t")
    want = {}
    for batch in data:
        rows = [(k, None, dt.date(2024, 1, 1 + ord(v) - ord("a")), v) for k, v in batch.items()]
        source = spark.createDataFrame(rows, SCHEMA)
        for _ in range(2):
            upsert(source, path, ["k"], partition_by=["day"])
            want.update(batch)
            got = read_version(spark, path, _parse(SCHEMA)).collect()
            assert sorted((r["k"], r["v"]) for r in got) == sorted(want.items())


def test_clustered_layout_keeps_rows_and_splits_a_hot_value(spark, tmp_path):
    df = spark.range(3000).withColumn("c", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")))
    sizes = (
        clustered(df, ["c"], spread_by=["id"], files=6)
        .groupBy(F.spark_partition_id())
        .count()
        .collect()
    )
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 1000
    path = str(tmp_path / "t")
    write_clustered(df, path, ["c"], spread_by=["id"])
    assert read_parquet(spark, path).exceptAll(df).isEmpty()
    assert read_parquet(spark, path).count() == 3000


def test_tables_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS lakekit_t")
    assert not table_exists(spark, "lakekit_t")
    df = spark.createDataFrame([(1, "a", D1, "x")], SCHEMA)
    write_table(df, "lakekit_t", partition_by=["day"], comment="it's a table")
    write_table(df, "lakekit_t", mode="append", partition_by=["day"])
    assert table_exists(spark, "lakekit_t") and read_table(spark, "lakekit_t").count() == 2
    spark.sql("DROP TABLE lakekit_t")


def test_bucketed_table_joins_without_a_shuffle_of_its_own(spark, tmp_path):
    df = spark.range(2000).selectExpr("id % 7 AS t", "id AS k", "id * 2 AS v")
    spark.sql("DROP TABLE IF EXISTS lakekit_b")
    write_table(df, "lakekit_b", buckets=Buckets(4, ("t", "k")), path=str(tmp_path / "b"))
    source = spark.range(1990, 2010).selectExpr("id % 7 AS t", "id AS k", "-id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = merge_rows(read_table(spark, "lakekit_b"), source, ["t", "k"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        got = {r["k"]: r["v"] for r in merged.collect()}
        assert len(got) == 2010 and got[1989] == 3978 and got[1995] == -1995
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP TABLE lakekit_b")


def test_stored_views_and_tiles_with_parameters(spark, tmp_path):
    daily = spark.createDataFrame(
        [("t'x", "c", dt.date(2024, 1, d), d, 1, 1, 1.0, 1, 1, 1.0) for d in range(1, 11)],
        "topic string, channel string, created_date date, event_count long, post_count long, comment_count long, "
        "avg_score double, median_score long, total_score long, avg_word_count double",
    )
    write_table(daily, "lakekit_daily", path=str(tmp_path / "d"))
    stored = sql.create_views(spark, {"daily_activity": "lakekit_daily", "hourly_activity": "not_there"}, "own_")
    assert stored == {"vw_channel_daily_trend": "own_vw_channel_daily_trend"}
    rows = sql.tile(spark, "volume_trend", stored, as_of=dt.date(2024, 1, 10), days=2).collect()
    assert [(r["topic"], r["events_rolling_7d"]) for r in rows] == [("t'x", 35), ("t'x", 42), ("t'x", 49)]
    frame = views.daily_trend(daily)
    view = spark.table("own_vw_channel_daily_trend")
    assert view.columns == frame.columns and view.exceptAll(frame).isEmpty()
    # A stored view shows what its table holds later.
    write_table(daily.limit(1), "lakekit_daily", mode="append")
    assert spark.table("own_vw_channel_daily_trend").count() == 11
    spark.sql("DROP VIEW own_vw_channel_daily_trend")
    spark.sql("DROP TABLE lakekit_daily")


def test_append_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", D1, "x"), (2, "b", D1, "x")], SCHEMA)
    write_path(df, path, mode="append", partition_by=["topic"], rebalance=False)
    write_path(df, path, mode="append", partition_by=["topic"])
    assert spark.read.parquet(path).filter("topic = 'a'").count() == 2
    ordered = str(tmp_path / "ordered")
    many = spark.range(100).selectExpr("id % 2 AS p", "(id * 37) % 100 AS c")
    write_path(many, ordered, partition_by=["p"], cluster_by=["c"])
    values = [r["c"] for r in spark.read.parquet(f"{ordered}/p=0").collect()]
    assert values == sorted(values) and len(values) == 50


def test_stage_and_spread(spark):
    df = spark.range(5).withColumn("x", F.lit("y"))
    kept = stage(df, "unit")
    assert kept.schema.names == ["id", "x"] and kept.count() == 5
    assert kept.inputFiles()[0].startswith(f"file://{shared_folder(spark)}")
    with staged(df, "block") as frame:
        assert frame.count() == 5
        folder = Path(urlparse(frame.inputFiles()[0]).path).parent
        assert folder.is_relative_to(shared_folder(spark))
    assert spark.read.parquet(str(folder)).count() == 0
    assert spread_small(kept).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 50)
    assert spread_small(many) is many
