import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakekit.operators.quality import (
    DataQualityError,
    measured_while_written,
    min_row_count,
    run_checks,
    unique,
)
from lakekit.operators.silver import to_events
from lakekit.plans import jobs
from lakekit.schema import EVENT_KEYS
from lakekit.session import staged, stored
from lakekit.sources import batches, versions
from lakekit.sources.bronze import add_lineage
from lakekit.sources.tables import upsert
from lakekit.workload import frames, queries

SETTINGS = jobs.ModelSettings(
    topic_count=3,
    topic_max_iterations=2,
    vocab_size=60,
    min_doc_freq=1,
    cv_folds=2,
    tree_depths=(2,),
    tree_iterations=(2, 3),
)


@pytest.fixture(scope="module")
def lake(spark, raw_posts, raw_comments, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw_posts.write.parquet(f"{root}/landing/ds/all_posts.parquet")
    raw_comments.write.parquet(f"{root}/landing/ds/all_comments.parquet")
    return {
        "landing": f"{root}/landing/ds",
        "bronze_dir": f"{root}/bronze",
        "events_path": f"{root}/silver/events",
        "gold_dir": f"{root}/gold",
        "model_dir": f"{root}/models",
    }


def _bronze(spark, lake, batch, at):
    return jobs.bronze_job(
        spark,
        base_dir=lake["landing"],
        topic="ds",
        batch_id=batch,
        bronze_dir=lake["bronze_dir"],
        ingested_at=at,
    )


def _silver(spark, lake):
    return jobs.silver_job(
        spark,
        bronze_dir=lake["bronze_dir"],
        events_path=lake["events_path"],
        as_of=dt.date(2024, 1, 31),
    )


def test_no_bronze_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no bronze"):
        jobs.silver_job(spark, bronze_dir=str(tmp_path), events_path=str(tmp_path / "e"))


def test_bronze_gate(spark, tmp_path):
    spark.createDataFrame([(None, "t", 1)], "id string, title string, score long").write.parquet(
        str(tmp_path / "a_posts.parquet")
    )
    with pytest.raises(DataQualityError):
        jobs.bronze_job(
            spark, base_dir=str(tmp_path), topic="t", batch_id="b", bronze_dir=str(tmp_path / "out")
        )


def test_jobs_end_to_end(spark, lake):
    reports = _bronze(spark, lake, "b1", dt.datetime(2024, 1, 3))
    assert set(reports) == {"posts", "comments"} and all(r.passed for r in reports.values())
    assert _silver(spark, lake).passed
    assert jobs.read_events(spark, lake["events_path"]).count() == 98

    # The same files landed again change nothing in silver.
    _bronze(spark, lake, "b2", dt.datetime(2024, 1, 4))
    _silver(spark, lake)
    events = jobs.read_events(spark, lake["events_path"])
    assert events.count() == 98 and events.select("event_id").distinct().count() == 98

    jobs.gold_job(spark, events_path=lake["events_path"], gold_dir=lake["gold_dir"])
    daily = spark.read.parquet(f"{lake['gold_dir']}/daily_activity")
    assert daily.agg(F.sum("event_count")).first()[0] == 98
    assert spark.read.parquet(f"{lake['gold_dir']}/channel_summary").count() == 3
    hourly = spark.read.parquet(f"{lake['gold_dir']}/hourly_activity")
    assert hourly.agg(F.sum("event_count")).first()[0] == 98

    paths = {k: lake[k] for k in ("events_path", "gold_dir", "model_dir")}
    metrics = jobs.train_job(spark, settings=SETTINGS, **paths)
    assert set(metrics) == {"sentiment", "engagement"}
    for name in ("post_topics", "post_sentiment", "engagement_predictions"):
        assert spark.read.parquet(f"{lake['gold_dir']}/{name}").count() == 98
    assert spark.read.parquet(f"{lake['gold_dir']}/topic_terms").count() == 3
    trends = spark.read.parquet(f"{lake['gold_dir']}/topic_trends")
    assert trends.agg(F.sum("event_count")).first()[0] == 98
    jobs.score_job(spark, **paths)
    frames = jobs.open_gold(spark, lake["gold_dir"])
    assert sum(name.startswith("vw_") for name in frames) == 8
    tile = spark.sql(
        "SELECT topic, total_events FROM vw_topic_kpis ORDER BY total_events DESC"
    ).collect()
    assert [(r["topic"], r["total_events"]) for r in tile] == [("ds", 98)]
    top = spark.sql("SELECT channel FROM vw_channel_leaderboard WHERE rank_by_volume <= 1")
    assert [r["channel"] for r in top.collect()] == ["engineering"]
    mix = spark.read.parquet(f"{lake['gold_dir']}/sentiment_daily")
    assert mix.agg(F.sum("event_count")).first()[0] == 98


def _land(spark, folder, rows):
    schema = "id string, `channel.name` string, created_utc long, title string, selftext string, score long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/posts.parquet")
    return folder


def _posts(ids, text="a", at=1704067200):
    return [(i, "c", at, f"title {i}", text, 1) for i in ids]


def test_each_batch_is_taken_in_once(spark, tmp_path, monkeypatch):
    """No text is read without a new batch; a run that stops anywhere is run again."""
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "events")
    run = lambda **o: jobs.silver_job(spark, bronze_dir=bronze, events_path=path, **o)

    def land(n, rows, **options):
        folder = _land(spark, str(tmp_path / f"in{n}"), rows)
        jobs.bronze_job(spark, base_dir=folder, topic="t", batch_id=f"b{n}", bronze_dir=bronze,
                        ingested_at=dt.datetime(2024, 2, n), **options)

    ids = lambda: {r["event_id"]: r["text"] for r in jobs.read_events(spark, path).collect()}
    land(1, _posts(["1", "2"]))
    assert run().passed and set(ids()) == {"post_1", "post_2"}
    first = versions.known_versions(spark, path)

    def forbidden(*args, **kwargs):
        raise AssertionError("bronze was read")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "read_parquet", forbidden)
        assert run().results == [] and versions.known_versions(spark, path) == first

    land(2, _posts(["2", "3"], text="new"))
    # The gate has passed, the upsert does not finish: nothing is taken in.
    with monkeypatch.context() as patched:
        patched.setattr(versions, "commit", forbidden)
        with pytest.raises(AssertionError):
            run()
    assert set(ids()) == {"post_1", "post_2"}
    run()
    assert ids() == {"post_1": "title 1 a", "post_2": "title 2 new", "post_3": "title 3 new"}
    taken = {r["taken"] for r in versions.taken_names(spark, path).collect()}
    assert taken == {"posts/t/b1", "posts/t/b2"}
    before = sorted(map(str, jobs.read_events(spark, path).collect()))
    run(again=True)
    assert sorted(map(str, jobs.read_events(spark, path).collect())) == before
    # Other topics and earlier days are left for later.
    land(3, _posts(["4"]))
    assert run(topics=["other"]).results == [] and run(since=dt.date(2024, 2, 4)).results == []
    assert run().passed and "post_4" in ids()


def test_batches_with_other_columns(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "events")
    plain = spark.createDataFrame([("1", "c", 1704067200, "one", 1)], "id string, `channel.name` string, created_utc long, title string, score long")
    for n, df in enumerate([plain, plain.withColumn("url", F.lit("u")).withColumn("id", F.lit("2"))], start=1):
        df.write.parquet(str(tmp_path / f"in{n}" / "posts.parquet"))
        jobs.bronze_job(spark, base_dir=str(tmp_path / f"in{n}"), topic="t", batch_id=f"b{n}", bronze_dir=bronze)
    jobs.silver_job(spark, bronze_dir=bronze, events_path=path)
    assert {r["event_id"]: r["url"] for r in jobs.read_events(spark, path).collect()} == {"post_1": None, "post_2": "u"}
    other = plain.withColumn("score", F.lit("many"))
    other.write.parquet(str(tmp_path / "in3" / "posts.parquet"))
    jobs.bronze_job(spark, base_dir=str(tmp_path / "in3"), topic="t", batch_id="b3", bronze_dir=bronze)
    with pytest.raises(ValueError, match="column score"):
        jobs.silver_job(spark, bronze_dir=bronze, events_path=path, again=True)


def test_a_bronze_folder_without_notes_is_read_whole(spark, tmp_path, raw_posts):
    at = dt.datetime(2024, 2, 1)
    raw = add_lineage(raw_posts, topic="007", batch_id="b", ingested_at=at)
    raw.write.partitionBy("_topic", "_ingest_date").parquet(str(tmp_path / "bronze" / "posts_raw"))
    for _ in range(2):
        jobs.silver_job(spark, bronze_dir=str(tmp_path / "bronze"), events_path=str(tmp_path / "events"))
    got = jobs.read_events(spark, str(tmp_path / "events"))
    assert got.count() == 50 and got.select("topic").distinct().collect()[0]["topic"] == "007"


def test_null_ids_are_set_aside_and_audited(spark, tmp_path):
    bronze, path, audit, aside = (str(tmp_path / n) for n in ("bronze", "events", "audit", "aside"))
    rows = [*_posts(["1", "2"]), *_posts([None, None])]

    def land(n, rows):
        folder = _land(spark, str(tmp_path / f"in{n}"), rows)
        return jobs.bronze_job(spark, base_dir=folder, topic="t", batch_id="b1", bronze_dir=bronze,
                               quarantine_path=aside, audit_path=audit)["posts"]

    report = land(1, rows)
    assert not report.passed and [r.violating_rows for r in report.results] == [0, 2]
    set_aside = batches.read_quarantine(spark, aside)
    assert [r["failed_rules"] for r in set_aside.collect()] == [["not_null(id)"]] * 2
    assert '"title":"title None"' in set_aside.first()["row"] and "channel.name" in set_aside.first()["row"]
    jobs.silver_job(spark, bronze_dir=bronze, events_path=path, audit_path=audit, run_id="r")
    assert jobs.read_events(spark, path).count() == 2
    stored = {(r["job"], r["batch"]): r["n"] for r in batches.read_audit(spark, audit).groupBy("job", "batch").agg(F.count("*").alias("n")).collect()}
    assert stored == {("bronze t/posts", "b1"): 2, ("silver", "r"): 6}
    # The same batch again, mended: its rows in both tables are replaced.
    assert land(2, _posts(["1", "2"])).passed
    assert batches.read_quarantine(spark, aside).isEmpty()
    bronze_rows = batches.read_audit(spark, audit).filter("job = 'bronze t/posts'")
    assert [r["violating_rows"] for r in bronze_rows.orderBy("position").collect()] == [0, 0]


def test_silver_sets_null_ids_aside_too(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    raw = spark.createDataFrame([("1", "one", 1), (None, "two", 1)], "id string, title string, score long")
    raw = add_lineage(raw, topic="t", batch_id="b", ingested_at=dt.datetime(2024, 2, 1))
    raw.write.partitionBy("_topic", "_ingest_date").parquet(f"{bronze}/posts_raw")
    with pytest.raises(DataQualityError):
        jobs.silver_job(spark, bronze_dir=bronze, events_path=str(tmp_path / "events"))
    # The time of the event is unknown here, which the silver gate does not let pass.
    with pytest.raises(DataQualityError, match="created_ts"):
        jobs.silver_job(spark, bronze_dir=bronze, events_path=str(tmp_path / "events"), quarantine_path=str(tmp_path / "aside"))
    rows = batches.read_quarantine(spark, str(tmp_path / "aside")).collect()
    assert [(r["kind"], r["topic"], r["batch_id"]) for r in rows] == [("posts", "t", "b")]


def test_silver_gate_measures_while_events_are_staged(spark, raw_posts, monkeypatch):
    """The same verdicts as from a scan of their own."""
    events = to_events(raw_posts.unionByName(raw_posts), topic="t")
    rules = [*jobs.silver_rules(jobs.QualityLimits(min_score=0), as_of=dt.date(2024, 1, 31)), min_row_count(60)]
    watched, measured = measured_while_written(events, rules)
    with staged(watched, "gate") as written:
        report = measured(written)
        assert report == run_checks(written, rules)
    assert [r.passed for r in report.results] == [True, True, True, False, True, True, False]
    only_keys, measured = measured_while_written(events, [unique(["channel"])])
    assert only_keys is events and measured(events).results[0].violating_rows == 48


def test_incremental_silver_builds_the_same_table(spark, tmp_path):
    schema = "id string, `channel.name` string, created_utc long, title string, selftext string, score long"
    days = [
        [("1", "c", 1704067200, "one", "a", 1), ("2", "c", 1704067200, "two", "b", 2)],
        [("2", "c", 1704153600, "two again", "B", 9), ("3", "c", 1704153600, "three", "c", 3)],
        [("1", "c", 1704067200, None, "[removed]", 5), ("4", "c", 1704240000, "four", "d", 4)],
    ]
    bronze, step, whole = (str(tmp_path / n) for n in ("bronze", "step", "whole"))
    for day, rows in enumerate(days, start=1):
        landing = str(tmp_path / f"landing{day}")
        spark.createDataFrame(rows, schema).write.parquet(f"{landing}/posts.parquet")
        jobs.bronze_job(
            spark,
            base_dir=landing,
            topic="007",
            batch_id=f"b{day}",
            bronze_dir=bronze,
            ingested_at=dt.datetime(2024, 2, day),
        )
        jobs.silver_job(spark, bronze_dir=bronze, events_path=step, since=dt.date(2024, 2, day))
    jobs.silver_job(spark, bronze_dir=bronze, events_path=whole)
    got = jobs.read_events(spark, step)
    want = jobs.read_events(spark, whole)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {r["topic"] for r in got.collect()} == {"007"}
    assert {r["event_id"]: r["title"] for r in got.collect()} == {
        "post_1": "one",
        "post_2": "two again",
        "post_3": "three",
        "post_4": "four",
    }


def _gold_rows(spark, gold_dir):
    names = ("daily_activity", "channel_summary", "hourly_activity")
    return {n: sorted(map(str, spark.read.parquet(f"{gold_dir}/{n}").collect())) for n in names}


def test_gold_after_batches_equals_a_full_run(spark, tmp_path, events):
    """A key that moves to another day, a day that loses its last row, and days that stay."""
    path, step, whole = (str(tmp_path / n) for n in ("events", "step", "whole"))
    moved = events.filter("event_id IN ('post_p00001', 'post_p00049')").withColumns(
        {
            "created_date": F.date_add("created_date", 5),
            "created_ts": F.col("created_ts") + F.expr("INTERVAL 5 DAYS"),
            "score": F.col("score") + 100,
        }
    )
    later = events.filter("event_id = 'comment_c00002'").withColumn("event_id", F.lit("comment_new"))
    for batch in (events, moved.unionByName(later)):
        upsert(batch, path, EVENT_KEYS, partition_by=jobs.EVENT_PARTITIONS)
        jobs.gold_job(spark, events_path=path, gold_dir=step)
    jobs.gold_job(spark, events_path=path, gold_dir=whole)
    assert _gold_rows(spark, step) == _gold_rows(spark, whole)
    # Only days the second batch touches were folded again, and nothing without a new version.
    days = lambda v: {r["part"]: r["folder"] for r in versions.listing(spark, f"{step}/activity_state", v).collect() if r["folder"]}
    first, second = days(1), days(2)
    assert {p for p in first if p in second and first[p] == second[p]}
    jobs.gold_job(spark, events_path=path, gold_dir=step)
    assert versions.known_versions(spark, f"{step}/activity_state") == [1, 2]
    assert _gold_rows(spark, step) == _gold_rows(spark, whole)
    # Once the version that the state knows is forgotten, it is built anew.
    upsert(later.withColumn("score", F.lit(1).cast("long")), path, EVENT_KEYS, partition_by=jobs.EVENT_PARTITIONS)
    versions.forget_versions(spark, path, keep=1)
    for gold_dir in (step, whole):
        jobs.gold_job(spark, events_path=path, gold_dir=gold_dir)
    assert _gold_rows(spark, step) == _gold_rows(spark, whole)
    with pytest.raises(RuntimeError, match="no events"):
        jobs.gold_job(spark, events_path=str(tmp_path / "none"), gold_dir=step)


@pytest.fixture
def posts_dir(spark, tmp_path):
    text = F.concat_ws(" ", F.lit("text"), "id").alias("text")
    documents = spark.range(40).select(F.col("id").alias("doc_id"), text, F.lit("en").alias("lang"))
    documents.withColumns({"source": F.lit("s"), "n_chars": F.lit(90)}).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.range(0, 40, 4).selectExpr("id AS doc_id", "0 AS quality", "CAST(id % 8 = 0 AS INT) AS toxic")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    columns = "conv_id long, turn int, role string, text string"
    spark.createDataFrame([(1, 1, "user", "x" * 80)], columns).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_redelivered_posts_move_texts_with_a_label_only(spark, posts_dir):
    again = frames.relabelled_posts(spark, posts_dir)
    assert {r["id"] for r in again.select("id").collect()} == {str(i) for i in range(0, 40, 4)}
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    # Deeper in the plan is earlier: the semi-join comes before the texts are spread.
    assert plan.index("Repartition") < plan.index("LeftSemi")


def test_landed_posts_are_read_once(spark, posts_dir, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    monkeypatch.setattr(queries, "stored", noted, raising=False)
    paths = queries._landed_lake(spark, posts_dir)
    assert plans[0].count("Repartition") == 1
    landed = spark.read.parquet(paths["bronze_dir"].replace("/bronze", "/landing/docs/posts.parquet"))
    ids = [r["id"] for r in landed.select("id").collect()]
    assert ids.count(None) == 5 and sorted(i for i in ids if i) == sorted(map(str, range(40)))
