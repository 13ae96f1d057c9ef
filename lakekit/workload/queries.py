"""Registered queries by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.functions.text import clean_text, tokens, word_count
from lakekit.ml import engagement, features, metrics, models, scoring, sentiment, topics
from lakekit.operators import gold, labels, profile, quality, silver
from lakekit.plans import jobs, sql, tiles, views
from lakekit.schema import EVENT_KEYS
from lakekit.session import configure, shared_folder, stage, staged, stored
from lakekit.sources import batches, bronze, tables
from lakekit.workload import frames
from lakekit.workload.frames import AS_OF, FIRST_INGEST, SECOND_INGEST

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# The registered fits run with the defaults of the jobs.
SETTINGS = jobs.ModelSettings()
TEXT_FEATURES = {
    "vocab_size": SETTINGS.vocab_size,
    "min_token_length": SETTINGS.min_token_length,
    "min_doc_freq": SETTINGS.min_doc_freq,
    "seed": SETTINGS.seed,
}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query that writes."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """Sums of fractions end in digits that depend on the order of addition."""
    return df.withColumn(column, F.round(column, 9))


# --- sources and sinks -------------------------------------------------------


@query
def bronze_posts(spark, sf_dir):
    folder = _run_folder(spark, "landing")
    frames.raw_posts(spark, sf_dir).write.parquet(f"{folder}/all_posts.parquet")
    found = bronze.bronze_frames(
        spark, base_dir=folder, topic="docs", batch_id="b1", ingested_at=FIRST_INGEST
    )
    return silver.flatten_community(found["posts"])


@query
def upsert(spark, sf_dir):
    target, source = _upsert_sides(spark, sf_dir)
    return tables.merge_rows(target, source, EVENT_KEYS)


@query
def upsert_partitions(spark, sf_dir):
    path = _run_folder(spark, "upsert")
    for side in _upsert_sides(spark, sf_dir):
        with staged(side, "upsert_side") as source:
            tables.upsert(source, path, EVENT_KEYS, partition_by=jobs.EVENT_PARTITIONS)
    return jobs.read_events(spark, path)


def _upsert_sides(spark, sf_dir):
    again = frames.relabelled_posts(spark, sf_dir).withColumn("_topic", F.col("domain"))
    comments = frames.raw_comments(spark, sf_dir).withColumn("_topic", F.lit("chat"))
    source = silver.to_events(again, comments, topic=F.col("_topic"))
    return frames.post_events(spark, sf_dir), source


def _named_table(spark, df: DataFrame, name: str, **layout) -> str:
    """A catalog table of its own, with its files in the shared folder."""
    full = f"{name}_{uuid.uuid4().hex}"
    path = _run_folder(spark, name)
    tables.write_table(df, full, path=path, comment=f"{name} of one run", **layout)
    return full


@query
def upsert_named(spark, sf_dir):
    """The upsert against a table that is kept in buckets by the event key."""
    stored, source = _upsert_sides(spark, sf_dir)
    layout = tables.Buckets(int(spark.conf.get("spark.sql.shuffle.partitions")), tuple(EVENT_KEYS))
    name = _named_table(spark, stored, "events", buckets=layout)
    return tables.merge_rows(tables.read_table(spark, name), stage(source, "source"), EVENT_KEYS)


@query
def layout_rewrite(spark, sf_dir):
    path = _run_folder(spark, "layout")
    events = frames.timed_events(spark, sf_dir)
    tables.write_clustered(events, path, ["channel", "created_date"], spread_by=["event_id"])
    return tables.read_parquet(spark, path, events.schema)


# --- silver ------------------------------------------------------------------


@query
def silver_events(spark, sf_dir):
    return frames.silver_events(spark, sf_dir)


@query
def silver_events_scrubbed(spark, sf_dir):
    posts = frames.raw_posts(spark, sf_dir)
    return silver.to_events(posts, topic=F.col("domain"), scrub_placeholders=True)


@query
def normalize_raw(spark, sf_dir):
    posts = silver.normalize_raw(
        frames.raw_posts(spark, sf_dir), event_type="post", topic=F.col("domain")
    )
    comments = silver.normalize_raw(
        frames.raw_comments(spark, sf_dir), event_type="comment", topic="chat"
    )
    return posts.unionByName(comments)


@query
def cleaned_text(spark, sf_dir):
    docs = frames.texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query
def text_metrics(spark, sf_dir):
    docs = frames.texts(spark, sf_dir, "documents", "doc_id", "text")
    cleaned = docs.select("doc_id", clean_text(F.col("text")).alias("cleaned"))
    return cleaned.select(
        "doc_id",
        F.length("cleaned").cast("long").alias("text_length"),
        word_count(F.col("cleaned")).alias("word_count"),
    )


@query
def dedup_events(spark, sf_dir):
    first = frames.raw_posts(spark, sf_dir).withColumn("_ingested_at", F.lit(FIRST_INGEST))
    second = frames.relabelled_posts(spark, sf_dir).withColumn("_ingested_at", F.lit(SECOND_INGEST))
    return silver.to_events(first.unionByName(second), topic=F.col("domain"))


# --- gold --------------------------------------------------------------------


@query
def daily_activity(spark, sf_dir):
    return gold.daily_activity(frames.timed_events(spark, sf_dir))


@query
def daily_activity_silver(spark, sf_dir):
    return gold.daily_activity(frames.silver_events(spark, sf_dir))


@query
def channel_summary(spark, sf_dir):
    return gold.channel_summary(frames.timed_events(spark, sf_dir))


@query
def channel_summary_silver(spark, sf_dir):
    return gold.channel_summary(frames.narrow_events(spark, sf_dir))


@query
def hourly_activity(spark, sf_dir):
    heat = gold.hourly_activity(frames.timed_events(spark, sf_dir))
    return heat.orderBy("topic", "created_dow", "created_hour")


@query
def topic_trends(spark, sf_dir):
    trends = gold.topic_trends(frames.post_topics(spark, sf_dir))
    trends = _rounded(trends, "avg_confidence")
    return trends.orderBy("topic", "created_date", "dominant_topic")


@query
def sentiment_daily(spark, sf_dir):
    return gold.sentiment_daily(frames.post_sentiment(spark, sf_dir))


# --- views -------------------------------------------------------------------


@query
def view_daily_trend(spark, sf_dir):
    return views.daily_trend(gold.daily_activity(frames.timed_events(spark, sf_dir)))


@query
def view_daily_trend_calendar(spark, sf_dir):
    daily = gold.daily_activity(frames.timed_events(spark, sf_dir))
    return views.daily_trend(daily, calendar=True)


@query
def view_leaderboard(spark, sf_dir):
    # The ranks read the summary more than once, as they do the stored gold table.
    summary = stage(gold.channel_summary(frames.timed_events(spark, sf_dir)), "channel_summary")
    return views.leaderboard(summary)


@query
def view_heatmap(spark, sf_dir):
    return views.heatmap(gold.hourly_activity(frames.timed_events(spark, sf_dir)))


@query
def view_topics_labeled(spark, sf_dir):
    assigned = stage(frames.post_topics(spark, sf_dir), "post_topics")
    labelled = views.topics_labeled(assigned, frames.topic_terms(assigned))
    return labelled.withColumn("topic_terms", F.array_join("topic_terms", "|"))


@query
def view_topic_share(spark, sf_dir):
    assigned = stage(frames.post_topics(spark, sf_dir), "post_topics")
    return views.topic_share_daily(assigned, frames.topic_terms(assigned))


@query
def view_sentiment_breakdown(spark, sf_dir):
    return views.sentiment_breakdown(frames.post_sentiment(spark, sf_dir))


@query
def view_engagement_summary(spark, sf_dir):
    return views.engagement_summary(frames.engagement_predictions(spark, sf_dir))


@query
def view_topic_kpis(spark, sf_dir):
    labelled = labels.weak_sentiment(frames.narrow_events(spark, sf_dir))
    return views.topic_kpis(gold.channel_summary(labelled), labelled)


# --- dashboard tiles ---------------------------------------------------------


@query
def tile_01(spark, sf_dir):
    return tiles.kpi_cards(view_topic_kpis(spark, sf_dir))


@query
def tile_02(spark, sf_dir):
    return tiles.volume_trend(view_daily_trend(spark, sf_dir), as_of=AS_OF)


@query
def tile_03(spark, sf_dir):
    return tiles.top_ranked_channels(view_leaderboard(spark, sf_dir))


@query
def tile_04(spark, sf_dir):
    return tiles.activity_heatmap(view_heatmap(spark, sf_dir))


@query
def tile_05(spark, sf_dir):
    shares = tiles.topic_share_over_time(view_topic_share(spark, sf_dir), as_of=AS_OF)
    return _rounded(shares, "topic_share")


@query
def tile_06(spark, sf_dir):
    terms = tiles.topic_dictionary(frames.topic_terms(frames.post_topics(spark, sf_dir)))
    return terms.withColumn("terms", F.array_join("terms", "|"))


@query
def tile_07(spark, sf_dir):
    trend = tiles.sentiment_trend(view_sentiment_breakdown(spark, sf_dir), as_of=AS_OF)
    return _rounded(trend, "net_sentiment")


@query
def tile_08(spark, sf_dir):
    return tiles.sentiment_mix(view_sentiment_breakdown(spark, sf_dir))


@query
def tile_09(spark, sf_dir):
    return tiles.engagement_rate(view_engagement_summary(spark, sf_dir))


@query
def tile_10(spark, sf_dir):
    return tiles.probability_vs_score(view_engagement_summary(spark, sf_dir))


def _sql_tile(name: str, table: str, frame: Callable, columns: tuple = (), **parameters) -> Query:
    """A tile by SQL text alone: gold in a named table, the view stored over it."""

    def run(spark, sf_dir):
        named = {table: _named_table(spark, frame(spark, sf_dir), table)}
        stored = sql.create_views(spark, named, prefix=f"v_{uuid.uuid4().hex}_")
        df = sql.tile(spark, name, stored, **parameters)
        for column in columns:
            df = _rounded(df, column)
        return df

    run.__name__ = f"sql_{name}"
    return query(run)


_sql_tile("volume_trend", "daily_activity", lambda *a: daily_activity(*a), as_of=AS_OF)
_sql_tile("activity_heatmap", "hourly_activity", lambda *a: hourly_activity(*a))
_sql_tile("sentiment_trend", "post_sentiment", frames.post_sentiment, ("net_sentiment",), as_of=AS_OF)
_sql_tile("sentiment_mix", "post_sentiment", frames.post_sentiment)


# --- data quality ------------------------------------------------------------


def dq_rules() -> dict[str, quality.Rule]:
    return {
        "dq_not_null": quality.not_null(["event_id", "channel_nsfw"]),
        "dq_unique": quality.unique(["channel", "created_date"]),
        "dq_in_range": quality.in_range("score", 0, 300),
        "dq_accepted_values": quality.accepted_values("event_type", ["post"]),
        "dq_min_rows": quality.min_row_count(1_000_000),
        "dq_null_ratio": quality.max_null_ratio("channel_nsfw", 0.02),
        "dq_freshness": quality.freshness("created_ts", 30, as_of=AS_OF),
    }


def _dq_query(name: str) -> None:
    def run(spark, sf_dir):
        return quality.quality_frame(frames.timed_events(spark, sf_dir), [dq_rules()[name]])

    run.__name__ = name
    query(run)


for _name in dq_rules():
    _dq_query(_name)


@query
def dq_report(spark, sf_dir):
    events = frames.timed_events(spark, sf_dir)
    return quality.quality_frame(events, list(dq_rules().values()))


@query
def dq_silver_gate(spark, sf_dir):
    rules = jobs.silver_rules(jobs.QualityLimits(), as_of=AS_OF)
    return quality.quality_frame(frames.narrow_events(spark, sf_dir), rules)


@query
def dq_quarantine(spark, sf_dir):
    _, bad = quality.quarantine(frames.timed_events(spark, sf_dir), list(dq_rules().values()))
    return bad.select("event_id", "score", F.array_join("failed_rules", "; ").alias("failed_rules"))


# --- profiling ---------------------------------------------------------------


@query
def profile_rows(spark, sf_dir):
    return profile.row_count(frames.timed_events(spark, sf_dir))


@query
def profile_mix(spark, sf_dir):
    return profile.type_mix(frames.timed_events(spark, sf_dir)).orderBy("topic", "event_type")


@query
def profile_nulls(spark, sf_dir):
    columns = [*profile.KEY_COLUMNS, "channel_nsfw", "title", "domain", "url", "sentiment_source"]
    return profile.null_ratios(frames.silver_events(spark, sf_dir), columns)


def _points(df: DataFrame, column: str, points: list[float]) -> DataFrame:
    named = [F.col(column)[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(points)]
    return df.select(*named, *[c for c in df.columns if c != column])


@query
def profile_score_pcts(spark, sf_dir):
    spread = profile.score_distribution(frames.timed_events(spark, sf_dir))
    return _points(spread, "score_pcts", profile.SCORE_POINTS)


@query
def profile_word_pcts(spark, sf_dir):
    spread = profile.word_distribution(frames.silver_events(spark, sf_dir))
    return _points(spread, "word_count_pcts", profile.WORD_POINTS)


@query
def profile_daily(spark, sf_dir):
    return profile.daily_volume(frames.timed_events(spark, sf_dir)).orderBy("created_date")


@query
def profile_top(spark, sf_dir):
    return profile.top_channels(frames.timed_events(spark, sf_dir))


# --- labels and features -----------------------------------------------------


@query
def weak_sentiment(spark, sf_dir):
    labelled = labels.weak_sentiment(frames.silver_events(spark, sf_dir))
    return labelled.select(*EVENT_KEYS, "sentiment_source", "score", "sentiment_label")


@query
def derived_flags(spark, sf_dir):
    flagged = labels.derived_flags(frames.silver_events(spark, sf_dir))
    return flagged.select(*EVENT_KEYS, "has_url", "is_question", "is_post")


@query
def engagement_label(spark, sf_dir):
    labelled = labels.engagement_label(frames.narrow_events(spark, sf_dir))
    return labelled.select(*EVENT_KEYS, "score", "score_threshold", "label")


@query
def topic_argmax(spark, sf_dir):
    assigned = frames.post_topics(spark, sf_dir)
    return assigned.select(*EVENT_KEYS, "dominant_topic", "topic_confidence")


@query
def tokens_docfreq(spark, sf_dir):
    docs = frames.texts(spark, sf_dir, "documents", "text")
    words = docs.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("doc_freq"))


@query
def tfidf_vocabulary(spark, sf_dir):
    """The words the text stages know without a bound on their number, and their weights."""
    docs = frames.texts(spark, sf_dir, "documents", "text")
    return features.inverse_frequencies(docs).withColumn("idf", F.round("idf", 9))


@query
def scaled_features(spark, sf_dir):
    """Structured features after centring and scaling, one column each."""
    events = labels.derived_flags(frames.silver_events(spark, sf_dir))
    inputs = events.select(*EVENT_KEYS, *features.NUMERIC_INPUTS, *features.FLAG_INPUTS)
    model = Pipeline(stages=features.number_stages()).fit(inputs)
    scaled = model.transform(inputs).withColumn("v", vector_to_array("scaled_numbers"))
    names = features.NUMERIC_INPUTS + features.FLAG_INPUTS
    columns = [F.round(F.col("v")[i], 6).alias(name) for i, name in enumerate(names)]
    return scaled.select(*EVENT_KEYS, *columns)


@query
def class_metrics(spark, sf_dir):
    """f1 and accuracy of a rule that goes by the score alone, against the weak labels."""
    labelled = labels.weak_sentiment(frames.silver_events(spark, sf_dir)).select("score", "sentiment_label")
    by_score = "CASE WHEN score > 20 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END"
    judged = labelled.select(F.col("sentiment_label").alias("label"), F.expr(by_score).alias("prediction"))
    return _rounded(_rounded(metrics.class_metrics(judged), "f1"), "accuracy")


@query
def ranking_metrics(spark, sf_dir):
    """How well the length of a text tells the top of its topic's scores."""
    labelled = engagement_label(spark, sf_dir).join(
        frames.narrow_events(spark, sf_dir).select(*EVENT_KEYS, "text_length"), EVENT_KEYS
    )
    return _rounded(metrics.area_under_roc(labelled, "text_length"), "area_under_roc")


@query
def split_rows(spark, sf_dir):
    """On which side of the split, and in which fold, each event is."""
    events = frames.silver_events(spark, sf_dir)
    bucket, fold = features.hash_bucket(100, SETTINGS.seed), features.hash_bucket(SETTINGS.cv_folds, SETTINGS.seed + 1)
    return events.select(*EVENT_KEYS, (bucket < 80).alias("learns"), fold.alias("fold"))


@query
def vocabulary(spark, sf_dir):
    """The table behind the term vectors: words, texts that hold them, occurrences."""
    docs = frames.texts(spark, sf_dir, "documents", "text")
    return features.vocabulary(docs, min_doc_freq=SETTINGS.min_doc_freq)


@query
def term_vectors(spark, sf_dir):
    """Term vectors as the models see them: how many known words an event has, distinct and in all."""
    events = frames.silver_events(spark, sf_dir)
    settings = {"min_token_length": SETTINGS.min_token_length, "min_doc_freq": SETTINGS.min_doc_freq}
    events = stage(events.select(*EVENT_KEYS, "text"), "texts")
    counter = features.term_counter(events, vocab_size=SETTINGS.vocab_size, **settings)
    vectors = features.with_terms(counter, events)
    # Read as what each text holds: a number for each word of the vocabulary would be far more.
    counted = stage(vectors, "term_vectors", features.sparse_schema(vectors.schema))
    counts = F.col(f"{features.TERMS}.values")
    total = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
    return counted.select(*EVENT_KEYS, F.size(counts).alias("n_distinct"), total.cast("long").alias("n_words"))


# --- jobs --------------------------------------------------------------------


def _landed_lake(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Run bronze and silver over both tables; two topics, one landing folder each. Posts that
    moderators removed are landed again without their ids."""
    root = _run_folder(spark, "lake")
    posts = frames.raw_posts(spark, sf_dir)
    # Both deliveries of a post come from one reading of its text.
    landed = posts.withColumn("id", F.explode(F.expr("IF(`channel.nsfw`, array(id, NULL), array(id))")))
    stored(landed).parquet(f"{root}/landing/docs/posts.parquet")
    stored(frames.raw_comments(spark, sf_dir)).parquet(f"{root}/landing/chat/comments.parquet")
    paths = {
        "bronze_dir": f"{root}/bronze",
        "events_path": f"{root}/silver/events",
        "gold_dir": f"{root}/gold",
        "model_dir": f"{root}/models",
        "audit_path": f"{root}/audit",
        "quarantine_path": f"{root}/quarantine",
    }
    kept = {"audit_path": paths["audit_path"], "quarantine_path": paths["quarantine_path"]}
    for topic in ("docs", "chat"):
        jobs.bronze_job(
            spark,
            base_dir=f"{root}/landing/{topic}",
            topic=topic,
            batch_id="b1",
            bronze_dir=paths["bronze_dir"],
            ingested_at=FIRST_INGEST,
            **kept,
        )
    jobs.silver_job(
        spark,
        bronze_dir=paths["bronze_dir"],
        events_path=paths["events_path"],
        as_of=AS_OF,
        audit_path=paths["audit_path"],
        run_id="r1",
    )
    return paths


@query
def job_silver(spark, sf_dir):
    return jobs.read_events(spark, _landed_lake(spark, sf_dir)["events_path"])


@query
def job_audit(spark, sf_dir):
    """Verdicts of the bronze and silver gates, as the jobs have stored them."""
    return batches.read_audit(spark, _landed_lake(spark, sf_dir)["audit_path"])


@query
def job_quarantine(spark, sf_dir):
    """Rows set aside by the bronze job."""
    rows = batches.read_quarantine(spark, _landed_lake(spark, sf_dir)["quarantine_path"])
    return rows.select(
        "kind",
        "topic",
        "batch_id",
        F.array_join("failed_rules", "; ").alias("failed_rules"),
        F.get_json_object("row", "$.permalink").alias("permalink"),
        F.get_json_object("row", "$.selftext").alias("selftext"),
        F.get_json_object("row", "$.created_utc").cast("long").alias("created_utc"),
    )


def _gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    paths = _landed_lake(spark, sf_dir)
    jobs.gold_job(spark, events_path=paths["events_path"], gold_dir=paths["gold_dir"])
    return spark.read.parquet(f"{paths['gold_dir']}/{name}")


@query
def job_gold(spark, sf_dir):
    return _gold_table(spark, sf_dir, "daily_activity")


@query
def job_gold_summary(spark, sf_dir):
    return _gold_table(spark, sf_dir, "channel_summary")


@query
def job_gold_hourly(spark, sf_dir):
    return _gold_table(spark, sf_dir, "hourly_activity")


@query
def job_gold_batches(spark, sf_dir):
    """Gold after two batches: stored posts first, then redelivered ones and comments, of which
    only the days they touch are folded again."""
    root = _run_folder(spark, "batches")
    for side in _upsert_sides(spark, sf_dir):
        with staged(side, "batch") as source:
            tables.upsert(
                source, f"{root}/events", EVENT_KEYS, partition_by=jobs.EVENT_PARTITIONS
            )
        jobs.gold_job(spark, events_path=f"{root}/events", gold_dir=f"{root}/gold")
    return spark.read.parquet(f"{root}/gold/channel_summary")


@query
def job_train_score(spark, sf_dir):
    """Training, model registry, one-pass scoring and the aggregates over scores."""
    paths = _landed_lake(spark, sf_dir)
    wanted = {name: paths[name] for name in ("events_path", "gold_dir", "model_dir")}
    jobs.train_job(spark, settings=SETTINGS, **wanted)
    return spark.read.parquet(f"{paths['gold_dir']}/sentiment_daily")


# --- fitted models: rows only, a fit has no SQL form -------------------------


def _topic_model(spark, sf_dir):
    events = stage(frames.post_events(spark, sf_dir), "posts")
    return events, *topics.train_topic_model(
        events, k=SETTINGS.topic_count, max_iter=SETTINGS.topic_max_iterations, **TEXT_FEATURES
    )


@query
def lda_terms(spark, sf_dir):
    _, _, terms = _topic_model(spark, sf_dir)
    return terms


@query
def lda_topics(spark, sf_dir):
    events, model, _ = _topic_model(spark, sf_dir)
    return topics.assign_topics(model, events)


@query
def sentiment_scores(spark, sf_dir):
    events = stage(frames.silver_events(spark, sf_dir), "events")
    model, _ = sentiment.train_sentiment(events, **TEXT_FEATURES)
    return sentiment.score_sentiment(model, events)


@query
def engagement_scores(spark, sf_dir):
    events = stage(frames.silver_events(spark, sf_dir), "events")
    model, _ = engagement.train_engagement(
        events,
        percentile=SETTINGS.engagement_percentile,
        cv_folds=SETTINGS.cv_folds,
        depths=SETTINGS.tree_depths,
        iterations=SETTINGS.tree_iterations,
        **TEXT_FEATURES,
    )
    return engagement.predict_engagement(model, events)


@query
def model_roundtrip(spark, sf_dir):
    events, model, _ = _topic_model(spark, sf_dir)
    folder = _run_folder(spark, "models")
    version = models.save_model(model, folder, scoring.TOPIC_MODEL)
    models.set_alias(spark, folder, scoring.TOPIC_MODEL, models.CHAMPION, version)
    return topics.assign_topics(models.load_model(spark, folder, scoring.TOPIC_MODEL), events)
