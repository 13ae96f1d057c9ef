"""The batch jobs: bronze, silver, gold, training and scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakekit.ml import engagement, features, models, scoring, sentiment, topics
from lakekit.operators import gold
from lakekit.operators.lookup import join_lookup
from lakekit.operators.quality import (
    QualityReport,
    Severity,
    accepted_values,
    freshness,
    gate,
    in_range,
    max_null_ratio,
    measured_while_written,
    min_row_count,
    not_null,
    run_checks,
    unique,
)
from lakekit.operators.silver import to_events
from lakekit.plans.views import gold_views, register_views
from lakekit.schema import COMMENT, EVENT_KEYS, EVENT_SCHEMA, POST
from lakekit.session import checkpointed, staged
from lakekit.sources import versions
from lakekit.sources.batches import (
    common_schema,
    landed_batches,
    record_batch,
    set_aside,
    write_audit,
)
from lakekit.sources.bronze import BRONZE_PARTITIONS, bronze_frames, read_optional
from lakekit.sources.tables import (
    read_parquet,
    spread_small,
    upsert,
    write_clustered,
    write_path,
)

EVENT_PARTITIONS = ["topic", "created_date"]
EVENT_CLUSTERING = ["channel"]


@dataclass(frozen=True)
class QualityLimits:
    """Default thresholds of the gates."""

    min_bronze_rows: int = 1
    max_null_ratio: float = 0.02
    min_score: int = -100_000
    max_score: int = 10_000_000
    freshness_max_age_days: int = 3650


@dataclass(frozen=True)
class ModelSettings:
    """Default hyper-parameters of the three models."""

    topic_count: int = 12
    topic_max_iterations: int = 30
    vocab_size: int = 20_000
    min_token_length: int = 3
    min_doc_freq: int = 5
    engagement_percentile: float = 0.90
    cv_folds: int = 3
    tree_depths: tuple[int, ...] = engagement.GRID_DEPTHS
    tree_iterations: tuple[int, ...] = engagement.GRID_ITERATIONS
    seed: int = 42


def bronze_job(
    spark: SparkSession,
    *,
    base_dir: str,
    topic: str,
    batch_id: str,
    bronze_dir: str,
    posts_glob: str = "*posts*.parquet",
    comments_glob: str = "*comments*.parquet",
    limits: QualityLimits = QualityLimits(),
    ingested_at: dt.datetime | None = None,
    quarantine_path: str | None = None,
    audit_path: str | None = None,
) -> dict[str, QualityReport]:
    """Append one topic's landed files to ``posts_raw`` and ``comments_raw``.

    A null id stops the job, unless there is a quarantine for such rows; then they are counted,
    written there and left out. The batch is noted once its rows are there: the silver job
    takes in noted batches, each once. ``batch_id`` names one delivery of the topic.
    """
    # One clock for the partition and for the note.
    ingested_at = ingested_at or dt.datetime.now(dt.timezone.utc)
    frames = bronze_frames(
        spark,
        base_dir=base_dir,
        topic=topic,
        batch_id=batch_id,
        posts_glob=posts_glob,
        comments_glob=comments_glob,
        ingested_at=ingested_at,
    )
    reports = {}
    for kind, df in frames.items():
        known_id = not_null(["id"], _severity(quarantine_path))
        report = run_checks(df, [min_row_count(limits.min_bronze_rows), known_id])
        if audit_path:
            write_audit(spark, report, audit_path, job=f"bronze {topic}/{kind}", batch=batch_id)
        reports[kind] = gate(report, f"bronze {topic}/{kind}")
        if quarantine_path:
            batch = spark.createDataFrame([(topic, batch_id)], "topic string, batch_id string")
            lost = report.results[1].violating_rows
            df = set_aside(
                df, [known_id], quarantine_path, kind=kind, batches=batch, broken=lost
            )
        # One topic and one date per batch: nothing to gather, so no shuffle.
        write_path(
            df,
            f"{bronze_dir}/{kind}_raw",
            mode="append",
            partition_by=BRONZE_PARTITIONS,
            rebalance=False,
        )
        record_batch(
            df,
            bronze_dir,
            kind=kind,
            topic=topic,
            batch_id=batch_id,
            ingested_at=ingested_at,
        )
    return reports


def _severity(quarantine_path: str | None) -> Severity:
    """A null id is critical where there is no place to put its row."""
    return Severity.CRITICAL if quarantine_path is None else Severity.WARNING


def _bronze_batches(spark: SparkSession, bronze_dir: str, kind: str, batches: DataFrame) -> DataFrame | None:
    """The rows of the given batches, by their noted columns.

    Topics and ingest dates prune folders; the batch itself is a column within them.
    """
    own = batches.filter(F.col("kind") == kind)
    schema = common_schema(spark, own)
    if not schema.names:
        return None
    df = read_parquet(spark, f"{bronze_dir}/{kind}_raw", schema)
    for column, name in (("_topic", "topic"), ("_ingest_date", "ingest_date")):
        df = df.filter(F.col(column).isin([r[0] for r in own.select(name).distinct().collect()]))
    wanted = own.select(F.col("topic").alias("_topic"), F.col("batch_id").alias("_batch_id")).distinct()
    return spread_small(join_lookup(df, wanted, ["_topic", "_batch_id"], "left_semi"))


def _bronze_kind(
    spark: SparkSession,
    bronze_dir: str,
    kind: str,
    topics: Sequence[str] | None,
    since: dt.date | None,
    merge_schema: bool,
) -> DataFrame | None:
    """Both filters are on partition columns: other folders are not opened."""
    path = f"{bronze_dir}/{kind}_raw"
    found = read_optional(spark, path, merge_schema=merge_schema)
    if found is None:
        return None
    # Read again with the topic as text: a topic named 007 must not become 7.
    schema = StructType(
        [StructField("_topic", StringType()) if f.name == "_topic" else f for f in found.schema]
    )
    df = read_parquet(spark, path, schema)
    if topics is not None:
        df = df.filter(F.col("_topic").isin(list(topics)))
    if since is not None:
        df = df.filter(F.col("_ingest_date") >= since)
    return None if df.isEmpty() else spread_small(df)


def silver_rules(limits: QualityLimits, as_of: dt.date | None = None) -> list:
    return [
        not_null(["event_id", "event_type", "topic", "created_ts"]),
        unique(EVENT_KEYS),
        accepted_values("event_type", [POST, COMMENT]),
        in_range("score", limits.min_score, limits.max_score),
        max_null_ratio("channel", limits.max_null_ratio),
        freshness("created_ts", limits.freshness_max_age_days, as_of=as_of),
    ]


def silver_job(
    spark: SparkSession,
    *,
    bronze_dir: str,
    events_path: str,
    topics: Sequence[str] | None = None,
    since: dt.date | None = None,
    merge_schema: bool = True,
    community: str = "channel",
    limits: QualityLimits = QualityLimits(),
    as_of: dt.date | None = None,
    again: bool = False,
    quarantine_path: str | None = None,
    audit_path: str | None = None,
    run_id: str | None = None,
) -> QualityReport:
    """Clean all topics in one pass, gate them, upsert them on (topic, event_id).

    Only batches that the event table has not taken in are read, by their noted columns; without any the
    job ends at once. Rows and the names of their batches come into the table in one
    commit, so a run that stopped is simply run again. ``again`` takes in all batches
    once more; ``topics`` and ``since`` (the day of ingest) narrow what is looked at.
    As newer batches win over older ones, daily runs build the same table as one over all. A bronze
    folder without noted batches is read whole; ``merge_schema`` then opens every file for its columns.

    The events are staged once, and measured for the gate while they are written; the
    upsert reads the staged files. A null id stops the job, unless there is a quarantine
    for such rows (a table of its own, not the bronze job's). ``run_id`` names the run in the audit table; by default the name follows from its batches.
    """
    batches = landed_batches(spark, bronze_dir)
    if batches is None:
        frames = {
            kind: _bronze_kind(spark, bronze_dir, kind, topics, since, merge_schema)
            for kind in ("posts", "comments")
        }
    else:
        if topics is not None:
            batches = batches.filter(F.col("topic").isin(list(topics)))
        if since is not None:
            batches = batches.filter(F.col("ingest_date") >= since)
        if not again:
            batches = batches.join(versions.taken_names(spark, events_path), "taken", "left_anti")
        # One short row a batch.
        batches = checkpointed(batches)
        if batches.isEmpty() and versions.latest_version(spark, events_path) is not None:
            return QualityReport([])
        frames = {
            kind: _bronze_batches(spark, bronze_dir, kind, batches)
            for kind in ("posts", "comments")
        }
    frames = {kind: df for kind, df in frames.items() if df is not None}
    if not frames:
        raise RuntimeError("no bronze rows to build events from")
    for kind, df in frames.items():
        known_id = not_null(["id"], _severity(quarantine_path))
        report = gate(run_checks(df, [known_id]), f"silver input {kind}")
        if quarantine_path:
            named = df.select(F.col("_topic").alias("topic"), F.col("_batch_id").alias("batch_id"))
            own = named if batches is None else batches.filter(F.col("kind") == kind)
            # Their ids are null: the transform leaves them out.
            lost = report.results[0].violating_rows
            set_aside(df, [known_id], quarantine_path, kind=kind, batches=own, broken=lost)
    events = to_events(
        frames.get("posts"), frames.get("comments"), topic=F.col("_topic"), community=community
    )
    events, measured = measured_while_written(events, silver_rules(limits, as_of))
    with staged(events, "silver_events") as source:
        report = measured(source)
        if audit_path:
            write_audit(spark, report, audit_path, job="silver", batch=run_id or _run_name(batches))
        gate(report, "silver")
        upsert(
            source,
            events_path,
            EVENT_KEYS,
            partition_by=EVENT_PARTITIONS,
            cluster_by=EVENT_CLUSTERING,
            taken=() if batches is None else batches.select("taken"),
            # The gate has just proved it.
            keys_checked=True,
        )
    return report


def _run_name(batches: DataFrame | None) -> str:
    """The same for the same batches, so that a repeated run replaces its audit rows."""
    if batches is None:
        return "all"
    return batches.agg(F.hex(F.bit_xor(F.xxhash64("taken")))).first()[0]


def read_events(spark: SparkSession, events_path: str) -> DataFrame:
    """The latest version of the event table."""
    return versions.read_version(spark, events_path, EVENT_SCHEMA)


def _refresh_state(spark: SparkSession, events_path: str, state_path: str) -> DataFrame:
    """Bring the activity state up to the latest events and return it.

    The state remembers which version of the events it has taken in. Only partitions that have
    changed since then are read and folded anew; all of them the first time.
    """
    schema = gold.activity_state(spark.createDataFrame([], EVENT_SCHEMA)).schema
    marks = [r["taken"] for r in versions.taken_names(spark, state_path).collect()]
    since = max((int(mark) for mark in marks), default=None)
    changed = versions.changed_partitions(spark, events_path, since)
    if changed is None:
        raise RuntimeError(f"no events at {events_path}")
    values, version = changed
    if version != since:
        # One narrow row a partition.
        values = checkpointed(values)
        events = versions.read_partitions(spark, events_path, EVENT_SCHEMA, values, version)
        state = gold.activity_state(events).hint("rebalance", *EVENT_PARTITIONS)
        versions.commit(
            state,
            state_path,
            partition_by=EVENT_PARTITIONS,
            # Without a version to compare with the state is built anew.
            touched=values if since in versions.known_versions(spark, events_path) else None,
            taken=[str(version)],
        )
    return versions.read_version(spark, state_path, schema)


def gold_job(spark: SparkSession, *, events_path: str, gold_dir: str) -> None:
    """Refresh the three event aggregates.

    Events are read for the days that changed since the last run only, into a narrow
    state that can be added up; the aggregates are derived from the state of all days.
    """
    state = _refresh_state(spark, events_path, f"{gold_dir}/activity_state")
    write_clustered(
        gold.daily_from_state(state), f"{gold_dir}/daily_activity", ["channel", "created_date", "topic"]
    )
    write_path(gold.summary_from_state(state), f"{gold_dir}/channel_summary")
    write_path(gold.hourly_from_state(state), f"{gold_dir}/hourly_activity")


def _model_gold(spark: SparkSession, gold_dir: str) -> None:
    """The two aggregates over model output, read back from what was just written."""
    post_topics = spark.read.parquet(f"{gold_dir}/post_topics")
    post_sentiment = spark.read.parquet(f"{gold_dir}/post_sentiment")
    write_path(gold.topic_trends(post_topics), f"{gold_dir}/topic_trends")
    write_path(gold.sentiment_daily(post_sentiment), f"{gold_dir}/sentiment_daily")


def train_job(
    spark: SparkSession,
    *,
    events_path: str,
    gold_dir: str,
    model_dir: str,
    settings: ModelSettings = ModelSettings(),
) -> dict[str, dict]:
    """Fit and save the three models, then score the events with them.

    The text is split into words for the vocabulary and for the table of term vectors, each once; the fits
    and the scores read the stored vectors.
    """
    events = read_events(spark, events_path)
    counter = features.term_counter(
        events,
        vocab_size=settings.vocab_size,
        min_token_length=settings.min_token_length,
        min_doc_freq=settings.min_doc_freq,
    )
    with staged(scoring.term_table(counter, events), "terms") as terms:
        lda = topics.fit_topics(
            terms, k=settings.topic_count, max_iter=settings.topic_max_iterations, seed=settings.seed
        )
        sentiment_model, sentiment_metrics = sentiment.fit_sentiment(terms, seed=settings.seed)
        engagement_model, engagement_metrics = engagement.fit_engagement(
            terms,
            percentile=settings.engagement_percentile,
            cv_folds=settings.cv_folds,
            depths=settings.tree_depths,
            iterations=settings.tree_iterations,
            seed=settings.seed,
        )
        fitted = {
            scoring.TERM_COUNTER: counter,
            scoring.TOPIC_MODEL: PipelineModel([lda]),
            scoring.SENTIMENT_MODEL: sentiment_model,
            scoring.ENGAGEMENT_MODEL: engagement_model,
        }
        for name, model in fitted.items():
            version = models.save_model(model, model_dir, name)
            models.set_alias(spark, model_dir, name, models.CHAMPION, version)
        write_path(topics.topic_terms(counter, lda), f"{gold_dir}/topic_terms")
        _write_scores(spark, terms, fitted, gold_dir)
    return {"sentiment": sentiment_metrics, "engagement": engagement_metrics}


def _write_scores(
    spark: SparkSession, terms: DataFrame, fitted: dict[str, PipelineModel], gold_dir: str
) -> None:
    """All scores go to one narrow staged table, from which the gold tables are cut."""
    with staged(scoring.score_terms(terms, fitted), "scores") as narrow:
        for name, df in scoring.split_scores(narrow).items():
            write_path(df, f"{gold_dir}/{name}")
    _model_gold(spark, gold_dir)


def score_job(spark: SparkSession, *, events_path: str, gold_dir: str, model_dir: str) -> None:
    """Score the events with the models named champion and refresh the gold tables.

    The three models were fitted on the vectors of one counting model, which is named champion with them.
    """
    names = (
        scoring.TERM_COUNTER,
        scoring.TOPIC_MODEL,
        scoring.SENTIMENT_MODEL,
        scoring.ENGAGEMENT_MODEL,
    )
    loaded = {name: models.load_model(spark, model_dir, name) for name in names}
    table = scoring.term_table(loaded[scoring.TERM_COUNTER], read_events(spark, events_path))
    with staged(table, "terms") as terms:
        _write_scores(spark, terms, loaded, gold_dir)


GOLD_TABLES = [
    "daily_activity",
    "channel_summary",
    "hourly_activity",
    "topic_terms",
    "post_topics",
    "post_sentiment",
    "engagement_predictions",
    "topic_trends",
    "sentiment_daily",
]


def open_gold(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """The gold tables and the views over them, registered under their names for SQL."""
    tables = {name: spark.read.parquet(f"{gold_dir}/{name}") for name in GOLD_TABLES}
    frames = {**tables, **gold_views(tables)}
    register_views(frames)
    return frames
