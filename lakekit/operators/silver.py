"""Raw posts and comments to one cleaned, de-duplicated event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.functions.text import clean_text, is_placeholder, joined_text, word_count
from lakekit.operators.lookup import join_lookup
from lakekit.schema import COMMENT, EVENT_KEYS, POST, as_events, col_or_null, quoted
from lakekit.session import checkpointed

INGESTED_AT = "_ingested_at"
VALID = "_valid"

# The years 1 to 9999 in seconds since 1970.
CALENDAR_SECONDS = (-62_135_596_800, 253_402_300_799)


def flatten_community(df: DataFrame, community: str = "channel") -> DataFrame:
    """Bring the community's name, nsfw flag and id to flat ``channel_*`` columns.

    Accepts columns with a dot in their name (``channel.name``) as well as a
    nested struct. ``community`` is the prefix the source uses.
    """
    dotted = {f"{community}.{part}": f"channel_{part}" for part in ("name", "nsfw", "id")}
    df = df.withColumnsRenamed({old: new for old, new in dotted.items() if old in df.columns})
    if community in df.columns and isinstance(df.schema[community].dataType, StructType):
        parts = [p for p in ("name", "nsfw") if p in df.schema[community].dataType.names]
        df = df.withColumns({f"channel_{p}": F.col(f"{quoted(community)}.{p}") for p in parts})
        df = df.drop(community)
    return df


def normalize_raw(
    raw: DataFrame, *, event_type: str, topic: str | Column, community: str = "channel"
) -> DataFrame:
    """One select from whatever the source ships to the canonical raw columns.

    Columns the source lacks become typed nulls; malformed values become null
    instead of failing the job. ``topic`` is a constant, or a column when rows
    of many topics are read in one pass.
    """
    df = flatten_community(raw, community)
    names = df.columns
    topic_col = F.lit(topic) if isinstance(topic, str) else topic
    body = F.coalesce(
        col_or_null(names, "selftext", "string"), col_or_null(names, "body", "string")
    )
    columns = [
        F.concat_ws("_", F.lit(event_type), "id").alias("event_id"),
        F.lit(event_type).alias("event_type"),
        topic_col.alias("topic"),
        col_or_null(names, "channel_name", "string").alias("channel"),
        col_or_null(names, "channel_nsfw", "boolean").alias("channel_nsfw"),
        col_or_null(names, "created_utc", "bigint").alias("created_utc"),
        col_or_null(names, "title", "string").alias("title"),
        body.alias("body_text"),
        col_or_null(names, "score", "bigint").alias("score"),
        col_or_null(names, "permalink", "string").alias("permalink"),
        col_or_null(names, "domain", "string").alias("domain"),
        col_or_null(names, "url", "string").alias("url"),
        col_or_null(names, "sentiment", "string").alias("sentiment_source"),
    ]
    if INGESTED_AT in names:
        columns.append(F.col(INGESTED_AT))
    # A null id would yield the bare event type as key and fold all such rows
    # into one. They are counted by the bronze and silver gates, and left out here.
    return df.filter("id IS NOT NULL").select(*columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order`` (SQL sort terms).

    The rank filter lets Spark keep one row per key and map task before the
    shuffle, so a key with very many copies does not meet in one task. The hash
    leads the sort because keys often share their first bytes, which is all that
    a sort compares cheaply.
    """
    key = ", ".join(quoted(k) for k in keys)
    rank = (
        f"row_number() OVER (PARTITION BY xxhash64({key}), {key} ORDER BY {', '.join(order)})"
    )
    return df.withColumn("_rank", F.expr(rank)).filter("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of more than one row; null is a value like others."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter("_rows > 1").select(*keys)


def newest_first(columns: Sequence[str]) -> list[str]:
    """Survivor order of duplicates: valid content, newest ingest, newest event, highest score.

    The remaining columns only break ties, so that the survivor does not depend
    on how rows happen to be spread over tasks.
    """
    leading = [c for c in (VALID, INGESTED_AT, "created_ts", "score") if c in columns]
    rest = [c for c in columns if c not in leading and c not in EVENT_KEYS]
    return [f"{quoted(c)} DESC NULLS LAST" for c in leading] + [
        f"{quoted(c)} ASC NULLS LAST" for c in rest
    ]


def dedup_events(events: DataFrame) -> DataFrame:
    return latest_per_key(events, EVENT_KEYS, newest_first(events.columns))


def clean_events(unified: DataFrame, *, scrub_placeholders: bool = False) -> DataFrame:
    """Clean and enrich normalized rows that have a score; keeps duplicates.

    ``_valid`` marks rows with content in the title or the text. It is a column
    that ranks before everything else, and is filtered after the de-duplication:
    filtering first gives the same rows, but Spark would push that filter below
    the projection and clean each text twice.

    By default a placeholder body stays inside the text of a post whose title is
    valid. ``scrub_placeholders`` drops such parts before joining.
    """
    title = clean_text(F.col("title"), scrub_placeholders)
    body = clean_text(F.col("body_text"), scrub_placeholders)
    if scrub_placeholders:
        title = F.when(~is_placeholder(title), title)
        body = F.when(~is_placeholder(body), body)

    # A clock beyond the calendar (microseconds taken for seconds, say) is unknown.
    in_calendar = F.col("created_utc").between(*CALENDAR_SECONDS)
    cleaned = unified.filter("score IS NOT NULL").withColumns(
        {
            "title": title,
            "text": joined_text(title, body),
            "created_ts": F.when(in_calendar, F.timestamp_seconds("created_utc")),
        }
    )
    has_content = ~is_placeholder(F.col("title")) | ~is_placeholder(F.col("text"))
    return cleaned.withColumns(
        {
            VALID: has_content,
            "created_date": F.expr("to_date(created_ts)"),
            "created_hour": F.expr("CAST(hour(created_ts) AS BIGINT)"),
            "created_dow": F.expr("CAST(dayofweek(created_ts) AS BIGINT)"),
            "text_length": F.expr("CAST(length(text) AS BIGINT)"),
            "word_count": word_count(F.col("text")),
        }
    ).drop("created_utc", "body_text")


def to_events(
    posts: DataFrame | None = None,
    comments: DataFrame | None = None,
    *,
    topic: str | Column,
    community: str = "channel",
    scrub_placeholders: bool = False,
) -> DataFrame:
    """The silver transform: normalize, union, clean, filter, enrich, de-duplicate.

    The sources' keys are read when this is called, to find those that repeat: pass stored frames.
    """
    frames = [
        normalize_raw(frame, event_type=kind, topic=topic, community=community)
        for frame, kind in ((posts, POST), (comments, COMMENT))
        if frame is not None
    ]
    if not frames:
        raise ValueError("to_events needs posts, comments or both")
    unified = frames[0]
    for frame in frames[1:]:
        unified = unified.unionByName(frame, allowMissingColumns=True)
    unified = unified.filter("score IS NOT NULL")
    # Keys are counted first, without texts. Rows whose key is not repeated, mostly all, are then
    # neither shuffled nor sorted; the others meet by key.
    repeated = checkpointed(repeated_keys(unified, EVENT_KEYS))
    if repeated.isEmpty():
        return as_events(clean_events(unified, scrub_placeholders=scrub_placeholders).filter(VALID))
    marked = join_lookup(
        unified, repeated.withColumn("_again", F.lit(True)), EVENT_KEYS, null_safe=True
    )
    once, again = (
        clean_events(rows.drop("_again"), scrub_placeholders=scrub_placeholders)
        for rows in (marked.filter("_again IS NULL"), marked.filter("_again"))
    )
    return as_events(once.filter(VALID).unionByName(dedup_events(again).filter(VALID)))
