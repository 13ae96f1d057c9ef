"""Landed parquet files with lineage columns."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_PARTITIONS = ["_topic", "_ingest_date"]


def read_optional(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame | None:
    """Parquet behind a path or glob; ``None`` if nothing is there or it has no columns.

    Only a missing path or a folder without files is tolerated. Any other failure
    is the caller's to see.
    """
    try:
        df = spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df if df.columns else None


def add_lineage(
    df: DataFrame, *, topic: str, batch_id: str, ingested_at: dt.datetime | None = None
) -> DataFrame:
    """Topic, batch, ingest time and date; ``ingested_at`` fixes the clock for a rerun."""
    now = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns(
        {
            "_topic": F.lit(topic),
            "_batch_id": F.lit(batch_id),
            "_ingested_at": now,
            "_ingest_date": F.to_date(now),
        }
    )


def bronze_frames(
    spark: SparkSession,
    *,
    base_dir: str,
    topic: str,
    batch_id: str,
    posts_glob: str = "*posts*.parquet",
    comments_glob: str = "*comments*.parquet",
    ingested_at: dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """Frames of the kinds that are present under ``base_dir``."""
    found = {
        kind: read_optional(spark, f"{base_dir}/{glob}")
        for kind, glob in (("posts", posts_glob), ("comments", comments_glob))
    }
    return {
        kind: add_lineage(df, topic=topic, batch_id=batch_id, ingested_at=ingested_at)
        for kind, df in found.items()
        if df is not None
    }
