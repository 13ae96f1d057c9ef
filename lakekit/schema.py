"""Column contracts of the three layers."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

POST = "post"
COMMENT = "comment"
EVENT_KEYS = ["topic", "event_id"]

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("event_type", StringType(), False),
        StructField("topic", StringType()),
        StructField("channel", StringType()),
        StructField("channel_nsfw", BooleanType()),
        StructField("created_ts", TimestampType()),
        StructField("created_date", DateType()),
        StructField("created_hour", LongType()),
        StructField("created_dow", LongType()),
        StructField("title", StringType()),
        StructField("text", StringType()),
        StructField("text_length", LongType()),
        StructField("word_count", LongType()),
        StructField("score", LongType()),
        StructField("permalink", StringType()),
        StructField("domain", StringType()),
        StructField("url", StringType()),
        StructField("sentiment_source", StringType()),
    ]
)

TOPIC_TERMS_SCHEMA = StructType(
    [
        StructField("topic_id", IntegerType()),
        StructField("terms", ArrayType(StringType())),
        StructField("term_weights", ArrayType(DoubleType())),
        StructField("label", StringType()),
    ]
)


def quoted(name: str) -> str:
    """A column name as one identifier, dots included."""
    return "`" + name.replace("`", "``") + "`"


def col_or_null(available: Collection[str], name: str, dtype: str) -> Column:
    """The column cast leniently to ``dtype``, or a typed null if it is not available."""
    source = quoted(name) if name in available else "NULL"
    return F.expr(f"try_cast({source} AS {dtype})")


def as_events(df: DataFrame) -> DataFrame:
    """Column order and types of the event contract; other columns are left out.

    A key column is declared non-null in the contract while Spark infers
    nullability from expressions, so nullability is taken from the frame and
    the row check is left to the quality rules.
    """
    relaxed = StructType([StructField(f.name, f.dataType) for f in EVENT_SCHEMA])
    return df.to(relaxed)
