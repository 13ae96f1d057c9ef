"""Views and tiles as SQL text, for users who work in SQL alone.

Views are stored in the catalog over gold tables by name. Tiles read views; what varies from call
to call is a named parameter, never part of the text.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lakekit.schema import quoted
from lakekit.sources.tables import table_exists

# Views over one gold table each; those that join or rank are frames in lakekit.plans.views.
VIEW_SQL = {
    "vw_channel_daily_trend": """
        SELECT topic, channel, created_date, event_count, post_count, comment_count, avg_score,
               median_score, total_score, avg_word_count,
               sum(event_count) OVER last7 AS events_rolling_7d,
               avg(avg_score) OVER last7 AS avg_score_rolling_7d,
               event_count - lag(event_count) OVER by_date AS event_count_dod_delta
        FROM {daily_activity}
        WINDOW by_date AS (PARTITION BY topic, channel ORDER BY created_date),
               last7 AS (PARTITION BY topic, channel ORDER BY created_date
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "vw_activity_heatmap": """
        SELECT topic, created_dow AS day_of_week,
               try_element_at(array('Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'),
                              CAST(created_dow AS INT)) AS day_label,
               created_hour AS hour_of_day, event_count, avg_score
        FROM {hourly_activity}""",
    "vw_sentiment_breakdown": """
        SELECT *, round(try_divide(positive, total), 4) AS positive_ratio,
               round(try_divide(negative, total), 4) AS negative_ratio,
               round(try_divide(positive - negative, total), 4) AS net_sentiment
        FROM (
          SELECT topic, channel, created_date, count(*) AS total,
                 count_if(sentiment_label = 'positive') AS positive,
                 count_if(sentiment_label = 'neutral') AS neutral,
                 count_if(sentiment_label = 'negative') AS negative
          FROM {post_sentiment} GROUP BY topic, channel, created_date
        )""",
}

TILE_SQL = {
    "volume_trend": """
        SELECT topic, created_date, events_rolling_7d FROM {vw_channel_daily_trend}
        WHERE created_date >= date_sub(:as_of, :days) ORDER BY created_date""",
    "activity_heatmap": """
        SELECT day_label, hour_of_day, sum(event_count) AS events FROM {vw_activity_heatmap}
        GROUP BY day_label, hour_of_day, day_of_week ORDER BY day_of_week, hour_of_day""",
    "sentiment_trend": """
        SELECT topic, created_date, avg(net_sentiment) AS net_sentiment FROM {vw_sentiment_breakdown}
        WHERE created_date >= date_sub(:as_of, :days)
        GROUP BY topic, created_date ORDER BY created_date""",
    "sentiment_mix": """
        SELECT channel, sum(positive) AS positive, sum(neutral) AS neutral, sum(negative) AS negative
        FROM {vw_sentiment_breakdown} GROUP BY channel
        ORDER BY sum(total) DESC, channel LIMIT :n""",
}

# What the dashboard asks for unless told otherwise.
DEFAULTS: dict[str, dict[str, Any]] = {
    "volume_trend": {"days": 90},
    "sentiment_trend": {"days": 90},
    "sentiment_mix": {"n": 20},
}


def _named(text: str, names: Mapping[str, str]) -> str:
    parts = {key: ".".join(quoted(p) for p in name.split(".")) for key, name in names.items()}
    return text.format_map(parts)


def create_views(spark: SparkSession, tables: Mapping[str, str], prefix: str = "") -> dict[str, str]:
    """Store the views whose gold table is in the catalog; returns their names in it.

    ``tables`` maps gold tables to catalog names; ``prefix`` is a database with a dot, or a name's start.
    """
    created = {}
    for view, text in VIEW_SQL.items():
        if any(f"{{{table}}}" in text and table_exists(spark, name) for table, name in tables.items()):
            created[view] = f"{prefix}{view}"
            body = _named(text, tables)
            spark.sql(f"CREATE OR REPLACE VIEW {_named('{v}', {'v': created[view]})} AS {body}")
    return created


def tile(spark: SparkSession, name: str, views: Mapping[str, str], **parameters: Any) -> DataFrame:
    """A tile over stored views, with its parameters bound by name."""
    bound = {**DEFAULTS.get(name, {}), **parameters}
    return spark.sql(_named(TILE_SQL[name], views), args=bound)
