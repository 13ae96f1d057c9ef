"""Score events with all three models in one pass over the text."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.ml.engagement import PREDICTION_COLUMNS, with_engagement
from lakekit.ml.features import FLAG_INPUTS, NUMERIC_INPUTS, TERMS, with_terms
from lakekit.ml.sentiment import with_sentiment
from lakekit.ml.topics import ASSIGNMENT_COLUMNS, with_topics
from lakekit.operators.labels import derived_flags
from lakekit.schema import EVENT_KEYS

TERM_COUNTER = "term_counter"
TOPIC_MODEL = "topic_lda"
SENTIMENT_MODEL = "sentiment_classifier"
ENGAGEMENT_MODEL = "engagement_classifier"

_EVENT_COLUMNS = ["channel", "created_date", "score"]
_SCORES = {
    "post_topics": ASSIGNMENT_COLUMNS,
    "post_sentiment": ["event_id", "topic", "channel", "created_date", "sentiment_label"],
    "engagement_predictions": PREDICTION_COLUMNS,
}


def _with_scores(rows: DataFrame, inputs: list[str], models: dict[str, PipelineModel]) -> DataFrame:
    """One narrow row per event with the results of all models.

    Models share names of inner columns, so each step keeps only what later steps read.
    """
    kept = [*EVENT_KEYS, *inputs, *_EVENT_COLUMNS]
    results = []
    for add, name, found in (
        (with_topics, TOPIC_MODEL, ["dominant_topic", "topic_confidence"]),
        (with_sentiment, SENTIMENT_MODEL, ["sentiment_label"]),
        (with_engagement, ENGAGEMENT_MODEL, ["is_high_engagement", "engagement_probability"]),
    ):
        results += found
        rows = add(models[name], rows.select(*kept)).select(*kept, *found)
        kept = [*kept, *found]
    return rows.select(*EVENT_KEYS, *_EVENT_COLUMNS, *results)


def score_terms(terms: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Scores of a term-vector table by the three models that start from term vectors."""
    return _with_scores(terms, [TERMS, *NUMERIC_INPUTS, *FLAG_INPUTS], models)


def term_table(counter: PipelineModel, events: DataFrame) -> DataFrame:
    """The term-vector table that all fits and scores stand on: the one place where text is read."""
    columns = [*NUMERIC_INPUTS, *FLAG_INPUTS, "sentiment_source", *_EVENT_COLUMNS]
    return with_terms(counter, derived_flags(events), *columns)


def score_once(
    events: DataFrame,
    *,
    topic_model: PipelineModel,
    sentiment_model: PipelineModel,
    engagement_model: PipelineModel,
) -> DataFrame:
    """Scores of events by models that start from text, each fitted on its own."""
    models = {
        TOPIC_MODEL: topic_model,
        SENTIMENT_MODEL: sentiment_model,
        ENGAGEMENT_MODEL: engagement_model,
    }
    return _with_scores(derived_flags(events), ["text", *NUMERIC_INPUTS, *FLAG_INPUTS], models)


def split_scores(scored: DataFrame) -> dict[str, DataFrame]:
    """The three gold prediction frames. On a lazy frame, each runs only its own model."""
    return {name: scored.select(*[F.col(c) for c in cols]) for name, cols in _SCORES.items()}


def score_events(
    events: DataFrame,
    *,
    topic_model: PipelineModel,
    sentiment_model: PipelineModel,
    engagement_model: PipelineModel,
) -> dict[str, DataFrame]:
    return split_scores(
        score_once(
            events,
            topic_model=topic_model,
            sentiment_model=sentiment_model,
            engagement_model=engagement_model,
        )
    )
