"""High-engagement classification: gradient-boosted trees with cross-validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.ml import metrics
from lakekit.ml.boosting import Fit, as_model, find_cells, fit_trees, held_out_scores, pack_blocks
from lakekit.ml.features import (
    FLAG_INPUTS,
    NUMERIC_INPUTS,
    TERMS,
    hash_bucket,
    sparse_schema,
    term_counter,
    train_test_split,
    with_terms,
)
from lakekit.operators.labels import derived_flags, label_by_threshold, score_thresholds
from lakekit.session import checkpointed, staged
from lakekit.sources.tables import spread_small

# The searched grid.
GRID_DEPTHS = (4, 6)
GRID_ITERATIONS = (20, 40)

NEEDED = [*NUMERIC_INPUTS, *FLAG_INPUTS, "score"]


def fit_engagement(
    terms: DataFrame,
    *,
    percentile: float = 0.90,
    cv_folds: int = 3,
    depths: Sequence[int] = GRID_DEPTHS,
    iterations: Sequence[int] = GRID_ITERATIONS,
    seed: int = 42,
) -> tuple[PipelineModel, dict[str, float]]:
    """Choose the grid point by cross-validated area under the curve, fitted on all training rows.

    ``terms`` is a term-vector table with the inputs and the score; the model starts from it. The score
    thresholds behind the labels come from training rows only. Weights of words and scales of numbers do not
    change the order of values, so trees are grown on counts and numbers as they are. All folds and
    depths grow side by side, and fewer iterations are the first trees of more.
    """
    learn, judge = train_test_split(terms, seed=seed)
    thresholds = checkpointed(score_thresholds(learn, percentile))
    learn, judge = label_by_threshold(learn, thresholds), label_by_threshold(judge, thresholds)
    numbers = [*NUMERIC_INPUTS, *FLAG_INPUTS]
    learn = learn.select(TERMS, *numbers, "label", hash_bucket(cv_folds, seed + 1).alias("fold"))
    grid = [(depth, trees) for depth in depths for trees in iterations]
    fits = [Fit(fold, depth) for depth in depths for fold in (-1, *range(cv_folds))]

    with staged(learn, "engagement_learn", sparse_schema(learn.schema)) as stored:
        rows = stored.select(f"{TERMS}.*", *numbers, "label", "fold")
        words = rows.agg(F.max("size")).first()[0] or 0
        cells = find_cells(rows, numbers, words)
        with staged(pack_blocks(spread_small(rows), numbers, cells), "engagement_blocks") as blocks:
            fit_trees(blocks, cells, fits, max(iterations))
            with staged(held_out_scores(blocks, cells, fits, iterations), "held_out") as scores:
                areas = metrics.area_under_roc(scores, by=["fit", "trees"]).collect()
    # A fold that lacks one of the labels counts 0, so that it favours no grid point.
    found = {(r["fit"], r["trees"]): r["area_under_roc"] or 0.0 for r in areas}
    averages = [
        sum(found.get((e, trees), 0.0) for e, fit in enumerate(fits) if fit.depth == depth and fit.fold >= 0) / cv_folds
        for depth, trees in grid
    ]
    best = max(range(len(grid)), key=averages.__getitem__)
    depth, trees = grid[best]
    whole = next(fit for fit in fits if fit.depth == depth and fit.fold < 0)
    model = PipelineModel([as_model(whole, cells, trees, terms=TERMS, numbers=numbers)])
    return model, {**area_metrics(model.transform(judge)), "best_avg_metric": averages[best]}


def train_engagement(
    events: DataFrame, *, vocab_size: int, min_doc_freq: int, min_token_length: int = 3, **settings
) -> tuple[PipelineModel, dict[str, float]]:
    """:func:`fit_engagement` on events of its own; the model scores events."""
    counter = term_counter(
        events, vocab_size=vocab_size, min_doc_freq=min_doc_freq, min_token_length=min_token_length
    )
    with staged(with_terms(counter, derived_flags(events), *NEEDED), "engagement_terms") as terms:
        model, measured = fit_engagement(terms, **settings)
    return PipelineModel([*counter.stages, *model.stages]), measured


def _area(predictions: DataFrame) -> float:
    """The exact area under the ROC curve; 0 if one of the labels is missing."""
    return metrics.area_under_roc(predictions, "rawPrediction").first()[0] or 0.0


def area_metrics(predictions: DataFrame) -> dict[str, float]:
    """Areas under the ROC and the precision-recall curve."""
    with staged(predictions.select("rawPrediction", "label"), "predictions") as narrow:
        precision = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")
        return {"areaUnderROC": _area(narrow), "areaUnderPR": float(precision.evaluate(narrow))}


PREDICTION_COLUMNS = [
    "event_id",
    "topic",
    "channel",
    "created_date",
    "score",
    "is_high_engagement",
    "engagement_probability",
]


def with_engagement(model: PipelineModel, flagged: DataFrame) -> DataFrame:
    """Prediction and probability for events that carry the derived flags."""
    return (
        model.transform(flagged)
        .withColumnRenamed("prediction", "is_high_engagement")
        .withColumnRenamed("probability", "engagement_probability")
    )


def predict_engagement(model: PipelineModel, events: DataFrame) -> DataFrame:
    return with_engagement(model, derived_flags(events)).select(*PREDICTION_COLUMNS)
