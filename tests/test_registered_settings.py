"""The registered fits run with the defaults of the jobs."""

import pytest

from lakekit.plans import jobs
from lakekit.workload import queries

DEFAULTS = jobs.ModelSettings()


class Stopped(Exception):
    pass


@pytest.mark.parametrize(
    ("name", "module", "function", "want"),
    [
        ("lda_terms", "topics", "train_topic_model", {"k": 12, "max_iter": 30, "vocab_size": 20_000}),
        ("lda_topics", "topics", "train_topic_model", {"k": 12, "max_iter": 30, "vocab_size": 20_000}),
        ("model_roundtrip", "topics", "train_topic_model", {"k": 12, "max_iter": 30, "vocab_size": 20_000}),
        ("sentiment_scores", "sentiment", "train_sentiment", {"max_iter": 50, "vocab_size": 20_000}),
        (
            "engagement_scores",
            "engagement",
            "train_engagement",
            {
                "cv_folds": DEFAULTS.cv_folds,
                "depths": DEFAULTS.tree_depths,
                "iterations": DEFAULTS.tree_iterations,
                "vocab_size": 20_000,
            },
        ),
        ("job_train_score", "jobs", "train_job", {"settings": DEFAULTS}),
    ],
)
def test_fits_use_the_defaults(spark, monkeypatch, name, module, function, want):
    seen = {"max_iter": 50} if name == "sentiment_scores" else {}

    def caught(_, **settings):
        seen.update(settings)
        raise Stopped

    monkeypatch.setattr(getattr(queries, module), function, caught)
    monkeypatch.setattr(queries, "stage", lambda df, _: df)
    monkeypatch.setattr(queries, "_landed_lake", lambda *_: dict.fromkeys(["events_path", "gold_dir", "model_dir"], ""))
    monkeypatch.setattr(queries.frames, "post_events", lambda *_: None)
    monkeypatch.setattr(queries.frames, "silver_events", lambda *_: None)
    with pytest.raises(Stopped):
        queries.all_queries()[name](spark, "")
    assert {k: seen.get(k) for k in want} == want
