import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakekit.ml import engagement, features, metrics, models, scoring, sentiment, topics
from lakekit.ml.features import hash_bucket, train_test_split
from lakekit.operators.labels import derived_flags
from lakekit.plans import jobs
from lakekit.schema import EVENT_KEYS
from lakekit.session import stage
from lakekit.sources.tables import upsert


def test_term_counter_drops_stop_words_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("t", "1", "the model and the data"), ("t", "2", "Data, about models; model's data"), ("t", "3", None)],
        "topic string, event_id string, text string",
    )
    counter = features.term_counter(df, vocab_size=50, min_doc_freq=1)
    assert counter.stages[-1].vocabulary == ["data", "model", "models"]
    rows = features.with_terms(counter, df).orderBy("event_id").collect()
    assert [r[features.TERMS].toArray().tolist() for r in rows] == [[1, 1, 0], [2, 1, 1], [0, 0, 0]]
    assert features.term_counter(df, vocab_size=1, min_doc_freq=1).stages[-1].vocabulary == ["data"]
    nothing = features.term_counter(df, vocab_size=5, min_doc_freq=9)
    assert features.with_terms(nothing, df).first()[features.TERMS].size == 1
    known = {r["token"]: (r["doc_freq"], r["total"]) for r in features.vocabulary(df, min_doc_freq=1).collect()}
    assert known == {"data": (2, 3), "model": (2, 2), "models": (1, 1)}
    assert not set(known) & set(features.stop_words())


def test_numbers_are_centred(events):
    inputs = derived_flags(events)
    fitted = Pipeline(stages=features.number_stages()).fit(inputs)
    arrays = fitted.transform(inputs).select(vector_to_array("scaled_numbers").alias("v"))
    means = arrays.select(*[F.avg(F.col("v")[i]) for i in range(7)]).first()
    assert all(abs(m) < 1e-9 for m in means)


def test_input_holds_words_and_numbers(events):
    counter = features.term_counter(events, vocab_size=50, min_doc_freq=1)
    terms = features.with_terms(counter, derived_flags(events), *features.NUMERIC_INPUTS, *features.FLAG_INPUTS)
    out = Pipeline(stages=features.input_stages()).fit(terms).transform(terms)
    assert "text" not in out.columns and out.first()[features.INPUT].size == len(counter.stages[-1].vocabulary) + 7


def test_split_does_not_depend_on_layout(events):
    train, test = train_test_split(events)
    again, _ = train_test_split(events.repartition(7))
    assert train.count() + test.count() == events.count()
    assert train.select("event_id").exceptAll(again.select("event_id")).isEmpty()
    folds = events.groupBy(hash_bucket(3, 1).alias("f")).count().collect()
    assert {r["f"] for r in folds} == {0, 1, 2}


def test_dominant_topic_ties_and_empty(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.0, 0.0, 0.0],)], "a array<double>")
    rows = topics.with_dominant_topic(df, "a").collect()
    assert [(r["dominant_topic"], r["topic_confidence"]) for r in rows] == [(1, 0.4), (0, 0.0)]
    empty = topics.with_dominant_topic(df, "a", empty_as_null=True).collect()[1]
    assert (empty["dominant_topic"], empty["topic_confidence"]) == (None, None)


@pytest.fixture(scope="module")
def topic_model(events):
    return topics.train_topic_model(
        events, k=3, vocab_size=100, min_token_length=3, min_doc_freq=1, max_iter=3
    )


def test_topics(spark, events, topic_model):
    model, frame = topic_model
    terms = sorted(map(tuple, frame.collect()))
    assert frame.columns == ["topic_id", "terms", "term_weights", "label"]
    assert [t[0] for t in terms] == [0, 1, 2]
    assert all(len(t[1]) == len(t[2]) == 10 and t[3] == ", ".join(t[1][:4]) for t in terms)
    assert all(t[2] == sorted(t[2], reverse=True) for t in terms)
    described = {r["topic"]: r["termIndices"] for r in model.stages[-1].describeTopics(10).collect()}
    words = model.stages[-2].vocabulary
    assert {t[0]: t[1] for t in terms} == {k: [words[i] for i in v] for k, v in described.items()}
    assigned = topics.assign_topics(model, events)
    assert assigned.count() == events.count()
    assert assigned.filter("dominant_topic NOT BETWEEN 0 AND 2").isEmpty()
    plan = assigned._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_model_versions_and_alias(spark, events, topic_model, tmp_path):
    model, _ = topic_model
    folder = str(tmp_path / "models")
    with pytest.raises(LookupError):
        models.load_model(spark, folder, "lda")
    first = models.save_model(model, folder, "lda")
    second = models.save_model(model, folder, "lda")
    assert (first, second) == (1, 2)
    models.set_alias(spark, folder, "lda", models.CHAMPION, second)
    models.set_alias(spark, folder, "lda", models.CHAMPION, first)
    assert models.latest_version(spark, folder, "lda", models.CHAMPION) == 1
    loaded = topics.assign_topics(models.load_model(spark, folder, "lda"), events)
    same = topics.assign_topics(model, events)
    columns = ["event_id", "dominant_topic", "topic_confidence"]
    assert loaded.select(columns).exceptAll(same.select(columns)).isEmpty()


def test_sentiment(events):
    model, metrics = sentiment.train_sentiment(events, vocab_size=100, min_doc_freq=1, max_iter=10)
    assert set(metrics) == {"f1", "accuracy"} and all(0 <= m <= 1 for m in metrics.values())
    scored = sentiment.score_sentiment(model, events)
    assert scored.count() == events.count()
    assert scored.filter("sentiment_label NOT IN ('negative', 'neutral', 'positive')").isEmpty()


def test_class_metrics(spark):
    pairs = [(0.0, 0.0)] * 3 + [(1.0, 0.0)] + [(1.0, 1.0)] * 4 + [(0.0, 2.0)] + [(None, 1.0)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    got = metrics.class_metrics(df).first().asDict()
    known = df.filter("label IS NOT NULL")
    for name in ("f1", "accuracy"):
        own = MulticlassClassificationEvaluator(metricName=name).evaluate(known)
        assert got[name] == pytest.approx(own)
    assert metrics.class_metrics(df.limit(0)).first()["f1"] is None


def test_area_under_roc(spark):
    draw = random.Random(7)
    rows = [(round(draw.gauss(i % 4 == 0, 1), 1), float(i % 4 == 0)) for i in range(3000)] + [(None, 1.0), (0.5, None)]
    df = spark.createDataFrame(rows, "score double, label double")
    ones = [s for s, y in rows if y == 1 and s is not None]
    zeros = [s for s, y in rows if y == 0]
    want = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / len(ones) / len(zeros)
    assert metrics.area_under_roc(df).first()[0] == pytest.approx(want)
    raw = df.filter("score IS NOT NULL AND label IS NOT NULL").withColumnRenamed("score", "rawPrediction")
    own = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert metrics.area_under_roc(df).first()[0] == pytest.approx(own, abs=1e-4)
    assert metrics.area_under_roc(df.filter("label = 1")).first()[0] is None


def test_text_is_split_once_for_fits_and_scores(spark, events, tmp_path, monkeypatch):
    """One counting model; all fits and all scores read its vectors."""
    seen = []
    split = features.RegexTokenizer._transform
    monkeypatch.setattr(features.RegexTokenizer, "_transform", lambda s, df: seen.append(1) or split(s, df))
    path, gold_dir, model_dir = (str(tmp_path / n) for n in ("events", "gold", "models"))
    upsert(events, path, EVENT_KEYS, partition_by=jobs.EVENT_PARTITIONS)
    settings = jobs.ModelSettings(topic_count=2, topic_max_iterations=2, vocab_size=40, min_doc_freq=1,
                                  cv_folds=2, tree_depths=(2,), tree_iterations=(2,))
    jobs.train_job(spark, events_path=path, gold_dir=gold_dir, model_dir=model_dir, settings=settings)
    assert len(seen) == 1
    trained = {n: sorted(map(str, spark.read.parquet(f"{gold_dir}/{n}").collect())) for n in scoring._SCORES}
    jobs.score_job(spark, events_path=path, gold_dir=gold_dir, model_dir=model_dir)
    assert {n: sorted(map(str, spark.read.parquet(f"{gold_dir}/{n}").collect())) for n in scoring._SCORES} == trained
    counter = models.load_model(spark, model_dir, scoring.TERM_COUNTER)
    table = scoring.term_table(counter, events)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(UDF(") == 1
    fitted = {n: models.load_model(spark, model_dir, n) for n in (scoring.TOPIC_MODEL, scoring.SENTIMENT_MODEL, scoring.ENGAGEMENT_MODEL)}
    narrow = scoring.score_terms(spark.createDataFrame(table.collect(), table.schema), fitted)
    assert "text#" not in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_one_pass_scores_equal_separate_scores(events, topic_model):
    sentiment_model, _ = sentiment.train_sentiment(
        events, vocab_size=50, min_doc_freq=1, max_iter=3
    )
    engagement_model, _ = engagement.train_engagement(
        events, vocab_size=50, min_doc_freq=1, cv_folds=2, depths=(2,), iterations=(2,)
    )
    together = scoring.score_events(
        events,
        topic_model=topic_model[0],
        sentiment_model=sentiment_model,
        engagement_model=engagement_model,
    )
    apart = {
        "post_topics": topics.assign_topics(topic_model[0], events),
        "post_sentiment": sentiment.score_sentiment(sentiment_model, events),
        "engagement_predictions": engagement.predict_engagement(engagement_model, events),
    }
    assert set(together) == set(apart)
    for name, frame in together.items():
        assert frame.columns == apart[name].columns
        assert frame.exceptAll(apart[name]).isEmpty() and frame.count() == events.count()


def test_engagement(events):
    model, metrics = engagement.train_engagement(
        events, vocab_size=50, min_doc_freq=1, cv_folds=2, depths=(2, 3), iterations=(2,)
    )
    assert set(metrics) == {"areaUnderROC", "areaUnderPR", "best_avg_metric"}
    assert all(0 <= m <= 1 for m in metrics.values())
    scored = engagement.predict_engagement(model, events)
    assert scored.count() == events.count()
    assert scored.filter("engagement_probability NOT BETWEEN 0 AND 1").isEmpty()
    assert scored.filter("is_high_engagement NOT IN (0.0, 1.0)").isEmpty()


def test_vectors_are_read_as_what_texts_hold(spark):
    """No frame of the words' counts is as wide as the vocabulary."""
    df = spark.createDataFrame([("t", "1", "one two two")], "topic string, event_id string, text string")
    counter = features.term_counter(df, vocab_size=50, min_doc_freq=1)
    assert len(counter.stages) == 2
    vectors = features.with_terms(counter, df)
    plain = stage(vectors, "plain", features.sparse_schema(vectors.schema)).first()[features.TERMS]
    assert (plain["size"], plain["indices"], plain["values"]) == (2, [0, 1], [2.0, 1.0])
