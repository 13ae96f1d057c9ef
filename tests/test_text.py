import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakekit.functions.text import UNEVEN_SPACE, clean_text, is_placeholder, tokens, word_count

SAMPLES = [
    ("a\t b", "a b"),
    ("a \x01 b", "a  b"),
    ("  x  ", "x"),
    (None, None),
    ("[Removed] ", "[Removed]"),
    ("N/A", "N/A"),
    ("line\nbreak\r\nend", "line break end"),
    ("a\x0bb", "a b"),
]


def test_clean_text_samples(spark):
    df = spark.createDataFrame(SAMPLES, "raw string, want string")
    got = df.select(clean_text(F.col("raw")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_single_spaces_cost_no_replacement(spark):
    texts = [("a b  c\t d \n e\x0b\x0cf ",), (" \r\n",), ("a b",), ("",)]
    rows = spark.createDataFrame(texts, "t string")
    got = rows.select(F.regexp_replace("t", UNEVEN_SPACE, " "), F.regexp_count("t", F.lit(UNEVEN_SPACE))).collect()
    assert [r[0] for r in got] == [re.sub(r"\s+", " ", t) for (t,) in texts]
    assert [r[1] for r in got] == [4, 1, 0, 0]


def test_strip_controls_first_leaves_single_spaces(spark):
    df = spark.createDataFrame([("a \x01 b",), ("a\x0cb",)], "raw string")
    got = [r[0] for r in df.select(clean_text(F.col("raw"), True)).collect()]
    assert got == ["a b", "a b"]


def test_placeholders(spark):
    rows = [("[removed]",), (" [DELETED] ",), ("",), ("n/a",), (None,), ("kept",), ("[removed] x",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(is_placeholder(F.col("t"))).collect()]
    assert got == [True, True, True, True, True, False, False]


def _python_clean(text):
    spaced = re.sub(r"[ \t\n\x0b\f\r]+", " ", text)
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", spaced).strip(" ")


texts = st.lists(
    st.text(alphabet=st.sampled_from("ab?é  \t\n\r\x01\x0b\x0c\x1f"), max_size=20),
    min_size=1,
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_clean_text_law(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    cleaned = clean_text(F.col("t"))
    got = df.select(cleaned.alias("c"), word_count(cleaned).alias("n")).collect()
    want = [_python_clean(v) for v in values]
    assert [r["c"] for r in got] == want
    words = [len(re.split(r"[ \t\n\x0b\f\r]+", w)) if w else 0 for w in want]
    assert [r["n"] for r in got] == words


def test_tokens_match_the_tokenizer_stage(spark):
    from lakekit.ml.features import term_counter

    df = spark.createDataFrame([("The café's 3 big-Queries, ok?",), ("",), ("x yy zzz",)], "text string")
    tokenizer = term_counter(df, vocab_size=5, min_doc_freq=1).stages[0]
    rows = tokenizer.transform(df).select("words", tokens(F.col("text")).alias("mine")).collect()
    assert [r["words"] for r in rows] == [r["mine"] for r in rows]
    assert rows[0]["mine"] == ["the", "caf", "big", "queries"]
