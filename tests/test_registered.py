"""Every registered query against its SQL, on the smallest supplied tables."""

import math
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402

from lakekit.workload.oracle import all_sql  # noqa: E402
from lakekit.workload.queries import all_queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_matches_sql(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = oracle.execute(contract.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    types = {d[0]: str(d[1]) for d in relation.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    at = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=str)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=str)
    assert len(got) == len(want)
    assert all(_same(x, y) for a, b in zip(got, want, strict=True) for x, y in zip(a, b, strict=True))


def test_every_oracle_has_a_query_and_fits_have_rows(spark):
    queries, sql = all_queries(), all_sql()
    assert set(sql) <= set(queries) <= set(contract.queries())
    rows_only = set(queries) - set(sql)
    assert rows_only == {
        "lda_terms",
        "lda_topics",
        "sentiment_scores",
        "engagement_scores",
        "model_roundtrip",
        "job_train_score",
    }


def test_entry(spark):
    assert contract.entry(spark).count() > 0
