"""Versioned tables: one commit, whatever stops around it."""

import datetime as dt
import decimal
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakekit.session import staged
from lakekit.sources import versions
from lakekit.sources.tables import upsert, write_path

SCHEMA = StructType(
    [StructField("k", LongType()), StructField("p", StringType()), StructField("v", StringType())]
)


def _read(spark, path, schema=SCHEMA, version=None):
    return sorted(map(tuple, versions.read_version(spark, path, schema, version).collect()), key=str)


def _upsert(spark, path, rows, schema=SCHEMA, **options):
    source = spark.createDataFrame(rows, schema)
    return upsert(source, path, ["k"], partition_by=["p"], **options)


class Stopped(Exception):
    pass


# Writes of an upsert in order: the touched partitions are checkpointed, then data, then the version.
@pytest.mark.parametrize("step", [0, 1])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_around_any_write_leaves_one_row_a_key(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    first = [(1, "a", "x"), (2, "a", "x"), (3, "b", "x")]
    moved = [(1, "b", "y"), (4, "c", "y")]
    _upsert(spark, path, first)
    before, wanted = _read(spark, path), sorted([(1, "b", "y"), (2, "a", "x"), (3, "b", "x"), (4, "c", "y")])
    write, calls = DataFrameWriter.parquet, []

    def stopping(self, *args, **kwargs):
        calls.append(args[0])
        if len(calls) == step + 1 and not after:
            raise Stopped
        write(self, *args, **kwargs)
        if len(calls) == step + 1:
            raise Stopped

    monkeypatch.setattr(DataFrameWriter, "parquet", stopping)
    with pytest.raises(Stopped):
        _upsert(spark, path, moved)
    monkeypatch.undo()
    # Only the write of the version is the commit.
    assert _read(spark, path) == (wanted if step == 1 and after else before)
    _upsert(spark, path, moved)
    assert _read(spark, path) == wanted


@pytest.mark.parametrize(
    ("kind", "one", "two"),
    [
        ("boolean", True, False),
        ("date", dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
        ("decimal(6,2)", decimal.Decimal("1.50"), decimal.Decimal("2.00")),
        ("int", 7, -7),
        ("double", 0.1, 1e20),
        ("timestamp", dt.datetime(2024, 1, 1, 1, 2, 3), dt.datetime(2024, 1, 1, 1, 2, 3, 456)),
        ("string", "", "007"),
    ],
)
def test_keys_move_between_partitions_of_every_type(spark, tmp_path, kind, one, two):
    path, schema = str(tmp_path / "t"), StructType.fromDDL(f"k long, p {kind}, v string")
    # An empty string and null share one folder.
    null = None if one != "" else "x"
    _upsert(spark, path, [(1, one, "a"), (2, two, "a"), (3, null, "a"), (4, two, "a")], schema)
    _upsert(spark, path, [(1, two, "b"), (2, null, "b"), (3, two, "b")], schema)
    rows = {r["k"]: (r["p"], r["v"]) for r in versions.read_version(spark, path, schema).collect()}
    assert rows == {1: (two, "b"), 2: (null, "b"), 3: (two, "b"), 4: (two, "a")}
    assert versions.read_version(spark, path, schema).count() == 4


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _upsert(spark, path, [(1, "a", "x"), (2, "b", "x")]) == 1
    reader = versions.read_version(spark, path, SCHEMA)
    assert _upsert(spark, path, [(1, "b", "y")]) == 2
    assert sorted(map(tuple, reader.collect())) == [(1, "a", "x"), (2, "b", "x")]
    assert _read(spark, path) == [(1, "b", "y"), (2, "b", "x")]
    assert _read(spark, path, version=1) == [(1, "a", "x"), (2, "b", "x")]


def test_untouched_partitions_keep_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    _upsert(spark, path, [(i, f"p{i % 5}", "x") for i in range(20)])
    before = {r["part"]["p"]: r["folder"] for r in versions.listing(spark, path).collect()}
    _upsert(spark, path, [(0, "p0", "y"), (6, "p2", "y")])
    after = {r["part"]["p"]: r["folder"] for r in versions.listing(spark, path).collect()}
    assert {p for p in before if before[p] != after[p]} == {"p0", "p1", "p2"}
    changed, number = versions.changed_partitions(spark, path, 1)
    assert number == 2 and {r["p"] for r in changed.collect()} == {"p0", "p1", "p2"}
    assert versions.changed_partitions(spark, path, 2)[0].isEmpty()
    assert versions.changed_partitions(spark, path, None)[0].count() == 5
    assert versions.changed_partitions(spark, str(tmp_path / "none"), None) is None


def test_a_partition_that_loses_all_rows_is_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    _upsert(spark, path, [(1, "a", "x"), (2, "b", "x")])
    _upsert(spark, path, [(1, "b", "y")])
    assert [r["part"]["p"] for r in versions.listing(spark, path).collect()] == ["b"]
    assert {r["p"] for r in versions.changed_partitions(spark, path, 1)[0].collect()} == {"a", "b"}


def test_names_taken_in_come_with_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    names = lambda: sorted(r["taken"] for r in versions.taken_names(spark, path).collect())
    assert names() == []
    _upsert(spark, path, [(1, "a", "x")], taken=["b1"])
    _upsert(spark, path, [(2, "a", "x")], taken=spark.createDataFrame([("b2",), ("b1",)], "taken string"))
    assert names() == ["b1", "b2"]
    # A batch without rows is taken in too; nothing at all is no version.
    assert _upsert(spark, path, [], taken=["b3"]) == 3
    assert _upsert(spark, path, []) is None
    assert names() == ["b1", "b2", "b3"] and _read(spark, path) == [(1, "a", "x"), (2, "a", "x")]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path, SCHEMA)
    _upsert(spark, path, [])
    assert _read(spark, path) == []
    _upsert(spark, path, [(1, None, "x")])
    assert _read(spark, path) == [(1, None, "x")]


def test_a_second_writer_of_the_same_version_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    _upsert(spark, path, [(1, "a", "x")])
    monkeypatch.setattr(versions, "latest_version", lambda *a: 1)
    _upsert(spark, path, [(2, "a", "x")])
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        _upsert(spark, path, [(3, "a", "x")])
    monkeypatch.undo()
    assert _read(spark, path) == [(1, "a", "x"), (2, "a", "x")]


def test_forgetting_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        _upsert(spark, path, [(1, "a", f"v{i}"), (10 + i, f"p{i}", "x")])
    want = _read(spark, path)
    # The first four folders of partition a; every other partition still is as first written.
    assert versions.forget_versions(spark, path, keep=1) == 4
    assert versions.known_versions(spark, path) == [5] and _read(spark, path) == want
    assert versions.forget_versions(spark, path, keep=2) == 0
    spark.createDataFrame([(9, "z", "left")], SCHEMA).write.partitionBy("p").parquet(f"{path}/data/_run=stopped")
    assert versions.forget_versions(spark, path, keep=1, uncommitted=True) == 1
    assert _read(spark, path) == want
    assert spark.read.parquet(f"{path}/data").filter(F.col("v") == "left").isEmpty()
    assert versions.forget_versions(spark, str(tmp_path / "none")) == 0


def test_stored_texts_are_packed_closely(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id AS k", "'a' AS p", "concat_ws(' ', md5(CAST(id AS STRING)), 'words', id) AS v")
    versions.commit(rows, f"{tmp_path}/t", partition_by=["p"], touched=None)
    write_path(rows, f"{tmp_path}/u")
    with staged(rows, "v") as source:
        files = [urlparse(f).path for f in source.inputFiles()]
        files += [*tmp_path.glob("t/data/**/*.parquet"), *tmp_path.glob("u/*.parquet")]
        codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
        assert len(files) > 2 and codecs == {"ZSTD"}
