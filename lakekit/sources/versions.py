"""Partitioned Parquet tables that change by one commit at a time.

Every change writes the partitions it replaces to a folder of its own run, under ``data``,
and then one small file under ``versions`` that lists the folders the table now consists of. The
appearance of that file is the commit. Before it readers see the table as it
was, after it as it is; a run that stops anywhere leaves the last version as it
stands, and folders nobody reads. Old versions can be read until they are forgotten.

A version may also name what it has taken in (batches, or a version of another table), so that
a job's progress and its result cannot disagree. One writer at a time: a second one that
starts from the same version fails on finding the next one taken.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakekit.session import stored
from lakekit.sources.bronze import read_optional

RUN = "_run"
VERSION = "version"


def _data(path: str) -> str:
    return f"{path}/data"


def _versions(path: str) -> str:
    return f"{path}/versions"


def known_versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions in ascending order, from the names of their files."""
    found = read_optional(spark, _versions(path))
    files = [] if found is None else found.inputFiles()
    return sorted({int(re.search(rf"/{VERSION}=(\d+)/", file).group(1)) for file in files})


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max(known_versions(spark, path), default=None)


def _listing_schema(schema: StructType, parts: Sequence[str]) -> StructType:
    of_part = StructType([StructField(p, schema[p].dataType) for p in parts])
    return StructType(
        [
            StructField("folder", StringType()),
            StructField("part", of_part),
            StructField("taken", StringType()),
        ]
    )


def listing(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """``folder, part, taken`` of a version (default: the latest): one row for each partition
    with its folder and values, one for each name taken in."""
    version = latest_version(spark, path) if version is None else version
    return None if version is None else spark.read.parquet(f"{_versions(path)}/{VERSION}={version}")


def taken_names(spark: SparkSession, path: str) -> DataFrame:
    """``taken``: the names that the latest version has taken in."""
    listed = listing(spark, path)
    if listed is None:
        return spark.createDataFrame([], "taken string")
    return listed.filter("taken IS NOT NULL").select("taken")


def _read_folders(
    spark: SparkSession, path: str, folders: Sequence[str], schema: StructType
) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", _data(path))
    return reader.parquet(*[f"{_data(path)}/{folder}" for folder in folders]).select(*schema.names)


def _folders(listed: DataFrame) -> list[str]:
    """One name for each partition, as many as Spark itself lists to read a table."""
    return [r["folder"] for r in listed.filter("folder IS NOT NULL").select("folder").collect()]


def read_version(
    spark: SparkSession, path: str, schema: StructType, version: int | None = None
) -> DataFrame:
    """The table at a version (default: the latest). A frame keeps reading the version it was
    made from, whatever is committed later."""
    listed = listing(spark, path, version)
    if listed is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return _read_folders(spark, path, _folders(listed), schema)


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    wanted: DataFrame,
    version: int | None = None,
) -> DataFrame:
    """The rows of a version (default: the latest) in the partitions whose values ``wanted`` holds,
    in columns named like theirs. Only those partitions' folders are opened."""
    listed = listing(spark, path, version)
    return _read_folders(spark, path, _folders(_matching(listed, wanted, "left_semi")), schema)


def _matching(listed: DataFrame, values: DataFrame, how: str) -> DataFrame:
    """Partitions of a listing that have, or have not, the given values; nulls match each other."""
    named = values.select(F.struct(*values.columns).alias("_values"))
    same = F.struct(*[F.col(f"part.`{c}`").alias(c) for c in values.columns]).eqNullSafe(F.col("_values"))
    return listed.filter("folder IS NOT NULL").join(named, same, how)


def holds_any(spark: SparkSession, path: str, values: DataFrame) -> bool:
    """Whether the latest version has one of the partitions."""
    listed = listing(spark, path)
    return listed is not None and not _matching(listed, values, "left_semi").isEmpty()


def changed_partitions(
    spark: SparkSession, path: str, since: int | None
) -> tuple[DataFrame, int] | None:
    """The values of the partitions that differ between a version and the latest, and the
    latest version's number. A version that is no longer known counts as none: all partitions."""
    versions = known_versions(spark, path)
    if not versions:
        return None
    now = listing(spark, path, versions[-1]).filter("folder IS NOT NULL")
    if since not in versions:
        return now.select("part.*"), versions[-1]
    before = listing(spark, path, since).filter("folder IS NOT NULL")
    gone = before.join(now, "folder", "left_anti").select("part.*")
    new = now.join(before, "folder", "left_anti").select("part.*")
    return gone.union(new).distinct(), versions[-1]


def _folder_of_file() -> Column:
    """The folder of the file a row was read from, below ``data``, as Spark has named it."""
    path = F.regexp_extract("_metadata.file_path", rf"/data/({RUN}=.*)/[^/]*$", 1)
    # File paths are given as URIs. A plus sign stands for itself there.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _all_names(
    spark: SparkSession, taken: Iterable[str] | DataFrame, before: DataFrame | None
) -> DataFrame | None:
    """The given names and those of a listing, each once; ``None`` if there are none at all."""
    if not isinstance(taken, DataFrame):
        fixed = F.array(*[F.lit(name) for name in taken])
        taken = spark.range(1).select(F.explode(fixed).alias("taken")) if list(taken) else None
    earlier = None if before is None else before.filter("taken IS NOT NULL").select("taken")
    if taken is None or earlier is None:
        return earlier if taken is None else taken.distinct()
    return taken.union(earlier).distinct()


def commit(
    rows: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str],
    touched: DataFrame | None,
    taken: Iterable[str] | DataFrame = (),
    independent: bool = False,
) -> int:
    """Put ``rows`` in place of all partitions in ``touched`` (``None``: of the whole table) and
    return the new version's number.

    ``rows`` is written as it comes, so spread it for the write before. ``touched`` has the
    partition columns and holds at least the partitions of ``rows``. ``taken`` is added to the
    names taken in by earlier versions. ``independent`` says that the rows do not follow from what the
    table held; then a version that another writer has taken meanwhile is no conflict.
    """
    spark, parts = rows.sparkSession, list(partition_by)
    last = latest_version(spark, path)
    run = uuid.uuid4().hex
    folder = f"{_data(path)}/{RUN}={run}"
    stored(rows).partitionBy(*parts).parquet(folder)

    shape = _listing_schema(rows.schema, parts)
    written = spark.read.schema(rows.schema).option("basePath", _data(path)).parquet(folder)
    written = written.select(
        _folder_of_file().alias("folder"), F.struct(*parts).alias("part")
    ).distinct()
    added = written.withColumn("taken", F.lit(None).cast("string"))
    while True:
        before = None if last is None else listing(spark, path, last)
        listed = added
        if before is not None and touched is not None:
            listed = listed.union(_matching(before, touched.select(*parts), "left_anti"))
        names = _all_names(spark, taken, before)
        if names is not None:
            of_part = F.lit(None).cast(shape["part"].dataType)
            listed = listed.unionByName(
                names.withColumns({"folder": F.lit(None).cast("string"), "part": of_part})
            )
        number = (last or 0) + 1
        try:
            # One narrow row a partition, in one file: its move into place is the commit.
            listed.coalesce(1).write.mode("errorifexists").parquet(
                f"{_versions(path)}/{VERSION}={number}"
            )
            return number
        except AnalysisException as error:
            if not independent or error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        newer = latest_version(spark, path)
        if newer == last:
            raise RuntimeError(f"version {number} of {path} is taken but not there")
        last = newer


def forget_versions(spark: SparkSession, path: str, *, keep: int = 3, uncommitted: bool = False) -> int:
    """Delete all versions but the last ``keep`` and the partition folders that only they use;
    returns how many folders. Readers of a forgotten version fail, so keep as many as the
    longest reader needs. ``uncommitted`` deletes leftovers of stopped runs too, when no writer is at work.
    """
    versions = known_versions(spark, path)
    if not versions:
        return 0
    old, kept = versions[:-keep], versions[-keep:]
    needed = {f for v in kept for f in _folders(listing(spark, path, v))}
    dropped = {f for v in old for f in _folders(listing(spark, path, v))} - needed
    if uncommitted:
        files = read_optional(spark, _data(path))
        named = [] if files is None else files.select(_folder_of_file().alias("f")).distinct().collect()
        dropped |= {r["f"] for r in named} - needed
    # The listings go first: a version without its folders must not be found.
    for version in old:
        _delete(spark, f"{_versions(path)}/{VERSION}={version}")
    for folder in dropped:
        _delete(spark, f"{_data(path)}/{folder}")
    return len(dropped)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
