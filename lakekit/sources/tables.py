"""Reading and writing tables: overwrite, append, upsert and clustered layout.

Tables are partitioned parquet, named by path or by catalog name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.session import checkpointed, stored
from lakekit.sources import versions


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Files, folders or globs. A schema keeps partition values from being re-typed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# With splits of at most 128 MB this bounds what is moved to a few gigabytes.
MAX_SPREAD_SPLITS = 64


def spread_small(df: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Give every core a share of a small scan, or of the ``wanted`` rows derived from it.

    A small file often is one row group, hence one task however many splits it
    shows, and text work on it would use one core. A scan of more splits than
    cores, or than a fixed bound, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df if wanted is None else wanted
    if df.rdd.getNumPartitions() > min(cores, MAX_SPREAD_SPLITS):
        return rows
    return rows.repartition(cores)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _spread(
    df: DataFrame, partition_by: Sequence[str], rebalance: bool, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Gather each partition's rows into few files, ordered by ``cluster_by`` within them.

    The rebalance hint lets adaptive execution split a partition that is too
    large and merge those that are too small. A partitioned write sorts by its
    partition columns anyway, so ordering further costs little.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *cluster_by) if cluster_by else df


def write_path(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Parquet at ``path``. Skip ``rebalance`` when the frame holds one partition only:
    its tasks can then write where they stand, without a shuffle."""
    spread = _spread(df, partition_by, rebalance, cluster_by)
    stored(spread).mode(mode).partitionBy(*partition_by).parquet(path)


@dataclass(frozen=True)
class Buckets:
    """A table kept in ``number`` parts by a hash of ``columns`` and sorted by them within each."""

    number: int
    columns: tuple[str, ...]


def write_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: Buckets | None = None,
    path: str | None = None,
    comment: str | None = None,
    rebalance: bool = True,
) -> None:
    """A parquet table in the catalog, with an optional comment; managed, unless it has a ``path``.

    A join on the columns of ``buckets`` reads the table without a shuffle or a sort of its own.
    """
    if buckets is None:
        spread = _spread(df, partition_by, rebalance, cluster_by)
    else:
        # One file a bucket and partition.
        spread = df.repartition(buckets.number, *buckets.columns)
    writer = spread.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets is not None:
        first, *rest = buckets.columns
        writer = writer.bucketBy(buckets.number, first, *rest).sortBy(first, *rest)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """An upsert with two rows for one key has no single outcome, so it must not run."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    twice = source.filter(known).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"duplicate upsert keys in source: {', '.join(keys)}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, and target rows whose key the source lacks. Null keys never match."""
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(target.columns)
    return source.select(target.columns).unionByName(kept)


def _touched(source: DataFrame, target: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Partitions that receive a source row or hold a source key."""
    receiving = source.select(*parts)
    holding = target.select(*dict.fromkeys([*keys, *parts]))
    losing = holding.join(source.select(*keys), list(keys), "left_semi").select(*parts)
    return receiving.union(losing).distinct()


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    taken: Sequence[str] | DataFrame = (),
    keys_checked: bool = False,
) -> int | None:
    """Update rows whose key exists, insert the others; create the table if absent.

    Only partitions that hold a source key, or receive a source row, are read
    in full and replaced; the rest of the table is not touched. To find the
    former, keys alone are read, and where partition columns belong to the key
    only from partitions the source names. The new partitions become the table's by
    one commit (see :mod:`lakekit.sources.versions`), so no reader meets a key twice or not at
    all, wherever a run stops. Returns the new version, or ``None`` if there was nothing to do.

    ``source`` is used by several actions: pass a frame read from files. ``taken`` names what this
    run has taken in. ``keys_checked`` says that source keys are known to be unique.
    """
    if not partition_by:
        raise ValueError("upsert needs partition columns: they bound what is rewritten")
    spark, parts, schema = source.sparkSession, list(partition_by), source.schema
    if not keys_checked:
        require_unique_keys(source, keys)
    if versions.latest_version(spark, path) is None:
        merged, touched = source, None
    else:
        in_key = [c for c in parts if c in keys]
        target = (
            versions.read_partitions(spark, path, schema, source.select(*in_key).distinct())
            if in_key
            else versions.read_version(spark, path, schema)
        )
        # One narrow row a partition; found once, used for reading and for the commit.
        touched = checkpointed(_touched(source, target, keys, parts))
        if touched.isEmpty() and not isinstance(taken, DataFrame) and not taken:
            return None
        merged = merge_rows(versions.read_partitions(spark, path, schema, touched), source, keys)
    spread = _spread(merged, parts, True, cluster_by)
    return versions.commit(spread, path, partition_by=parts, touched=touched, taken=taken)


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    *,
    spread_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Rewrite so that rows near in ``cluster_by`` share files and scans can skip the rest.

    Rows equal in all range columns land in one task, so ``spread_by`` adds
    columns (a unique id, say) that split a value holding much of the table.
    Without ``files`` adaptive execution merges small outputs.
    """
    clustered(df, cluster_by, spread_by=spread_by, files=files).write.mode("overwrite").parquet(path)


def clustered(
    df: DataFrame,
    cluster_by: Sequence[str],
    *,
    spread_by: Sequence[str] = (),
    files: int | None = None,
) -> DataFrame:
    columns = [*cluster_by, *[c for c in spread_by if c not in cluster_by]]
    ranged = (
        df.repartitionByRange(*columns)
        if files is None
        else df.repartitionByRange(files, *columns)
    )
    return ranged.sortWithinPartitions(*columns)
