"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

# Texts take about half the room that Spark's default leaves them, on disks and on their way there.
COMPRESSION = "zstd"

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the results depend on: calendar parts are computed in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(app: str = "lakekit", cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where driver and
    executors share one disk. On a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _local_folders.setdefault(
            context.applicationId, tempfile.mkdtemp(prefix="lakekit-")
        )
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute a small aggregate now and once, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Used where several actions need the same expensive frame: files outlive a
    lost executor, a cache block does not. They are read by ``schema``, if it is given.
    """
    return df.sparkSession.read.schema(schema or df.schema).parquet(_write_staged(df, name))


@contextmanager
def staged(df: DataFrame, name: str, schema: StructType | None = None) -> Iterator[DataFrame]:
    """:func:`stage` for the length of a block; the files are freed at its end."""
    spark = df.sparkSession
    path = _write_staged(df, name)
    try:
        yield spark.read.schema(schema or df.schema).parquet(path)
    finally:
        # Overwriting with no rows drops the files by means of Spark alone.
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def _write_staged(df: DataFrame, name: str) -> str:
    path = f"{shared_folder(df.sparkSession)}/staged/{name}-{uuid.uuid4().hex}"
    stored(df).parquet(path)
    return path


def stored(df: DataFrame) -> DataFrameWriter:
    """The writer of all Parquet files with texts."""
    return df.write.option("compression", COMPRESSION)
