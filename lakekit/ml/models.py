"""Saved models with numbered versions and named aliases, kept as plain datasets."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakekit.sources.bronze import read_optional

CHAMPION = "champion"
_REGISTRY_SCHEMA = "name string, version int, alias string, recorded_at timestamp"


def _registry_path(model_dir: str) -> str:
    return f"{model_dir}/registry"


def _record(spark: SparkSession, model_dir: str, name: str, version: int, alias: str | None) -> None:
    row = [(name, version, alias, dt.datetime.now(dt.timezone.utc))]
    entry = spark.createDataFrame(row, _REGISTRY_SCHEMA).coalesce(1)
    entry.write.mode("append").parquet(_registry_path(model_dir))


def latest_version(spark: SparkSession, model_dir: str, name: str, alias: str | None = None) -> int | None:
    """The newest version, or the one an alias was last set to."""
    entries = read_optional(spark, _registry_path(model_dir))
    if entries is None:
        return None
    mine = entries.filter(F.col("name") == name)
    if alias is None:
        return mine.agg(F.max("version")).first()[0]
    return mine.filter(F.col("alias") == alias).agg(F.max_by("version", "recorded_at")).first()[0]


def save_model(model: PipelineModel, model_dir: str, name: str) -> int:
    """Write the next version. It is recorded only after its files are complete."""
    spark = SparkSession.active()
    version = (latest_version(spark, model_dir, name) or 0) + 1
    model.write().overwrite().save(f"{model_dir}/{name}/v{version}")
    _record(spark, model_dir, name, version, None)
    return version


def set_alias(spark: SparkSession, model_dir: str, name: str, alias: str, version: int) -> None:
    _record(spark, model_dir, name, version, alias)


def load_model(spark: SparkSession, model_dir: str, name: str, alias: str = CHAMPION) -> PipelineModel:
    version = latest_version(spark, model_dir, name, alias)
    if version is None:
        raise LookupError(f"no version of {name} has the alias {alias}")
    return PipelineModel.load(f"{model_dir}/{name}/v{version}")
