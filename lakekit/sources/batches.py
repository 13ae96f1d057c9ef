"""What a lake keeps about its batches: which have been landed, what failed, what was set aside.

Audit rows and quarantined rows have a partition for each batch, so a batch that is run again
replaces its own rows. Quarantine is a versioned table, in which they can be replaced by none.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.quality import QualityReport, Rule, quarantine
from lakekit.schema import quoted
from lakekit.sources import versions
from lakekit.sources.bronze import read_optional

_AUDIT = (
    "job string, batch string, position int, name string, severity string, passed boolean, "
    "violating_rows long, metric double, detail string"
)
_QUARANTINE = "kind string, topic string, batch_id string, failed_rules array<string>, row string"


def record_batch(
    df: DataFrame, bronze_dir: str, *, kind: str, topic: str, batch_id: str, ingested_at: dt.datetime
) -> None:
    """Note that a batch is in bronze, and with which columns."""
    row = [(kind, topic, batch_id, df.schema.json())]
    noted = df.sparkSession.createDataFrame(
        row, "kind string, topic string, batch_id string, columns string"
    )
    noted = noted.withColumn("ingest_date", F.to_date(F.lit(ingested_at)))
    noted.coalesce(1).write.mode("append").parquet(f"{bronze_dir}/batches")


def landed_batches(spark: SparkSession, bronze_dir: str) -> DataFrame | None:
    """``kind, topic, batch_id, ingest_date, columns, taken`` of every landed batch; ``None`` for a lake
    that keeps no record. ``taken`` is the batch's name in the tables that have taken it in."""
    found = read_optional(spark, f"{bronze_dir}/batches")
    if found is None:
        return None
    name = F.concat_ws("/", "kind", "topic", "batch_id")
    return found.dropDuplicates(["kind", "topic", "batch_id", "ingest_date"]).withColumn("taken", name)


def common_schema(spark: SparkSession, batches: DataFrame) -> StructType:
    """The columns of all batches, from their records: no file is opened for it."""
    merged = StructType()
    for row in batches.select("columns").distinct().orderBy("columns").collect():
        for field in StructType.fromJson(json.loads(row["columns"])):
            if field.name not in merged.names:
                merged.add(field)
            elif merged[field.name].dataType != field.dataType:
                raise ValueError(f"column {field.name} has different types in different batches")
    return merged


def write_audit(spark: SparkSession, report: QualityReport, path: str, *, job: str, batch: str) -> None:
    """Put a report's rows in place of those of the same job and batch."""
    numbered = [
        (job, batch, i, r.name, r.severity.value, r.passed, r.violating_rows, r.metric, r.detail)
        for i, r in enumerate(report.results)
    ]
    # A report has rows, so its partition is always replaced.
    rows = spark.createDataFrame(numbered, _AUDIT).coalesce(1)
    dynamic = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dynamic.partitionBy("job", "batch").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_AUDIT).parquet(path)


def set_aside(
    df: DataFrame, rules: list[Rule], path: str, *, kind: str, batches: DataFrame, broken: int
) -> DataFrame:
    """Write the rows that break a rule to the quarantine table, and return the others.

    ``df`` has lineage columns; ``batches`` (topic, batch_id) names the batches that it is read from, whose rows
    in quarantine are replaced. ``broken`` is the number of rows that break a rule, as a report
    has it: without any, and none there from before, there is nothing to write. A row is kept as JSON, so that
    batches may have any columns.
    """
    good, bad = quarantine(df, rules)
    touched = batches.select(F.lit(kind).alias("kind"), "topic", "batch_id").distinct()
    if not broken and not versions.holds_any(df.sparkSession, path, touched):
        return good
    data = [c for c in df.columns if c != "failed_rules"]
    rows = bad.select(
        F.lit(kind).alias("kind"),
        F.col("_topic").alias("topic"),
        F.col("_batch_id").alias("batch_id"),
        "failed_rules",
        F.to_json(F.struct(*[F.col(quoted(c)) for c in data])).alias("row"),
    )
    parts = ["kind", "topic", "batch_id"]
    spread = rows.hint("rebalance", *parts)
    versions.commit(spread, path, partition_by=parts, touched=touched, independent=True)
    return good


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_version(spark, path, spark.createDataFrame([], _QUARANTINE).schema)
