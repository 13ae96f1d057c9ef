"""From raw documents to packed training sequences, in four stages.

Each stage reads what the one before it has written as Parquet to the folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor costs its tasks and no more. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import mixing, ngram_join, packing, quality_rules
from lakekit.session import configure, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, as the labels set them.

    Null and short texts do not. Repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.judge_labelled(docs.select("doc_id", "text", *_others(docs)), labels)
    return judged.filter("kept").select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest id.

    Texts without words stay, as do those of a group without any id; of repeated rows one stays."""
    return ngram_join.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as documents: a row, with its whole text, for each time one is taken.

    Null texts and texts without words are not taken; a null source is a source of its own."""
    mixed = mixing.mix(docs.select("doc_id", "source", "text", *_others(docs)))
    taken = mixing.materialize(mixed)
    own = {"doc_id", "source", "text"}
    columns = [F.col(c) if c in own else F.col("_others")[c].alias(c) for c in docs.columns]
    return taken.select(*columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with checksums of their ids."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer=tokenizer, end_id=1, digest=True)


def _others(docs: DataFrame) -> list:
    """All columns but the text in one, so that their names are free for a stage's own."""
    return [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_others")]


def _columns(docs: DataFrame) -> list:
    return [F.col("text") if c == "text" else F.col("_others")[c].alias(c) for c in docs.columns]


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", reject_low_quality),
    ("ngram_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Shingles, likelihood ratios, sampling and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
