"""Registered queries of the numbered operators, with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm import (
    ann,
    backoff,
    chat,
    hard_negatives,
    html_extract,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    squares,
    token_files,
    trie_counts,
    vector_dedup,
)
from lakekit.session import configure, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_groups(_table(spark, sf_dir, "documents"))


@query
def op2_nearest(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query
def op3_html_extract(spark, sf_dir):
    return html_extract.extract(_table(spark, sf_dir, "pages"))


@query
def op4_chat_texts(spark, sf_dir):
    return chat.chat_texts(_table(spark, sf_dir, "conversations"))


_SQL["op4_chat_texts"] = chat.SQL


@query
def op5_token_files(spark, sf_dir):
    path = _run_folder(spark, "token-ids")
    token_files.write_ids(
        _table(spark, sf_dir, "documents"),
        path,
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )
    return token_files.read_checksums(spark, path)


@query
def op6_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op7_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge_labelled(docs, _table(spark, sf_dir, "labels")).drop("text")


@query
def op8_backoff(spark, sf_dir):
    return backoff.score(_table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return trie_counts.count_tokens(_table(spark, sf_dir, "documents"), model_file=model)


@query
def op10_packing(spark, sf_dir):
    pieces = packing.pack(
        _table(spark, sf_dir, "documents"),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        end_id=1,
        digest=True,
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns, "source")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the texts repeat some of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    tail = squares.repeated_tail(
        F.col("text"),
        lambda n: g % n,
        lambda n: 1 + F.floor((n - g % n) / (3 + g % 8)),
    )
    return docs.select("doc_id", F.when(h % 10 == 0, tail).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, sf_dir):
    found = squares.periodic_runs(_with_planted_runs(_table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_near_copies(spark, sf_dir):
    return vector_dedup.near_copies(_table(spark, sf_dir, "embeddings"))


@query
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
