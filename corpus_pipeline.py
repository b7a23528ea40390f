"""A corpus from raw documents: quality, exact copies, near copies, benchmark leaks, token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinsift.llm.decontaminate import keep_clean
from clinsift.llm.exact_dedup import keep_first
from clinsift.llm.piece_scan import encode
from clinsift.llm.quality import keep_good
from clinsift.llm.simhash import keep_representatives
from clinsift.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies stays."""
    return keep_representatives(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids`` and the digest of the text read back from the ids."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode(docs, model, decoded=True).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2("text", 256).alias("text_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

ORACLE_SQL = None  # the classifier and the fingerprints cannot be expressed in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
