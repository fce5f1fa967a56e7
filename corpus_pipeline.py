"""From raw documents to packed training sequences.

Five stages, each written as Parquet and read again: quality rules, one document of each
near-duplicate group, passages of earlier documents cut out, documents that hold benchmark
items dropped, packing. All but the last return the columns of ``documents``; every other column a
table may have passes through.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenframe.llm import decontaminate, minhash, packing, quality, substrings
from tokenframe.llm.queries import tokenizer_path
from tokenframe.llm.store import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, "doc_id", "text", "source")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, "doc_id", "text")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.without_repeats(docs, "doc_id", "text")
    return cut.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in cut.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, "doc_id", "text", items, "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Signatures, trees and fingerprints have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
