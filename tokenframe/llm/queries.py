"""The registered queries of this subpackage; none has an equivalent in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat, decontaminate, fim, katz, licenses, merkle, minhash, packing, pii, quality, sharding, substrings, tokencounts,
)

TOKENIZER_FILES = ("word_bpe_49k.json", "byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, "doc_id", "text", items, "item_id", "text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_report(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document, and after two edits: its source in place of 20 characters
    in its middle, and its language and a blank in front."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    middle = F.floor(F.coalesce(F.length("text"), F.lit(0)) / 2).cast("bigint")
    edits = F.array(
        F.struct(middle.alias("start"), (middle + 20).alias("stop"), F.col("source").alias("new")),
        F.struct(
            F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("stop"),
            F.concat("lang", F.lit(" ")).alias("new"),
        ),
    )
    edited = docs.select("doc_id", "text", edits.alias("edits"))
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    return tokencounts.count_tokens(edited, "doc_id", "text", "edits", path, public_tokenizers.PATTERN)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.fit_and_score(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :t), (-1L, 1L, 'assistant', :t) AS v(conv_id, turn, role, text)",
        {"t": tricky},
    )
    turns = chat.format_turns(rows.unionByName(extra), "conv_id", "turn", "role", "text")
    return chat.read_back(turns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows, and what they fold to where line feeds were lost since."""
    docs = _table(spark, sf_dir, "documents")
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    now = {"text": F.when(lost, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    proofs = merkle.manifest(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"], now)
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.translate("proof", "*/", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digests(_table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {
    name: function
    for name, function in globals().items()
    if name.startswith("op") and name[2:3].isdigit()
}
ORACLES: dict[str, str] = {}
