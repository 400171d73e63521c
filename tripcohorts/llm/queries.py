"""The operators over the whole driver tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcohorts.llm import bpe, conversations, fingerprints, language, neardup, negatives, oracle, orcfiles, packing, pages, quality, repeats, secrets, toxicity
from tripcohorts.llm.common import new_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    scored = toxicity.score_documents(documents, toxicity.fit(documents, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, folder, "documents")))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op5_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(table(spark, folder, "pages"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digests(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_documents(table(spark, folder, "documents"))


def language_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same for web pages, with the language they declare, their address and their host.

    A row for each page, repeated ids and pages without one included; a page without text has its
    declaration, address and host only.
    """
    model = language.fit(table(spark, folder, "documents"))
    found = pages.main_text(table(spark, folder, "pages"))
    host = F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1), F.lit(""))
    return language.identify(found.withColumn("host", host), model, "page_id", declared="declared", address="url", host="host")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.apply_rules(table(spark, folder, "documents"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(table(spark, folder, "conversations"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))


def op13_orc_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "tokens")
    orcfiles.write_tokens(table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"))
    return orcfiles.digests(orcfiles.read_tokens(spark, path))


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_toxicity": op2_toxicity,
        "op3_secrets": op3_secrets,
        "op4_fingerprints": op4_fingerprints,
        "op5_pages": op5_pages,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_bpe": op7_bpe,
        "op8_language": op8_language,
        "language_of_pages": language_of_pages,
        "op9_quality": op9_quality,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_conversations": op11_conversations,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_orc_tokens": op13_orc_tokens,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_near_duplicates": oracle.NEAR_DUPLICATES, "op9_quality": oracle.QUALITY}
