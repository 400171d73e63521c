"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before kept and returns the same columns; the last
returns the pieces of the training sequences. Documents without rejected, repeated or secret parts
come out of the first four stages as they went in. A document is told by its id and text, so repeated
rows are judged alike, and near-dedup keeps one of them. Null texts are empty texts. An empty table
stays empty, and columns beside those of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcohorts.llm import language, neardup, packing, queries, repeats, secrets
from tripcohorts.llm.common import text_of, written


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language no evidence makes clear."""
    told = F.struct("doc_id", F.xxhash64(text_of()).alias("tag")).alias("told")
    found = language.identify(
        docs.select(told, "text", "lang", "source"), language.fit(docs), "told", declared="lang", host="source"
    )
    rejected = found.filter(~F.col("kept")).select(F.col("told.doc_id").alias("told_id"), F.col("told.tag").alias("told_tag"))
    same = docs["doc_id"].eqNullSafe(rejected["told_id"]) & (F.xxhash64(text_of(docs["text"])) == rejected["told_tag"])
    return docs.join(rejected, same, "left_anti")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at 0.8 or more connect."""
    # a text without an id takes part under a number of its own, above all ids
    numbered = F.coalesce(docs["doc_id"].cast("long"), F.lit(2**62) + F.pmod(F.xxhash64(text_of(docs["text"])), F.lit(2**61)))
    dropped = neardup.near_duplicates(docs.select(numbered.alias("doc_id"), "text")).filter(~F.col("kept"))
    dropped = dropped.select(F.col("doc_id").alias("dropped_id")).distinct()
    kept = docs.join(dropped, numbered == dropped["dropped_id"], "left_anti")
    # rows that repeat an id and text; only these are gathered
    again = docs.groupBy(docs["doc_id"].alias("again_id")).agg(F.count("*").alias("again")).filter("again > 1")
    again = again.select("again_id")
    same = kept["doc_id"].eqNullSafe(again["again_id"])
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that occur elsewhere; documents with nothing else go."""
    names = docs.columns
    cut = repeats.remove_repeats(docs, texts=True)
    some = cut.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return some.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*names)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret masked."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    return packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language identification", in_known_languages),
    ("minhash near-dedup", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("secret scan", without_secrets),
    ("packing", packed),
]

#: Trained models and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
