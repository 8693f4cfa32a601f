"""From raw documents to token ids: quality rules, near-duplicate removal,
secret redaction, source mixing and BPE encoding.

Each stage takes what its predecessor kept, written as Parquet in the shared
folder and read again, and returns the columns of ``documents``; the last one
returns the ids.

* quality: documents that the quality rules reject go.
* deduplicate: of each group of near copies (word 5-grams, similarity 0.8 or
  more) the document with the smallest id stays.
* secrets: every secret in a text is replaced by a mark; ``n_chars`` follows.
* mix: the documents in the order of the mixture, those of sources below
  their target weight more than once.
* encode: the ids of every text and the digest of the text decoded from them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, jaccard, mixing, quality, secrets
from tessera.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.judge(docs).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs.withColumn("__t_old", F.char_length("text")))
    moved = F.char_length("text") - F.col("__t_old")
    return clean.withColumn("n_chars", F.when(moved == 0, F.col("n_chars")).otherwise(
        F.char_length("text").cast("long"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(docs))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality_rules), ("deduplicate", deduplicate), ("secrets", redact), ("mix", mix), ("encode", encode)]

#: BPE cannot be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
