"""The corpus pipeline: documents to token ids in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet in the shared folder and read again as the next stage's documents, so a
lost executor never costs more than the stage at hand.  All stages but the last
keep the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import byte_bpe, decontaminate, jaccard_join, quality_rules, suffix_dedup
from tokenloom.llm.common import new_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rejected ones go."""
    judged = quality_rules.judged(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    # a filter is never pushed below a row number: without it the rules would be evaluated again for the filter
    numbered = judged.select("*", F.monotonically_increasing_id().alias("number"))
    return numbered.where(F.col("result.kept") & (F.col("number") >= 0)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates (equal rows: one; without an id: all).

    Ids may repeat with different texts, so a document is its id and its text's hash.
    """
    hash_ = "__hash" + "_" * max(map(len, docs.columns))  # no column of the documents has this name
    found = jaccard_join.grouped(docs.select("doc_id", "text")).withColumnRenamed("hash", hash_)
    key = ["doc_id", hash_]
    gone = found.where((F.col("doc_id") != F.col("group_id")) | (F.col(hash_) != F.col("group_hash"))).select(*key).distinct()
    kept = docs.where("doc_id is not null").withColumn(hash_, jaccard_join.text_hash(F.col("text"))).join(gone, key, "left_anti")
    kept, id_less = kept.select(*docs.columns, hash_), docs.where("doc_id is null")
    twice = kept.groupBy(*key).count().where("count > 1").select(*key)
    if twice.isEmpty():
        return kept.drop(hash_).unionByName(id_less)
    again = kept.join(twice, key, "left_semi").dropDuplicates(key)
    return kept.join(twice, key, "left_anti").unionByName(again).drop(hash_).unionByName(id_less)


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes of strings that repeat."""
    return _with_length(suffix_dedup.suffix_dedup(docs, clean=True))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the words of benchmark phrases."""
    return _with_length(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), clean=True))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("byte-level BPE", token_ids),
]

#: Hashing, suffix sorting and byte-pair merging have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
