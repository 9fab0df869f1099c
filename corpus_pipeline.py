"""Documents to packed training sequences, stage by stage. Every stage reads what its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from otelier.llm.jaccard import similar_components
from otelier.llm.line_dedup import dedup_lines
from otelier.llm.packing import pack_documents
from otelier.llm.pii import anonymise, secret_key
from otelier.llm.quality import keep_good, quality_scores
from otelier.llm.shipping import reachable
from otelier.llm.staging import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scores = quality_scores(docs, reachable(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, scores)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return dedup_lines(docs).select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar documents the one with the smallest id stays, once; texts that share an id are documents of their own,
    told apart by 64 bits. Rows without an id stay."""
    reachable(spark)
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("body"))
    groups = similar_components(named.select("body", "text"), size=5, percent=80, key="body").select("body", "component_id").distinct()
    members = staged(named.select("doc_id", "body").distinct().join(groups, "body"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "body")).alias("first")).select("first.*")
    # ids and bodies are no hot keys, however large a group is
    copies = members.select("doc_id", "body").join(first, ["doc_id", "body"], "left_anti")
    kept = docs.withColumn("body", F.xxhash64("doc_id", "text")).join(copies, ["doc_id", "body"], "left_anti").drop("body").select(docs.columns)
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("n_chars")
    kept = kept.withColumn("__n", F.row_number().over(same))
    return kept.where("__n = 1 OR doc_id IS NULL").drop("__n")


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates."""
    return anonymise(docs, secret_key(reachable(spark))).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    reachable(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", unique_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("PII", private_documents),
    ("packing", packed_sequences),
]

#: Tokenizing and packing cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; the tables between them go to the shared checkpoint folder."""
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
