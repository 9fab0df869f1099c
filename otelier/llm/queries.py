"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from otelier.llm.bpe import encoding_digests
from otelier.llm import bit_sliced, conversations, decontaminate, graph_search, line_dedup, resampling
from otelier.llm.jaccard import similar_components
from otelier.llm.licenses import scan_licenses
from otelier.llm.packing import pack_documents
from otelier.llm.pii import anonymise, secret_key
from otelier.llm.quality import quality_scores
from otelier.llm.shipping import reachable
from otelier.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: plan(reachable(spark), sf)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return plan

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_line_dedup", line_dedup.ORACLE)
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("body")


@query("op4_graph_neighbours")
def op4_graph_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf, "embeddings"), k=20, every=20)


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_pii_surrogates")
def op6_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return anonymise(table(spark, sf, "documents").select("doc_id", "text"), secret_key(spark))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_bit_sliced_topk", bit_sliced.ORACLE)
def op8_bit_sliced_topk(spark: SparkSession, sf: str) -> DataFrame:
    return bit_sliced.top_inner_products(table(spark, sf, "embeddings"), k=5, every=50)


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_components(table(spark, sf, "documents"), size=4, percent=85)


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encoding_digests(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op11_decontamination", decontaminate.ORACLE)
def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    report, turns = conversations.repair_conversations(conversations.damaged(rows))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = ("audit", "repaired_sha256")
    parts = [df.select("conv_id", *[F.col(c) if c in df.columns else F.lit(None).cast("bigint" if c in numbers else "string").alias(c)
                                    for c in (*numbers, *texts)])
             for df in (rows.select("conv_id").distinct(), report, conversations.turn_digests(turns))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*numbers, *texts)])
    return whole.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_importance_resampling", resampling.ORACLE)
def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    ranks = resampling.importance_ranks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), longest=1, buckets=10_000, percent=10)
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")
