"""Rows of vectors that take part in a search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def usable_vectors(df: DataFrame, key: str, vector: str, nonzero: bool = False) -> DataFrame:
    """(id, v, dim, row) of the rows with a key and a vector of finite components; with `nonzero` not all of them 0. Exact
    repeats count once; rows that share a key but not the vector are rows of their own, told apart by `row` once staged."""
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite)
    if nonzero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    return rows.distinct().select("id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row"))


def best_per_query(found: DataFrame, k: int) -> DataFrame:
    """The k rows of highest score per query (query_id and its row), ties to the smaller vec_id, with their rank from 1."""
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
