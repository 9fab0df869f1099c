"""Faults of registered queries that only larger tables show, on tables made for each."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from otelier.plans import io_queries


def test_sums_of_pairs_may_exceed_bigint(spark, tmp_path):
    """600,000 orders with the largest factors there are: the sum of products has no BIGINT, all else has."""
    n, key = 600_000, F.col("id") * (1 << 20) + (1 << 20) - 2
    spark.range(n).select(
        key.alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"), F.timestamp_seconds(F.lit(1000)).alias("o_orderdate"),
        F.lit(1.0).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(n).select(key.alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_linenumber"), F.lit(1.0).alias("l_quantity")).write.parquet(
        str(tmp_path / "lineitem.parquet"))
    df = entry.queries()["span_parent"](spark, str(tmp_path))
    assert dict(df.dtypes)["pairs"] == "bigint"
    assert sorted(tuple(r) for r in df.select("name", "parent_name", "n", "ids", "pairs").collect()) == [
        ("line_1", "place_order", n, n * 0xFFFFF1, None), ("place_order", None, n, n * 0xFFFFF0, None)]


def test_lines_come_twice_in_each_of_several_files(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(io_queries, "LINES_PER_FILE", 100)
    monkeypatch.setattr(io_queries, "scratch_path", lambda _, purpose: str(tmp_path / purpose))
    row = entry.queries()["stream_lineage"](spark, sf).first()
    assert row["packets"] == row["same_ids"] > 100
    per_line = spark.read.text(str(tmp_path / "twice")).groupBy(F.col("_metadata.file_path").alias("file"), "value").count()
    assert per_line.select("file").distinct().count() > 1 and per_line.filter("count <> 2").isEmpty()


def test_batches_may_hold_several_files(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(io_queries, "scratch_path", lambda _, purpose: str(tmp_path / purpose))
    assert entry.queries()["stream_counters"](spark, sf).first()["batches"] == 3
    assert len(list((tmp_path / "packets-profiles").glob("part-*"))) > 3
