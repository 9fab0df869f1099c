"""Queries on profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from otelier.functions.expressions import column
from otelier.operators.profiles import prof_filter, prof_frames, prof_full, prof_prepare
from otelier.plans import fixtures
from otelier.plans.oracle import FRAMES, PROFILES
from otelier.plans.registry import big, hexed, query

PROFILE_ID = f"{1:032x}"
PROFILE_KEYS = {"attributes": ["role"], "resource_attributes": ["host.name"]}


@query("prof_prepare", """
SELECT profile_id, start_ns AS start_time_unix_nano, start_ns + 1000000000 AS end_time_unix_nano,
  'turn' AS "period_type.type", 'count' AS "period_type.unit", 'chars' AS "type.type", 'count' AS "type.unit",
  ts_ns AS timestamp_unix_nano, profile_id AS trace_id, link_span AS span_id, value, CAST(64 AS BIGINT) AS id_digits
FROM profile_rows WHERE is_valid""", PROFILES)
def prepared(spark, sf):
    rows = prof_prepare(fixtures.profile_rows(spark, sf))
    return rows.select(
        *hexed("profile_id", "trace_id", "span_id"), "start_time_unix_nano", "end_time_unix_nano",
        *[column(c) for c in ("period_type.type", "period_type.unit", "type.type", "type.unit")],
        "timestamp_unix_nano", "value", F.length("stacktrace_id").cast("bigint").alias("id_digits"))


@query("prof_filter", f"""
SELECT profile_id, ts_ns AS timestamp_unix_nano, value, count(*) OVER (PARTITION BY words) AS same_stack
FROM profile_rows WHERE is_valid AND profile_id = '{PROFILE_ID}'""", PROFILES)
def one_profile(spark, sf):
    rows = prof_filter(prof_prepare(fixtures.profile_rows(spark, sf)), profile_id=PROFILE_ID)
    # equal stacks share an id: values per stack of this profile
    per_stack = rows.groupBy("stacktrace_id").agg(F.count(F.lit(1)).alias("same_stack"))
    return rows.join(per_stack, "stacktrace_id").select(*hexed("profile_id"), "timestamp_unix_nano", "value", "same_stack")


@query("prof_frames", """
SELECT profile_id, sample AS sample_seq_no, CAST(value_no AS BIGINT) AS value_seq_no, pos * 16 AS address,
  word AS function_name, role AS filename, pos AS line, 'conversation' AS mapping, CAST(4096 AS BIGINT) AS memory_limit,
  batch FROM frames""", FRAMES)
def frames(spark, sf):
    keep = ["batch_UUID", "profile_id", "sample_seq_no", "value_seq_no"]
    return prof_frames(fixtures.profile_rows(spark, sf), keep).select(
        *hexed("profile_id"), F.col("batch_UUID").alias("batch"), big("sample_seq_no"), big("value_seq_no"),
        column("location.address").alias("address"), column("location.line_0.function.name").alias("function_name"),
        column("location.line_0.function.filename").alias("filename"), column("location.line_0.line").alias("line"),
        column("location.map.filename").alias("mapping"), column("location.map.memory_limit").alias("memory_limit"))


@query("prof_depth", """
SELECT word AS function_name, CAST(len(words) AS BIGINT) AS stacktrace_len, CAST(len(words) AS BIGINT) - 1 AS max_depth,
  CAST(len(words) AS BIGINT) - pos - 1 AS depth, count(*) AS n FROM frames GROUP BY 1, 2, 3, 4""", FRAMES)
def depths(spark, sf):
    rows = prof_frames(fixtures.profile_rows(spark, sf), [])
    return rows.groupBy(
        column("location.line_0.function.name").alias("function_name"), big("stacktrace_len"),
        big("stacktrace_max_depth", "max_depth"), big("stacktrace_depth", "depth")).agg(F.count(F.lit(1)).alias("n"))


@query("prof_full", """
SELECT profile_id, value, ts_ns AS timestamp_unix_nano, word AS function_name, pos * 16 AS address,
  CAST(len(words) AS BIGINT) - pos - 1 AS depth, role AS a_role, host AS "ra_host.name" FROM frames WHERE is_valid""",
       FRAMES)
def everything(spark, sf):
    rows = prof_full(fixtures.profile_rows(spark, sf), PROFILE_KEYS)
    return rows.select(
        *hexed("profile_id"), "value", "timestamp_unix_nano",
        column("location.line_0.function.name").alias("function_name"), column("location.address").alias("address"),
        big("stacktrace_depth", "depth"), "a_role", column("ra_host.name"))
