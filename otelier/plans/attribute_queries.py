"""Queries on attributes and semi-structured values."""

from __future__ import annotations

from pyspark.sql import functions as F

from otelier.functions.anyvalue import any_value, attributes_json, last_value, native_text, resolve_attributes, to_map
from otelier.functions.expressions import column, compute_once
from otelier.operators.attributes import (
    attribute_keys, drop_empty_columns, drop_empty_rows, fill_blank, first_attribute, json_value, native_types,
    split_columns, to_json_map, to_number, widen, widen_all, with_attribute,
)
from otelier.operators.relational import group_sum
from otelier.plans import fixtures
from otelier.plans.oracle import LOGS, NESTED, POINTS, SPANS
from otelier.plans.registry import attribute, big, query


@query("attr_value", """
SELECT time_ns, service, event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS k,
  CAST(NULL AS VARCHAR) AS missing FROM logs""", LOGS)
def attr_value(spark, sf):
    return fixtures.logs(spark, sf).select(
        F.col("time_unix_nano").alias("time_ns"), attribute("resource_attributes", "service.name", "service"),
        *[any_value(last_value(F.col("attributes"), k)).alias(o) for k, o in
          (("event.type", "event_type"), ("user.id", "user_id"), ("k", "k"), ("no.such.key", "missing"))])


@query("attr_wide", """
SELECT time_ns, event_type AS "a_event.type", CAST(user_id AS VARCHAR) AS "a_user.id", CAST(k AS VARCHAR) AS a_k,
  service AS "ra_service.name" FROM logs""", LOGS)
def attr_wide(spark, sf):
    rows = fixtures.logs(spark, sf).select(
        F.col("time_unix_nano").alias("time_ns"), "attributes", "resource_attributes")
    return widen_all(rows, {"attributes": ["event.type", "user.id", "k"], "resource_attributes": ["service.name"]})


@query("attr_keys", """
SELECT DISTINCT 'spans' AS signal, key FROM (
  SELECT CASE WHEN old_method IS NOT NULL THEN 'http.method' ELSE 'http.request.method' END AS key FROM spans
    WHERE line = 0
  UNION ALL SELECT 'http.status_code' FROM spans WHERE line = 0
  UNION ALL SELECT unnest(['rpc.method', 'rpc.system']) FROM spans WHERE line > 0)
UNION ALL SELECT DISTINCT 'logs', unnest(['event.type', 'user.id', 'k']) FROM logs""", SPANS, LOGS)
def attr_keys(spark, sf):
    tables = {"spans": fixtures.spans(spark, sf), "logs": fixtures.logs(spark, sf)}
    found = [attribute_keys(df, "attributes").select(F.lit(s).alias("signal"), "key") for s, df in tables.items()]
    return found[0].unionByName(found[1])


@query("attr_map", """
SELECT CASE WHEN line > 0 THEN 'rpc.method=pick,rpc.system=grpc'
    WHEN old_method IS NOT NULL THEN 'http.method=POST,http.status_code=' || http_status
    ELSE 'http.request.method=POST,http.status_code=' || http_status END AS attributes, count(*) AS n
FROM spans GROUP BY 1""", SPANS)
def attr_map(spark, sf):
    entries = F.array_sort(F.map_entries(to_map(F.col("attributes"))))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return fixtures.spans(spark, sf).groupBy(text.alias("attributes")).agg(F.count(F.lit(1)).alias("n"))


@query("attr_map_nested", """
SELECT custkey, levels, v, '{"v":' || v || '}' AS json FROM nested""", NESTED)
def attr_map_nested(spark, sf):
    attributes = F.col("attributes")
    return fixtures.nested_attributes(spark, sf).select(
        big("c_custkey", "custkey"), big("levels"), to_map(attributes)["v"].alias("v"), attributes_json(attributes).alias("json"))


@query("attr_strindex_nested", """
SELECT custkey, levels, 'v' AS key, v FROM nested""", NESTED)
def attr_strindex_nested(spark, sf):
    """Indices at every level of a value, resolved and rendered."""
    resolved = fixtures.nested_attributes(spark, sf).select(
        "c_custkey", "levels", F.get(resolve_attributes(F.col("indexed"), F.col("strings")), F.lit(0)).alias("a"))
    return resolved.select(big("c_custkey", "custkey"), big("levels"), "a.key", native_text(F.col("a.value")).alias("v"))


@query("row_json", """
SELECT CAST(time_ns AS VARCHAR) AS time, CAST(severity_number AS VARCHAR) AS severity, event_type, service,
  CAST(k AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS flags, body_string AS body,
  CASE WHEN trace_id <> '' THEN CAST(len(trace_id) // 2 AS BIGINT) END AS id_bytes,
  '0' AS default_flags, '0.0' AS default_double, 'true' AS is_valid
FROM logs""", LOGS)
def row_json(spark, sf):
    logs = fixtures.logs(spark, sf)
    short = ("time_unix_nano STRING, severity_number STRING, attributes MAP<STRING, STRING>, "
             "resource_attributes MAP<STRING, STRING>, flags STRING, body_string STRING, trace_id BINARY")
    filled = "flags STRING, body_double STRING, is_valid STRING"
    rows = compute_once(logs, [], F.struct(
        F.from_json(to_json_map(logs, "logs"), short).alias("j"),
        F.from_json(to_json_map(logs, "logs", with_defaults=True), filled).alias("d")), "_row").select("_row.*")
    return rows.select(
        F.col("j.time_unix_nano").alias("time"), F.col("j.severity_number").alias("severity"),
        F.col("j.attributes")["event.type"].alias("event_type"),
        F.col("j.resource_attributes")["service.name"].alias("service"), F.col("j.attributes")["k"].alias("k"),
        F.col("j.flags").alias("flags"), F.col("j.body_string").alias("body"),
        F.length("j.trace_id").cast("bigint").alias("id_bytes"),
        F.col("d.flags").alias("default_flags"), F.col("d.body_double").alias("default_double"),
        F.col("d.is_valid").alias("is_valid"))


@query("dims_measures", """
SELECT name, type, CAST(round(sum(gauge_double) * 100) AS BIGINT) AS gauge_cents, CAST(sum(sum_int) AS BIGINT) AS sum_int,
  CAST(sum(CASE type WHEN 'HISTOGRAM' THEN cnt END) AS BIGINT) AS histogram_count,
  CAST(sum(CASE type WHEN 'SUMMARY' THEN total END) AS DOUBLE) AS summary_sum,
  CAST(16 AS BIGINT) AS measures FROM points GROUP BY name, type""", POINTS)
def dims_measures(spark, sf):
    dims, measures = split_columns("metrics", ("name", "type"), exclusions=("exponential_histogram_scale",))
    sums = group_sum(fixtures.metric_rows(spark, sf), dims, *measures)
    return sums.select(
        *dims, F.round(F.col("gauge_double") * 100).cast("bigint").alias("gauge_cents"), "sum_int", "histogram_count",
        "summary_sum", F.lit(len(measures)).cast("bigint").alias("measures"))


@query("json_path", """
SELECT old_method AS method, CAST(http_status AS VARCHAR) AS status, count(*) AS n FROM spans GROUP BY 1, 2""", SPANS)
def json_path(spark, sf):
    text = fixtures.spans(spark, sf).select(attributes_json(F.col("attributes")).alias("t"))
    return text.groupBy(json_value(F.col("t"), "http.method").alias("method"),
                        json_value(F.col("t"), "http.status_code").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("semconv_coalesce", """
SELECT coalesce(old_method, new_method) AS method, rpc_method, count(*) AS n FROM spans GROUP BY 1, 2""", SPANS)
def semconv_coalesce(spark, sf):
    attributes = F.col("attributes")
    return fixtures.spans(spark, sf).groupBy(
        first_attribute(attributes, "http.method", "http.request.method").alias("method"),
        first_attribute(attributes, "rpc.method", "grpc.method").alias("rpc_method"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("not_null_attr", """
SELECT trace_id, span_id, name, rpc_method AS "a_rpc.method" FROM spans WHERE rpc_method IS NOT NULL""", SPANS)
def not_null_attr(spark, sf):
    rows = fixtures.spans(spark, sf).select(
        *[F.lower(F.hex(c)).alias(c) for c in ("trace_id", "span_id")], "name", "attributes")
    return with_attribute(widen(rows, "attributes", keys=["rpc.method"]), "a_rpc.method").drop("attributes")


@query("drop_empty_columns", """
SELECT time_ns, CAST(k AS VARCHAR) AS a_k, event_type AS "a_event.type" FROM logs""", LOGS)
def empty_columns(spark, sf):
    rows = fixtures.logs(spark, sf).select(F.col("time_unix_nano").alias("time_ns"), "body_double", "attributes")
    return drop_empty_columns(widen(rows, "attributes", keys=["k", "no.such.key", "event.type"]).drop("attributes"))


@query("drop_empty_rows", """
SELECT old_method AS "a_http.method", CAST(http_status AS VARCHAR) AS "a_http.status_code" FROM spans
WHERE old_method IS NOT NULL OR http_status IS NOT NULL""", SPANS)
def empty_rows(spark, sf):
    rows = widen(fixtures.spans(spark, sf).select("attributes"), "attributes", keys=["http.method", "http.status_code"])
    return drop_empty_rows(rows.drop("attributes"))


@query("fill_blank", """
SELECT time_ns, body_type, coalesce(body_string, '') AS body_string, body_int FROM logs""", LOGS)
def blank(spark, sf):
    return fill_blank(fixtures.logs(spark, sf).select(
        F.col("time_unix_nano").alias("time_ns"), "body_type", "body_string", "body_int"))


@query("to_number", """
SELECT time_ns, CAST(k AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM logs""", LOGS)
def numbers(spark, sf):
    rows = fixtures.logs(spark, sf).select(F.col("time_unix_nano").alias("time_ns"), "attributes")
    wide = widen(rows, "attributes", keys=["k", "event.type"])
    return wide.select("time_ns", to_number(column("a_k")).alias("k"), to_number(column("a_event.type")).alias("bad"))


@query("native_types", """
SELECT CAST(time_ns AS VARCHAR) AS time_ns, k AS a_k, user_id AS "a_user.id" FROM logs""", LOGS)
def natives(spark, sf):
    rows = fixtures.logs(spark, sf).select(F.col("time_unix_nano").alias("time_ns"), "attributes")
    wide = widen(rows, "attributes", keys=["k", "user.id"]).drop("attributes")
    return native_types(wide, {"time_ns": "string", "a_k": "bigint", "a_user.id": "bigint"})
