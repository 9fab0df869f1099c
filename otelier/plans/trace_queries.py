"""Queries on traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from otelier.functions.expressions import column, nanos_to_millis_timestamp
from otelier.operators.relational import log_prepare, span_prepare
from otelier.operators.traces import (
    basic_spans, span_duration, span_events, span_parent, span_status, trace_logs, trace_view,
)
from otelier.plans import fixtures
from otelier.plans.oracle import LOGS, SPANS, micros_text, millis_text
from otelier.plans.registry import attribute, hexed, query
from otelier.plans.relational_queries import LOG_KEYS, SPAN_KEYS, TRACE

_NO_TEXT = "CAST(NULL AS VARCHAR)"


@query("basic_spans", f"""
SELECT {micros_text('start_ns')} AS event_time, {millis_text('end_ns')} AS end_time, 'orders' AS scope_name,
  '1.0' AS scope_version, kind, name, trace_id, span_id, parent_span_id,
  {', '.join(f'{_NO_TEXT} AS {c}' for c in ('telemetry_name', 'telemetry_language', 'telemetry_version',
                                            'runtime_description', 'runtime_name', 'runtime_version'))},
  service AS service_name, coalesce(old_method, new_method) AS http_method, {_NO_TEXT} AS http_scheme,
  {_NO_TEXT} AS http_version, CAST(http_status AS VARCHAR) AS http_status_code, {_NO_TEXT} AS http_url, rpc_method,
  {_NO_TEXT} AS rpc_service, rpc_system, {_NO_TEXT} AS rpc_status_code, code AS status_code, '' AS status_message,
  CASE WHEN line > 0 THEN '{{"rpc.method":"pick","rpc.system":"grpc"}}'
    WHEN old_method IS NOT NULL THEN '{{"http.method":"POST","http.status_code":' || http_status || '}}'
    ELSE '{{"http.request.method":"POST","http.status_code":' || http_status || '}}' END AS attributes
FROM spans""", SPANS)
def span_view(spark, sf):
    return basic_spans(fixtures.spans(spark, sf)).withColumns({
        "event_time": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "end_time": F.date_format("end_time", "yyyy-MM-dd HH:mm:ss.SSS")})


@query("end_time_ms", f"""
SELECT name, {millis_text('end_ns')} AS end_time, count(*) AS n FROM spans GROUP BY 1, 2""", SPANS)
def end_time(spark, sf):
    text = F.date_format(nanos_to_millis_timestamp("end_time_unix_nano"), "yyyy-MM-dd HH:mm:ss.SSS")
    return fixtures.spans(spark, sf).groupBy("name", text.alias("end_time")).agg(F.count(F.lit(1)).alias("n"))


@query("trace_logs", f"""
SELECT service AS "ra_service.name", time_ns + 1000 AS observed_time_unix_nano, severity_text, body_string AS body,
  CAST(user_id AS VARCHAR) AS "a_user.id", trace_id, span_id FROM logs WHERE trace_id = '{TRACE}'""", LOGS)
def logs_of_trace(spark, sf):
    rows = trace_logs(log_prepare(fixtures.logs(spark, sf), LOG_KEYS), TRACE, [
        "ra_service.name", "observed_time_unix_nano", "severity_text", "body", "a_user.id", "trace_id", "span_id"])
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("trace_id", "span_id")})


@query("trace_view", f"""
SELECT service AS "ra_service.name", name, span_id, parent_span_id, kind, code AS "status.code",
  start_ns AS start_time_unix_nano, end_ns AS end_time_unix_nano, old_method AS "a_http.method",
  rpc_method AS "a_rpc.method" FROM spans WHERE trace_id = '{TRACE}' ORDER BY start_ns""", SPANS)
def spans_of_trace(spark, sf):
    rows = trace_view(span_prepare(fixtures.spans(spark, sf), SPAN_KEYS), TRACE, [
        "ra_service.name", "name", "span_id", "parent_span_id", "kind", "status.code", "start_time_unix_nano",
        "end_time_unix_nano", "a_http.method", "a_rpc.method"])
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("span_id", "parent_span_id")})


@query("span_parent", """
SELECT c.name, p.name AS parent_name, count(*) AS n, CAST(sum(c.low) AS BIGINT) AS ids,
  CAST(sum(c.low * (p.start_ns // 1000000 % 1000003)) AS BIGINT) AS pairs
FROM (SELECT *, ('0x' || right(span_id, 6))::BIGINT AS low FROM spans) c
LEFT JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id GROUP BY 1, 2""", SPANS)
def parents(spark, sf):
    """Spans per name and parent's name, with sums over the ids and over ids times parents' times. Sums of products are exact;
    one that BIGINT, their type, can't hold is null."""
    spans = fixtures.spans(spark, sf).select("trace_id", "span_id", "parent_span_id", "name", "start_time_unix_nano")
    low = F.conv(F.right(F.hex("span_id"), F.lit(6)), 16, 10).cast("bigint")
    started = F.expr("parent_start_time_unix_nano div 1000000 % 1000003")
    return span_parent(spans, ["name", "start_time_unix_nano"]).groupBy("name", "parent_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(low).alias("ids"), F.sum((low * started).cast("decimal(20,0)")).try_cast("bigint").alias("pairs"))


@query("span_status", """
SELECT code AS "status.code", '' AS "status.message", name, count(*) AS n FROM spans GROUP BY code, name""", SPANS)
def statuses(spark, sf):
    rows = span_status(fixtures.spans(spark, sf).select("status", "name"))
    return rows.groupBy(column("status.code"), column("status.message"), "name").agg(F.count(F.lit(1)).alias("n"))


@query("span_events", """
SELECT trace_id, span_id, start_ns AS event_time_unix_nano, priority AS event_name,
  CAST(0 AS BIGINT) AS event_dropped FROM spans WHERE line = 0""", SPANS)
def events(spark, sf):
    rows = span_events(fixtures.spans(spark, sf), ["trace_id", "span_id"])
    return rows.select(*hexed("trace_id", "span_id"), "event_time_unix_nano", "event_name",
                       F.col("event_dropped_attributes_count").cast("bigint").alias("event_dropped"))


@query("span_duration", """
SELECT service, name, count(*) AS spans, CAST(sum(end_ns - start_ns) AS BIGINT) AS sum_nanos,
  min(end_ns - start_ns) AS min_nanos, max(end_ns - start_ns) AS max_nanos FROM spans GROUP BY service, name""", SPANS)
def durations(spark, sf):
    spans = fixtures.spans(spark, sf).withColumn("service", attribute("resource_attributes", "service.name", "s"))
    return span_duration(spans, "service", "name")
