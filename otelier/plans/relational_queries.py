"""Queries with relational operators on flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from otelier.functions.expressions import column
from otelier.operators.metrics import metric_value
from otelier.operators.relational import (
    count_rows, dedup_rows, dedup_subset, distinct_values, filter_eq, filter_id, filter_in, filter_valid, group_sum,
    join_back, limit_rows, log_prepare, log_span_join, metric_prepare, project, register_views, sort_rows,
    span_prepare, union_values,
)
from otelier.operators.traces import basic_spans
from otelier.plans import fixtures
from otelier.plans.oracle import LOGS, POINTS, PROFILES, SPANS
from otelier.plans.registry import attribute, big, hexed, query

LOG_KEYS = {"attributes": ["event.type", "user.id", "k"], "resource_attributes": ["service.name"]}
METRIC_KEYS = {"attributes": ["event.type"], "resource_attributes": ["service.name"]}
SPAN_KEYS = {"attributes": ["http.method", "http.status_code", "rpc.method"], "resource_attributes": ["service.name"]}

# the trace the look-up queries show: the one of the second order and the second event
TRACE = f"{3:032x}"


@query("filter_valid", """
SELECT profile_id, role, value FROM profile_rows WHERE is_valid""", PROFILES)
def valid(spark, sf):
    role = F.get("attributes", F.lit(0))["value"]["string_value"].alias("role")
    return filter_valid(fixtures.profile_rows(spark, sf)).select(*hexed("profile_id"), role, "value")


@query("filter_eq", """
SELECT time_ns, severity_text, CAST(user_id AS VARCHAR) AS user_id FROM logs
WHERE severity_text = 'ERROR' AND service = 'shop-1'""", LOGS)
def eq(spark, sf):
    rows = fixtures.logs(spark, sf).select(
        F.col("time_unix_nano").alias("time_ns"), "severity_text", attribute("attributes", "user.id", "user_id"),
        attribute("resource_attributes", "service.name", "ra_service.name"))
    return filter_eq(rows, severity_text="ERROR", **{"ra_service.name": "shop-1"}).drop("ra_service.name")


@query("filter_in", """
SELECT name, event_type, time_ns, CAST(sum_int AS BIGINT) AS sum_int FROM points
WHERE name IN ('app.events', 'app.value.last')""", POINTS)
def isin(spark, sf):
    return filter_in(fixtures.metric_rows(spark, sf), "name", ["app.events", "app.value.last"]).select(
        "name", attribute("attributes", "event.type", "event_type"), F.col("time_unix_nano").alias("time_ns"), "sum_int")


@query("filter_id", f"""
SELECT span_id, name, kind FROM spans WHERE trace_id = '{TRACE}'""", SPANS)
def by_id(spark, sf):
    return filter_id(fixtures.spans(spark, sf), "trace_id", TRACE).select(*hexed("span_id"), "name", "kind")


@query("project", """
SELECT name, kind, start_ns AS start_time_unix_nano FROM spans""", SPANS)
def projection(spark, sf):
    return project(fixtures.spans(spark, sf), "name", "kind", "start_time_unix_nano")


@query("log_prepare", """
SELECT 'app' AS scope_name, '1.0' AS scope_version, time_ns AS time_unix_nano, time_ns + 1000 AS observed_time_unix_nano,
  severity_number, severity_text, trace_id, span_id, body_string AS body, event_type AS "a_event.type",
  CAST(user_id AS VARCHAR) AS "a_user.id", CAST(k AS VARCHAR) AS a_k, service AS "ra_service.name" FROM logs""", LOGS)
def prepared_logs(spark, sf):
    rows = log_prepare(fixtures.logs(spark, sf), LOG_KEYS)
    return rows.withColumns({
        "severity_number": big("severity_number"), "trace_id": hexed("trace_id")[0], "span_id": hexed("span_id")[0],
    }).drop("flags")


@query("metric_prepare", """
SELECT 'app' AS scope_name, name, type, CASE type WHEN 'GAUGE' THEN 'AS_DOUBLE' END AS gauge_type,
  gauge_double, CAST(sum_int AS BIGINT) AS sum_int,
  CASE type WHEN 'HISTOGRAM' THEN CAST(cnt AS BIGINT) END AS histogram_count,
  start_ns AS start_time_unix_nano, time_ns AS time_unix_nano, event_type AS "a_event.type",
  service AS "ra_service.name" FROM points""", POINTS)
def prepared_metrics(spark, sf):
    rows = metric_prepare(fixtures.metric_rows(spark, sf), METRIC_KEYS)
    return project(rows, "scope_name", "name", "type", "gauge_type", "gauge_double", "sum_int", "histogram_count",
                   "start_time_unix_nano", "time_unix_nano", "a_event.type", "ra_service.name")


@query("span_prepare", """
SELECT 'orders' AS scope_name, trace_id, span_id, parent_span_id, name, kind, start_ns AS start_time_unix_nano,
  end_ns AS end_time_unix_nano, code AS "status.code", '' AS "status.message",
  CAST(CASE WHEN line = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_events, CAST(0 AS BIGINT) AS n_links,
  old_method AS "a_http.method", CAST(http_status AS VARCHAR) AS "a_http.status_code", rpc_method AS "a_rpc.method",
  service AS "ra_service.name" FROM spans""", SPANS)
def prepared_spans(spark, sf):
    rows = span_prepare(fixtures.spans(spark, sf), SPAN_KEYS)
    return rows.select(
        "scope_name", *hexed("trace_id", "span_id", "parent_span_id"), "name", "kind", "start_time_unix_nano",
        "end_time_unix_nano", column("status.code"), column("status.message"),
        F.size("events").cast("bigint").alias("n_events"), F.size("links").cast("bigint").alias("n_links"),
        *[column(c) for c in ("a_http.method", "a_http.status_code", "a_rpc.method", "ra_service.name")])


@query("distinct_values", """
SELECT DISTINCT name, kind FROM spans""", SPANS)
def distinct(spark, sf):
    return distinct_values(fixtures.spans(spark, sf), "name", "kind")


@query("dedup_rows", """
SELECT time_ns, service, severity_text, body_string, body_int, user_id FROM logs""", LOGS)
def deduplicated(spark, sf):
    # the error logs arrive twice, in other packets the second time
    logs = fixtures.logs(spark, sf)
    again = filter_eq(logs, severity_text="ERROR").withColumn("batch_UUID", F.lit("retransmitted"))
    rows = dedup_rows(logs.unionByName(again), "logs")
    return rows.select(
        F.col("time_unix_nano").alias("time_ns"), attribute("resource_attributes", "service.name", "service"),
        "severity_text", "body_string", "body_int", attribute("attributes", "user.id", "user_id").cast("bigint"))


@query("dedup_subset", """
SELECT service, event_type, name, start_ns, time_ns, gauge_double, CAST(sum_int AS BIGINT) AS sum_int FROM points""",
       POINTS)
def deduplicated_metrics(spark, sf):
    # all points arrive again with larger sums: what counts is that all but the values is equal
    rows = metric_prepare(fixtures.metric_rows(spark, sf), METRIC_KEYS)
    again = rows.withColumn("sum_int", F.col("sum_int") + 1)
    return dedup_subset(rows.unionByName(again)).select(
        column("ra_service.name").alias("service"), column("a_event.type").alias("event_type"), "name",
        F.col("start_time_unix_nano").alias("start_ns"), F.col("time_unix_nano").alias("time_ns"), "gauge_double",
        "sum_int")


@query("sort_rows", """
SELECT name, start_ns, end_ns FROM spans ORDER BY name, start_ns, end_ns""", SPANS)
def ordered(spark, sf):
    rows = fixtures.spans(spark, sf).select("name", F.col("start_time_unix_nano").alias("start_ns"),
                                            F.col("end_time_unix_nano").alias("end_ns"))
    return sort_rows(rows, "name", "start_ns", "end_ns")


@query("limit_rows", """
SELECT time_ns, severity_text, body_string FROM logs WHERE severity_text = 'ERROR'
ORDER BY time_ns, event_id LIMIT 10""", LOGS)
def first_rows(spark, sf):
    rows = filter_eq(fixtures.logs(spark, sf), severity_text="ERROR").select(
        F.col("time_unix_nano").alias("time_ns"), "severity_text", "body_string")
    return limit_rows(rows, 10, "time_ns", "body_string")


@query("union_values", """
SELECT name, event_type, time_ns, gauge_double AS value FROM points WHERE type = 'GAUGE'
UNION ALL SELECT name, event_type, time_ns, CAST(sum_int AS DOUBLE) FROM points WHERE type = 'SUM'""", POINTS)
def stacked(spark, sf):
    rows = fixtures.metric_rows(spark, sf).select(
        "name", "type", attribute("attributes", "event.type", "event_type"), F.col("time_unix_nano").alias("time_ns"),
        "gauge_double", F.col("sum_int").cast("double").alias("sum_double"))
    gauges = rows.filter("type = 'GAUGE'").select("name", "event_type", "time_ns", F.col("gauge_double").alias("value"))
    sums = rows.filter("type = 'SUM'").select("name", "event_type", "time_ns", F.col("sum_double").alias("value"))
    return union_values(gauges, sums)


@query("join_back", """
SELECT batch, CAST(seq_no AS BIGINT) AS seq_no, point, name,
  CASE WHEN type = 'GAUGE' THEN gauge_double WHEN type = 'SUM' THEN CAST(sum_int AS DOUBLE) END AS value
FROM points""", POINTS)
def joined_back(spark, sf):
    rows = fixtures.metric_rows(spark, sf)
    joined = join_back(rows, metric_value(rows), "metrics", ["value"])
    return joined.select(F.col("batch_UUID").alias("batch"), big("seq_no"), big("datapoint_seq_no", "point"), "name",
                         "value")


@query("group_sum", """
SELECT service, name, CAST(sum(end_ns - start_ns) AS BIGINT) AS nanos FROM spans GROUP BY service, name""", SPANS)
def sums(spark, sf):
    rows = fixtures.spans(spark, sf).select(
        attribute("resource_attributes", "service.name", "service"), "name",
        (F.col("end_time_unix_nano") - F.col("start_time_unix_nano")).alias("nanos"))
    return group_sum(rows, ["service", "name"], "nanos")


@query("sql_views", """
SELECT service AS service_name, coalesce(old_method, new_method) AS http_method, count(*) AS n,
  count(*) FILTER (WHERE code = 'STATUS_CODE_ERROR') AS errors
FROM spans WHERE kind = 'SPAN_KIND_SERVER' GROUP BY 1, 2""", SPANS)
def views(spark, sf):
    spans = fixtures.spans(spark, sf)
    register_views(spark, {"otlp_spans": spans, "basic_spans": basic_spans(spans)})
    return spark.sql("""
        SELECT service_name, http_method, count(*) AS n, count_if(status_code = 'STATUS_CODE_ERROR') AS errors
        FROM basic_spans WHERE kind = 'SPAN_KIND_SERVER' GROUP BY service_name, http_method""")


@query("count_rows", """
SELECT service AS service_name, kind, code AS status_code, count(*) AS count FROM spans GROUP BY 1, 2, 3""", SPANS)
def counted(spark, sf):
    return count_rows(basic_spans(fixtures.spans(spark, sf)), "service_name", "kind", "status_code")


@query("log_span_join", """
SELECT l.trace_id, l.span_id, l.severity_text, l.body_string AS body, s.name, s.code
FROM logs l JOIN spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id WHERE l.span_id <> ''""", LOGS, SPANS)
def logs_in_spans(spark, sf):
    logs = fixtures.logs(spark, sf).select("trace_id", "span_id", "severity_text", F.col("body_string").alias("body"))
    spans = fixtures.spans(spark, sf).select("trace_id", "span_id", "name", "status.code")
    return log_span_join(logs, spans).select(*hexed("trace_id", "span_id"), "severity_text", "body", "name", "code")

