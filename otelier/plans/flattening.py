"""Queries for packets to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from otelier.functions.anyvalue import any_value
from otelier.functions.expressions import hex_id
from otelier.operators.flatten import flatten_logs, flatten_spans, untyped_metrics
from otelier.operators.packets import deflatten, ingest_counters, packet_outcome
from otelier.operators.profiles_flatten import BAD_VALUES, flatten_profiles
from otelier.plans import fixtures
from otelier.plans.oracle import FRAMES, HOURS, LOGS, POINTS, PROFILES, SPANS
from otelier.plans.registry import attribute, big, hexed, query
from otelier.sources.flat import FLATTEN


@query("flat_logs", """
SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY event_id) - 1 AS seq_no, service, time_ns,
  time_ns + 1000 AS observed_ns, severity_number, severity_text, trace_id, span_id, event_type
FROM logs""", LOGS)
def flat_logs(spark, sf):
    rows = flatten_logs(fixtures.log_packets(spark, sf))
    return rows.select(
        F.col("batch_UUID").alias("batch"), big("seq_no"), attribute("resource_attributes", "service.name", "service"),
        F.col("time_unix_nano").alias("time_ns"), F.col("observed_time_unix_nano").alias("observed_ns"),
        big("severity_number"), "severity_text", *hexed("trace_id", "span_id"),
        attribute("attributes", "event.type", "event_type"))


@query("flat_spans", """
SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY okey, line) - 1 AS seq_no, service, trace_id, span_id,
  parent_span_id, name, kind, start_ns, end_ns, code FROM spans""", SPANS)
def flat_spans(spark, sf):
    rows = flatten_spans(fixtures.span_packets(spark, sf))
    return rows.select(
        F.col("batch_UUID").alias("batch"), big("seq_no"), attribute("resource_attributes", "service.name", "service"),
        *hexed("trace_id", "span_id", "parent_span_id"), "name", "kind",
        F.col("start_time_unix_nano").alias("start_ns"), F.col("end_time_unix_nano").alias("end_ns"), "status.code")


@query("flat_metrics", """
SELECT batch, CAST(seq_no AS BIGINT) AS seq_no, point, name, type, event_type, start_ns, time_ns, gauge_double,
  CAST(sum_int AS BIGINT) AS sum_int,
  CASE type WHEN 'HISTOGRAM' THEN CAST(cnt AS BIGINT) END AS histogram_count,
  CASE type WHEN 'HISTOGRAM' THEN CAST(total AS DOUBLE) END AS histogram_sum,
  CASE type WHEN 'EXPONENTIAL_HISTOGRAM' THEN CAST(cnt AS BIGINT) END AS exponential_histogram_count,
  CASE type WHEN 'EXPONENTIAL_HISTOGRAM' THEN CAST(hi AS DOUBLE) END AS exponential_histogram_max,
  CASE type WHEN 'SUMMARY' THEN CAST(cnt AS BIGINT) END AS summary_count,
  CASE type WHEN 'SUMMARY' THEN CAST(total AS DOUBLE) END AS summary_sum
FROM points""", POINTS)
def flat_metrics(spark, sf):
    rows = fixtures.metric_rows(spark, sf)
    return rows.select(
        F.col("batch_UUID").alias("batch"), big("seq_no"), big("datapoint_seq_no", "point"), "name", "type",
        attribute("attributes", "event.type", "event_type"), F.col("start_time_unix_nano").alias("start_ns"),
        F.col("time_unix_nano").alias("time_ns"), "gauge_double", "sum_int", "histogram_count", "histogram_sum",
        "exponential_histogram_count", "exponential_histogram_max", "summary_count", "summary_sum")


@query("flat_metrics_untyped", """
SELECT service, 'app.untyped' AS name, count(DISTINCT d) AS skipped FROM hours GROUP BY service""", HOURS)
def flat_metrics_untyped(spark, sf):
    skipped = untyped_metrics(fixtures.metric_packets(spark, sf))
    return skipped.groupBy(attribute("resource_attributes", "service.name", "service"), "name").agg(
        F.count(F.lit(1)).alias("skipped"))


@query("flat_profiles", """
SELECT batch, CAST(1 AS BIGINT) AS resource_seq_no, CAST(0 AS BIGINT) AS scope_seq_no,
  CAST(0 AS BIGINT) AS profile_seq_no, sample AS sample_seq_no, CAST(value_no AS BIGINT) AS value_seq_no,
  profile_id, start_ns, CAST(len(words) AS BIGINT) AS depth FROM profile_rows""", PROFILES)
def flat_profiles(spark, sf):
    return fixtures.profile_rows(spark, sf).select(
        F.col("batch_UUID").alias("batch"),
        *[big(c) for c in ("resource_seq_no", "scope_seq_no", "profile_seq_no", "sample_seq_no", "value_seq_no")],
        *hexed("profile_id"), F.col("time_unix_nano").alias("start_ns"), F.size("stack").cast("bigint").alias("depth"))


@query("flat_sample_values", f"""
SELECT batch, sample AS sample_seq_no, CAST(value_no AS BIGINT) AS value_seq_no, value, ts_ns, is_valid,
  CASE WHEN NOT is_valid THEN '{BAD_VALUES}' END AS error_message FROM profile_rows""", PROFILES)
def flat_sample_values(spark, sf):
    return fixtures.profile_rows(spark, sf).select(
        F.col("batch_UUID").alias("batch"), big("sample_seq_no"), big("value_seq_no"), "value",
        F.col("timestamp_unix_nano").alias("ts_ns"), "is_valid", "error_message")


@query("prof_dictionary", """
SELECT word AS function_name, role AS filename, count(*) AS frames, CAST(sum(pos * 16) AS BIGINT) AS addresses,
  CAST(sum(pos) AS BIGINT) AS lines, 'conversation' AS mapping, 'chars' AS sample_type, 'turn' AS period_type
FROM frames GROUP BY word, role""", FRAMES)
def prof_dictionary(spark, sf):
    frames = fixtures.profile_rows(spark, sf).select("sample_type", "period_type", F.explode("stack").alias("at"))
    line = F.get("at.lines", F.lit(0))
    return frames.groupBy(
        line["function"]["name"].alias("function_name"), line["function"]["filename"].alias("filename"),
        F.col("at.mapping.filename").alias("mapping"), F.col("sample_type.type").alias("sample_type"),
        F.col("period_type.type").alias("period_type"),
    ).agg(F.count(F.lit(1)).alias("frames"), F.sum("at.address").alias("addresses"), F.sum(line["line"]).alias("lines"))


@query("prof_link", """
SELECT profile_id AS trace_id, link_span AS span_id, count(*) AS n FROM profile_rows GROUP BY 1, 2""", PROFILES)
def prof_link(spark, sf):
    return fixtures.profile_rows(spark, sf).groupBy(*hexed("trace_id", "span_id")).agg(F.count(F.lit(1)).alias("n"))


@query("attr_strindex", """
SELECT host, role, 'count' AS unit, count(*) AS n FROM profile_rows GROUP BY host, role""", PROFILES)
def attr_strindex(spark, sf):
    role = F.get("attributes", F.lit(0))
    return fixtures.profile_rows(spark, sf).groupBy(
        attribute("resource_attributes", "host.name", "host"), any_value(role["value"]).alias("role"),
        role["unit"].alias("unit")).agg(F.count(F.lit(1)).alias("n"))


@query("log_body", """
SELECT time_ns, service, body_type, body_string, body_int, CAST(NULL AS DOUBLE) AS body_double FROM logs""", LOGS)
def log_body(spark, sf):
    rows = flatten_logs(fixtures.log_packets(spark, sf))
    return rows.select(
        F.col("time_unix_nano").alias("time_ns"), attribute("resource_attributes", "service.name", "service"),
        "body_type", "body_string", "body_int", "body_double")


@query("metric_columns", """
SELECT name, type, CASE type WHEN 'GAUGE' THEN 'AS_DOUBLE' END AS gauge_type,
  CASE type WHEN 'SUM' THEN 'AS_INT' END AS sum_type,
  CASE WHEN type IN ('SUM', 'HISTOGRAM') THEN 'AGGREGATION_TEMPORALITY_CUMULATIVE'
    WHEN type = 'EXPONENTIAL_HISTOGRAM' THEN 'AGGREGATION_TEMPORALITY_DELTA' END AS aggregation_temporality,
  CASE WHEN type = 'SUM' THEN true END AS is_monotonic, count(*) AS points,
  CAST(CASE type WHEN 'GAUGE' THEN 0 END AS BIGINT) AS gauge_ints, CAST(sum(sum_int) AS BIGINT) AS sums,
  CASE type WHEN 'HISTOGRAM' THEN CAST(sum(total) AS DOUBLE) END AS histogram_sums
FROM points GROUP BY name, type""", POINTS)
def metric_columns(spark, sf):
    rows = fixtures.metric_rows(spark, sf)
    return rows.groupBy("name", "type", "gauge_type", "sum_type", "aggregation_temporality", "is_monotonic").agg(
        F.count(F.lit(1)).alias("points"), F.sum("gauge_int").alias("gauge_ints"), F.sum("sum_int").alias("sums"),
        F.sum("histogram_sum").alias("histogram_sums"))


@query("resource_defaults", """
SELECT service, 'prod=1' AS env, '' AS blank, CAST(NULL AS VARCHAR) AS bare, CAST(4 AS BIGINT) AS n_attributes,
  count(*) AS n FROM logs GROUP BY service""", LOGS)
def resource_defaults(spark, sf):
    rows = flatten_logs(fixtures.log_packets(spark, sf), "service.name=none,env=prod=1,blank=,bare, ,=x")
    return rows.groupBy(
        *[attribute("resource_attributes", k, o) for k, o in
          (("service.name", "service"), ("env", "env"), ("blank", "blank"), ("bare", "bare"))],
        F.size("resource_attributes").cast("bigint").alias("n_attributes")).agg(F.count(F.lit(1)).alias("n"))


@query("packet_lineage", """
SELECT count(DISTINCT batch) AS packets, count(*) AS n, CAST(1 AS BIGINT) AS arrivals FROM logs""", LOGS)
def packet_lineage(spark, sf):
    # without an id of their own packets get a hash of their content
    rows = flatten_logs(fixtures.log_packets(spark, sf).drop("batch_UUID"))
    per_packet = rows.groupBy("batch_UUID").agg(
        F.count(F.lit(1)).alias("n"), F.min("batch_timestamp").alias("a"), F.max("batch_timestamp").alias("b"))
    return per_packet.agg(F.count(F.lit(1)).alias("packets"), F.sum("n").alias("n"),
                          F.max(F.when(F.col("a") == F.col("b"), 1).otherwise(2)).cast("bigint").alias("arrivals"))


@query("deflatten", """
SELECT batch, CAST(1 AS BIGINT) AS scopes, count(*) AS spans, string_agg(span_id, ',' ORDER BY okey, line) AS span_ids
FROM spans GROUP BY batch""", SPANS)
def deflatten_spans(spark, sf):
    packets = deflatten(flatten_spans(fixtures.span_packets_in_small_tasks(spark, sf)), "spans")
    scopes = F.flatten(F.transform("resourceSpans", lambda r: r["scopeSpans"]))
    spans = F.flatten(F.transform(scopes, lambda s: s["spans"]))
    return packets.select(
        F.col("batch_UUID").alias("batch"), F.size(scopes).cast("bigint").alias("scopes"),
        F.size(spans).cast("bigint").alias("spans"),
        F.array_join(F.transform(spans, lambda s: hex_id(s["spanId"])), ",").alias("span_ids"))


@query("deflatten_profiles", """
SELECT batch, sample AS sample_seq_no, CAST(value_no AS BIGINT) AS value_seq_no, value, ts_ns, host, role,
  profile_id AS trace_id, CAST(len(words) AS BIGINT) AS depth, array_to_string(words[1:3], ' ') AS top,
  array_to_string(words[-2:], ' ') AS bottom FROM profile_rows""", PROFILES)
def rebuilt_profiles(spark, sf):
    """Profile rows that went back to packets, with new dictionaries, and were flattened again."""
    rows = flatten_profiles(deflatten(fixtures.profile_rows(spark, sf), "profiles"))
    names = F.transform("stack", lambda l: F.get(l["lines"], F.lit(0))["function"]["name"])
    return rows.select(
        F.col("batch_UUID").alias("batch"), big("sample_seq_no"), big("value_seq_no"), "value", F.col("timestamp_unix_nano").alias("ts_ns"),
        attribute("resource_attributes", "host.name", "host"), any_value(F.get("attributes", F.lit(0))["value"]).alias("role"), *hexed("trace_id"),
        F.size("stack").cast("bigint").alias("depth"), F.array_join(F.slice(names, 1, 3), " ").alias("top"),
        F.array_join(F.slice(names, F.greatest(F.size(names) - 1, F.lit(1)), F.lit(2)), " ").alias("bottom"))


@query("validity", f"""
SELECT is_valid, CASE WHEN NOT is_valid THEN '{BAD_VALUES}' END AS error_message, count(*) AS n
FROM profile_rows GROUP BY is_valid""", PROFILES)
def validity(spark, sf):
    return fixtures.profile_rows(spark, sf).groupBy("is_valid", "error_message").agg(F.count(F.lit(1)).alias("n"))


@query("packet_outcome", f"""
SELECT batch, count(*) AS n, count(*) FILTER (WHERE NOT is_valid) AS rejected,
  CASE WHEN count(*) FILTER (WHERE NOT is_valid) > 0 THEN '{BAD_VALUES}' END AS error_message
FROM profile_rows GROUP BY batch""", PROFILES)
def outcome(spark, sf):
    return packet_outcome(fixtures.profile_rows(spark, sf), "profiles").select(
        F.col("batch_UUID").alias("batch"), F.col("rows").alias("n"), "rejected", "error_message")


@query("ingest_counters", """
SELECT 'logs' AS signal, count(*) AS items, CAST(0 AS BIGINT) AS dropped, count(DISTINCT batch) AS succeeded,
  CAST(0 AS BIGINT) AS partly FROM logs
UNION ALL SELECT 'spans', count(*), 0, count(DISTINCT batch), 0 FROM spans
UNION ALL SELECT 'metrics', count(*), 0, count(DISTINCT batch), 0 FROM points
UNION ALL SELECT 'profiles', count(*), count(*) FILTER (WHERE NOT is_valid),
  count(DISTINCT batch) - count(DISTINCT batch) FILTER (WHERE NOT is_valid),
  count(DISTINCT batch) FILTER (WHERE NOT is_valid) FROM profile_rows""", LOGS, SPANS, POINTS, PROFILES)
def counters(spark, sf):
    parts = [
        ingest_counters(packet_outcome(FLATTEN[s](fixtures.PACKETS[s](spark, sf)), s), s)
        for s in ("logs", "spans", "metrics", "profiles")
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.toDF("signal", "items", "dropped", "succeeded", "partly")
