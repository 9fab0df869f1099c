"""Trace operators: the span view, traces, parents, events and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from otelier.functions.anyvalue import attributes_json, scalar_map
from otelier.functions.expressions import column, hex_id, nanos_to_millis_timestamp, nanos_to_timestamp
from otelier.operators.relational import filter_id, project, sort_rows

# Fixed values of the span view: output column -> attribute names, the newer or more general name last.
RESOURCE_FIELDS = {
    "telemetry_name": ("telemetry.sdk.name",),
    "telemetry_language": ("telemetry.sdk.language",),
    "telemetry_version": ("telemetry.sdk.version",),
    "runtime_description": ("process.runtime.description",),
    "runtime_name": ("process.runtime.name",),
    "runtime_version": ("process.runtime.version",),
    "service_name": ("service.name",),
}
SPAN_FIELDS = {
    "http_method": ("http.method", "http.request.method"),
    "http_scheme": ("http.scheme", "url.scheme"),
    "http_version": ("http.flavor", "network.protocol.version"),
    "http_status_code": ("http.status_code", "http.response.status_code"),
    "http_url": ("http.url", "url.full"),
    "rpc_method": ("rpc.method", "grpc.method"),
    "rpc_service": ("rpc.service",),
    "rpc_system": ("rpc.system",),
    "rpc_status_code": ("rpc.grpc.status_code", "grpc.status_code"),
}


def _fields(lookup: str, names: dict[str, tuple[str, ...]]) -> list[Column]:
    return [F.coalesce(*[F.col(lookup)[k] for k in keys]).alias(out) for out, keys in names.items()]


def basic_spans(spans: DataFrame) -> DataFrame:
    """The span view: event time, ids as hex text, telemetry, service, HTTP and RPC fields, status and attributes.

    Attribute lists become maps once per row and are then looked up by key. Columns that a query does not use,
    the maps included, are pruned away. Filters on ids belong on the flat table, where they reach the scan.
    """
    mapped = spans.select(
        nanos_to_timestamp("start_time_unix_nano").alias("event_time"),
        nanos_to_millis_timestamp("end_time_unix_nano").alias("end_time"),
        "scope_name", "scope_version", "kind", "name",
        *[hex_id(c).alias(c) for c in ("trace_id", "span_id", "parent_span_id")],
        scalar_map(F.col("resource_attributes")).alias("_resource"),
        scalar_map(F.col("attributes")).alias("_span"),
        F.col("status.code").alias("status_code"),
        F.col("status.message").alias("status_message"),
        attributes_json(F.col("attributes")).alias("attributes"),
    )
    return mapped.select(
        "event_time", "end_time", "scope_name", "scope_version", "kind", "name", "trace_id", "span_id",
        "parent_span_id", *_fields("_resource", RESOURCE_FIELDS), *_fields("_span", SPAN_FIELDS),
        "status_code", "status_message", "attributes",
    )


def trace_logs(prepared_logs: DataFrame, trace_id: bytes | str, columns: list[str]) -> DataFrame:
    """All logs of one trace, across services."""
    return project(filter_id(prepared_logs, "trace_id", trace_id), *columns)


def trace_view(prepared_spans: DataFrame, trace_id: bytes | str, columns: list[str]) -> DataFrame:
    """All spans of one trace by start time."""
    return project(sort_rows(filter_id(prepared_spans, "trace_id", trace_id), "start_time_unix_nano"), *columns)


def span_parent(spans: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Each span with columns of its parent (prefix `parent_`); null for a root or where the parent is missing.

    Parents are found by (trace, span id), so a large trace is spread over tasks; many children of one parent are
    split by adaptive execution.
    """
    # a retransmitted parent must not double its children; copies are cut before the shuffle, and the order that the
    # row number needs is one that the join can use
    one = Window.partitionBy("trace_id", "parent_span_id").orderBy(*[f"parent_{c}" for c in parent_columns])
    parents = (
        spans.filter(F.length("span_id") > 0)
        .select("trace_id", F.col("span_id").alias("parent_span_id"), *[column(c).alias(f"parent_{c}") for c in parent_columns])
        .withColumn("_copy", F.row_number().over(one)).filter("_copy = 1").drop("_copy")
    )
    joined = spans.join(parents, ["trace_id", "parent_span_id"], "left")
    return joined.select(*[column(c) for c in spans.columns], *[f"parent_{c}" for c in parent_columns])


def span_status(spans: DataFrame) -> DataFrame:
    """Status split into `status.message` and `status.code`."""
    return spans.withColumns({
        "status.message": F.col("status.message"), "status.code": F.col("status.code"),
    }).drop("status")


def span_events(spans: DataFrame, keep: list[str]) -> DataFrame:
    """A row per span event; fields of the event get the prefix `event_`."""
    fields = ("time_unix_nano", "name", "attributes", "dropped_attributes_count")
    return spans.select(*[column(c) for c in keep], F.explode("events").alias("_e")).select(
        *[column(c) for c in keep], *[F.col(f"_e.{f}").alias(f"event_{f}") for f in fields])


def with_duration(spans: DataFrame) -> DataFrame:
    """Add `duration_nanos`."""
    return spans.withColumn("duration_nanos", F.col("end_time_unix_nano") - F.col("start_time_unix_nano"))


def span_duration(spans: DataFrame, *keys: str) -> DataFrame:
    """Spans to metrics: count, sum, least and greatest duration per key."""
    return with_duration(spans).groupBy(*[column(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("spans"),
        F.sum("duration_nanos").alias("sum_nanos"),
        F.min("duration_nanos").alias("min_nanos"),
        F.max("duration_nanos").alias("max_nanos"),
    )
