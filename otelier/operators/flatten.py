"""Packets to flat rows: logs, spans and metrics.

A packet nests resource[] -> scope[] -> record[]. Each level is one explode, with a plain select of the
columns the level adds, so the whole operator is a narrow stage: no shuffle, and nothing is built per packet but
the offsets that number records across it. Empty resources, scopes and metrics give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from otelier.functions.anyvalue import value_branch, with_defaults
from otelier.functions.expressions import default_for, explode_level, or_empty, running_totals
from otelier.schemas import METRIC_KINDS, NULLABLE, flat_schema

BAD_BUCKETS = "bucket bounds and counts of a histogram do not fit together"

RESOURCE_COLUMNS = ("resource_attributes", "resource_dropped_attributes_count", "resource_entity_refs",
                    "resource_schema_url")
SCOPE_COLUMNS = ("scope_name", "scope_version", "scope_attributes", "scope_dropped_attributes_count")


# ---------------------------------------------------------------- shared steps


def with_lineage(packets: DataFrame) -> DataFrame:
    """Arrival time and packet id, where the source has not set them.

    The id is a hash of the content, so a task that runs again gives the same id.
    """
    if "batch_UUID" not in packets.columns:
        packets = packets.withColumn("batch_UUID", F.md5(F.to_json(F.struct(*packets.columns))))
    if "batch_timestamp" not in packets.columns:
        packets = packets.withColumn("batch_timestamp", F.unix_millis(F.current_timestamp()))
    return packets


def resource_columns(resource: Column, schema_url: Column, defaults: str | None = None) -> dict[str, Column]:
    attributes = resource["attributes"]
    return {
        "resource_attributes": with_defaults(attributes, defaults) if defaults else attributes,
        "resource_dropped_attributes_count": resource["droppedAttributesCount"],
        "resource_entity_refs": resource["entityRefs"],
        "resource_schema_url": schema_url,
    }


def scope_columns(scope: Column) -> dict[str, Column]:
    return {
        "scope_name": scope["name"],
        "scope_version": scope["version"],
        "scope_attributes": scope["attributes"],
        "scope_dropped_attributes_count": scope["droppedAttributesCount"],
    }


def aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def flat_row(signal: str, columns: dict[str, Column]) -> list[Column]:
    """The select list of a flat row: schema order, type defaults where a field is unset, null where that is allowed."""
    out = []
    for field in flat_schema(signal).fields:
        value = columns.get(field.name)
        if value is None:
            value = F.lit(None).cast(field.dataType)
        if field.name not in NULLABLE[signal]:
            default = default_for(field.dataType)
            if default is not None:
                value = F.coalesce(value, default)
        out.append(value.alias(field.name))
    return out


def _named(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _walk(packets: DataFrame, root: str, scopes: str, records: str, keep=None, defaults: str | None = None) -> DataFrame:
    """One row per record: lineage, resource and scope columns, `_schema_url`, `_record` and `_no`.

    `_no` numbers the records from 0 across the whole packet. `keep` selects the records that count.
    """

    def kept(scope: Column) -> Column:
        return scope[records] if keep is None else F.filter(scope[records], keep)

    # offsets: records before each scope of the packet, and scopes before each resource
    per_scope = F.flatten(F.transform(or_empty(F.col(root)), lambda r: F.transform(
        or_empty(r[scopes]), lambda s: F.size(or_empty(kept(s))))))
    per_resource = F.transform(or_empty(F.col(root)), lambda r: F.size(or_empty(r[scopes])))
    lineage = ["batch_timestamp", "batch_UUID"]

    packets_ = with_lineage(packets).select(
        *lineage, root,
        running_totals(per_scope).alias("_records_before"),
        running_totals(per_resource).alias("_scopes_before"),
    )
    resources = explode_level(
        packets_, [*lineage, "_records_before", "_scopes_before"], root, "_r_no", "_r")

    resources = resources.select(
        *lineage, "_records_before",
        F.get("_scopes_before", F.col("_r_no")).alias("_first"),
        *aliased(resource_columns(F.col("_r.resource"), F.col("_r.schemaUrl"), defaults)),
        F.col(f"_r.{scopes}").alias("_scopes"),
    )
    scopes_ = explode_level(
        resources, [*lineage, "_records_before", "_first", *RESOURCE_COLUMNS], "_scopes", "_s_no", "_s")

    scopes_ = scopes_.select(
        *lineage,
        F.get("_records_before", F.col("_first") + F.col("_s_no")).alias("_before"),
        *RESOURCE_COLUMNS,
        *aliased(scope_columns(F.col("_s.scope"))),
        F.col("_s.schemaUrl").alias("_schema_url"),
        kept(F.col("_s")).alias("_records"),
    )
    records_ = explode_level(
        scopes_, [*lineage, "_before", *RESOURCE_COLUMNS, *SCOPE_COLUMNS, "_schema_url"],
        "_records", "_pos", "_record")
    return records_.withColumn("_no", F.col("_before") + F.col("_pos"))


def _inherited() -> dict[str, Column]:
    return _named("batch_timestamp", "batch_UUID", *RESOURCE_COLUMNS, *SCOPE_COLUMNS)


# ---------------------------------------------------------------- logs


def log_columns(record: Column, schema_url: Column) -> dict[str, Column]:
    """Flat columns of one log record. The branch of the body decides which body column is filled."""
    body = record["body"]
    return {
        "time_unix_nano": record["timeUnixNano"],
        "observed_time_unix_nano": record["observedTimeUnixNano"],
        "severity_number": record["severityNumber"],
        "severity_text": record["severityText"],
        "body_type": F.when(body.isNull(), "VALUE_NOT_SET").otherwise(value_branch(body)),
        "body_string": body["string_value"],
        "body_bool": body["bool_value"],
        "body_int": body["int_value"],
        "body_double": body["double_value"],
        "body_array": body["array_value"],
        "body_kvlist": body["kvlist_value"],
        "body_bytes": body["bytes_value"],
        "attributes": record["attributes"],
        "dropped_attributes_count": record["droppedAttributesCount"],
        "flags": record["flags"],
        "trace_id": record["traceId"],
        "span_id": record["spanId"],
        "event_name": record["eventName"],
        "log_schema_url": schema_url,
        "is_valid": F.lit(True),
    }


def flatten_logs(packets: DataFrame, default_resource_attributes: str | None = None) -> DataFrame:
    """One row per log record; `seq_no` counts from 0 across the packet."""
    rows = _walk(packets, "resourceLogs", "scopeLogs", "logRecords", defaults=default_resource_attributes)
    return rows.select(*flat_row("logs", {
        **_inherited(), "seq_no": F.col("_no"), **log_columns(F.col("_record"), F.col("_schema_url")),
    }))


# ---------------------------------------------------------------- spans


def span_columns(record: Column, schema_url: Column) -> dict[str, Column]:
    """Flat columns of one span."""
    status = record["status"]
    return {
        "trace_id": record["traceId"],
        "span_id": record["spanId"],
        "trace_state": record["traceState"],
        "parent_span_id": record["parentSpanId"],
        "flags": record["flags"],
        "name": record["name"],
        "kind": F.coalesce(record["kind"], F.lit("SPAN_KIND_UNSPECIFIED")),
        "start_time_unix_nano": record["startTimeUnixNano"],
        "end_time_unix_nano": record["endTimeUnixNano"],
        "attributes": record["attributes"],
        "dropped_attributes_count": record["droppedAttributesCount"],
        "events": record["events"],
        "dropped_events_count": record["droppedEventsCount"],
        "links": record["links"],
        "dropped_links_count": record["droppedLinksCount"],
        "status": F.struct(
            F.coalesce(status["message"], F.lit("")).alias("message"),
            F.coalesce(status["code"], F.lit("STATUS_CODE_UNSET")).alias("code"),
        ),
        "span_schema_url": schema_url,
        "is_valid": F.lit(True),
    }


def flatten_spans(packets: DataFrame, default_resource_attributes: str | None = None) -> DataFrame:
    """One row per span; `seq_no` counts from 0 across the packet."""
    rows = _walk(packets, "resourceSpans", "scopeSpans", "spans", defaults=default_resource_attributes)
    return rows.select(*flat_row("spans", {
        **_inherited(), "seq_no": F.col("_no"), **span_columns(F.col("_record"), F.col("_schema_url")),
    }))


# ---------------------------------------------------------------- metrics


def _has_points(metric: Column) -> Column:
    sizes = [F.size(or_empty(metric[kind]["dataPoints"])) for kind in METRIC_KINDS]
    return F.greatest(*sizes) > 0


def _has_no_type(metric: Column) -> Column:
    missing = F.lit(True)
    for kind in METRIC_KINDS:
        missing = missing & metric[kind].isNull()
    return missing


def _number_type(point: Column) -> Column:
    return (F.when(point["asDouble"].isNotNull(), "AS_DOUBLE")
            .when(point["asInt"].isNotNull(), "AS_INT").otherwise("VALUE_NOT_SET"))


def point_columns(point: Column) -> dict[str, Column]:
    """Flat columns of one data point, given as a struct with one field per metric kind, one of them set."""
    gauge, total, hist, exp, summary = (point[k] for k in METRIC_KINDS)
    every = (gauge, total, hist, exp, summary)

    def zero(p: Column, field: str, default) -> Column:
        # numbers lose their presence: an unset one is 0 wherever the point is of this kind
        return F.when(p.isNotNull(), F.coalesce(p[field], F.lit(default)))

    bounds = F.size(or_empty(hist["explicitBounds"]))
    counts = F.size(or_empty(hist["bucketCounts"]))
    bad_buckets = hist.isNotNull() & (counts + bounds > 0) & (counts != bounds + 1)
    # the summary points of the protocol carry no exemplars
    with_exemplars = (gauge, total, hist, exp)
    return {
        "attributes": F.coalesce(*[p["attributes"] for p in every]),
        "start_time_unix_nano": F.coalesce(*[p["startTimeUnixNano"] for p in every]),
        "time_unix_nano": F.coalesce(*[p["timeUnixNano"] for p in every]),
        "exemplars": F.coalesce(*[p["exemplars"] for p in with_exemplars]),
        "flags": F.coalesce(*[p["flags"] for p in every]),
        "gauge_type": F.when(gauge.isNotNull(), _number_type(gauge)),
        "gauge_double": zero(gauge, "asDouble", 0.0),
        "gauge_int": zero(gauge, "asInt", 0),
        "sum_type": F.when(total.isNotNull(), _number_type(total)),
        "sum_double": zero(total, "asDouble", 0.0),
        "sum_int": zero(total, "asInt", 0),
        "histogram_count": zero(hist, "count", 0),
        "histogram_sum": zero(hist, "sum", 0.0),
        "histogram_bucket_counts": hist["bucketCounts"],
        "histogram_explicit_bounds": hist["explicitBounds"],
        "histogram_min": zero(hist, "min", 0.0),
        "histogram_max": zero(hist, "max", 0.0),
        "exponential_histogram_count": zero(exp, "count", 0),
        "exponential_histogram_sum": zero(exp, "sum", 0.0),
        "exponential_histogram_scale": zero(exp, "scale", 0),
        "exponential_histogram_zero_count": zero(exp, "zeroCount", 0),
        "exponential_histogram_positive": exp["positive"],
        "exponential_histogram_negative": exp["negative"],
        "exponential_histogram_min": zero(exp, "min", 0.0),
        "exponential_histogram_max": zero(exp, "max", 0.0),
        "exponential_histogram_zero_threshold": zero(exp, "zeroThreshold", 0.0),
        "summary_count": zero(summary, "count", 0),
        "summary_sum": zero(summary, "sum", 0.0),
        "summary_quantile_values": summary["quantileValues"],
        "is_valid": ~F.coalesce(bad_buckets, F.lit(False)),
        "error_message": F.when(bad_buckets, BAD_BUCKETS),
    }


def _metric_columns(metric: Column) -> dict[str, Column]:
    kind_name = F.lit(None).cast("string")
    for kind, (name, _) in reversed(METRIC_KINDS.items()):
        kind_name = F.when(metric[kind].isNotNull(), name).otherwise(kind_name)
    temporality = F.coalesce(*[
        F.when(metric[k].isNotNull(), F.coalesce(metric[k]["aggregationTemporality"],
                                                 F.lit("AGGREGATION_TEMPORALITY_UNSPECIFIED")))
        for k in ("sum", "histogram", "exponentialHistogram")
    ])
    return {
        "name": metric["name"],
        "description": metric["description"],
        "unit": metric["unit"],
        "metric_metadata": metric["metadata"],
        "type": kind_name,
        "aggregation_temporality": temporality,
        "is_monotonic": F.when(metric["sum"].isNotNull(), F.coalesce(metric["sum"]["isMonotonic"], F.lit(False))),
    }


def flatten_metrics(packets: DataFrame, default_resource_attributes: str | None = None) -> DataFrame:
    """One row per data point of the five metric kinds.

    `seq_no` numbers the metrics that have points, from 1 across the packet; `datapoint_seq_no` counts from 0 in each.
    """
    metrics = _walk(packets, "resourceMetrics", "scopeMetrics", "metrics", keep=_has_points,
                    defaults=default_resource_attributes)
    # one struct array for the five kinds; a metric has points of one kind, the others are empty
    points = F.arrays_zip(*[
        F.coalesce(F.col(f"_record.{kind}.dataPoints"), F.array().cast(f"array<{point}>")).alias(kind)
        for kind, (_, point) in METRIC_KINDS.items()
    ])
    head = _metric_columns(F.col("_record"))
    inherited = ["batch_timestamp", "batch_UUID", *RESOURCE_COLUMNS, *SCOPE_COLUMNS, "_schema_url"]
    metrics = metrics.select(*inherited, (F.col("_no") + 1).alias("seq_no"), *aliased(head), points.alias("_points"))
    rows = explode_level(metrics, [*inherited, "seq_no", *head], "_points", "datapoint_seq_no", "_point")
    return rows.select(*flat_row("metrics", {
        **_inherited(), **_named("seq_no", "datapoint_seq_no", *head),
        **point_columns(F.col("_point")), "metric_schema_url": F.col("_schema_url"),
    }))


def untyped_metrics(packets: DataFrame) -> DataFrame:
    """The metrics that flatten_metrics skips because they have no type: packet, scope and name."""
    metrics = _walk(packets, "resourceMetrics", "scopeMetrics", "metrics", keep=_has_no_type)
    return metrics.select("batch_timestamp", "batch_UUID", *RESOURCE_COLUMNS, "scope_name",
                          F.col("_record.name").alias("name"))


def observe_metrics_packets(packets: DataFrame, observation) -> DataFrame:
    """Count packets and skipped untyped metrics on the side, while the packets flow on to flatten_metrics."""
    untyped = F.aggregate(
        or_empty(F.col("resourceMetrics")), F.lit(0),
        lambda n, r: n + F.aggregate(
            or_empty(r["scopeMetrics"]), F.lit(0),
            lambda m, s: m + F.size(F.filter(or_empty(s["metrics"]), _has_no_type))))
    return packets.observe(observation, F.count(F.lit(1)).alias("packets"),
                           F.sum(untyped).alias("untyped_metrics"))

