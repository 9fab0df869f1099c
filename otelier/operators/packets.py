"""Operators on packets as wholes: outcome, counters, and rows back to packets."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from otelier.functions.anyvalue import BRANCHES
from otelier.functions.expressions import let
from otelier.operators.profiles_packets import deflatten_profiles
from otelier.schemas import LINEAGE, METRIC_KINDS, flat_schema


def packet_outcome(rows: DataFrame, signal: str) -> DataFrame:
    """Per packet: rows, invalid rows and the first error message, the parts of a partial-success answer."""
    position = F.struct(*LINEAGE[signal][2:])
    return rows.groupBy("batch_UUID").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("is_valid")).alias("rejected"),
        F.min_by("error_message", F.when(F.col("error_message").isNotNull(), position)).alias("error_message"),
    )


def ingest_counters(outcome: DataFrame, signal: str) -> DataFrame:
    """Items, dropped items, succeeded and partly succeeded packets of a signal, from packet_outcome."""
    return outcome.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("request_items"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("dropped_request_items"),
        F.count_if(F.col("rejected") == 0).alias("succeeded_requests"),
        F.count_if(F.col("rejected") > 0).alias("partially_succeeded_requests"),
    ).select(F.lit(signal).alias("signal"), "*")


def observe_rows(rows: DataFrame, observation) -> DataFrame:
    """Count items and dropped items on the side of a batch or a stream, without a second pass."""
    return rows.observe(observation, F.count(F.lit(1)).alias("request_items"),
                        F.count_if(~F.col("is_valid")).alias("dropped_request_items"))


# ---------------------------------------------------------------- rows back to packets


def _log_record() -> Column:
    body_of = {"string_value": "body_string", "bool_value": "body_bool", "int_value": "body_int",
               "double_value": "body_double", "array_value": "body_array", "kvlist_value": "body_kvlist",
               "bytes_value": "body_bytes"}
    body = F.struct(*[
        F.col(body_of[b]).alias(b) if b in body_of else F.lit(None).cast("int").alias(b) for b in BRANCHES
    ])
    return F.struct(
        F.col("time_unix_nano").alias("timeUnixNano"),
        F.col("observed_time_unix_nano").alias("observedTimeUnixNano"),
        F.col("severity_number").alias("severityNumber"),
        F.col("severity_text").alias("severityText"),
        F.when(F.col("body_type") != "VALUE_NOT_SET", body).alias("body"),
        "attributes", F.col("dropped_attributes_count").alias("droppedAttributesCount"), "flags",
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"),
        F.col("event_name").alias("eventName"),
    )


def _span_record() -> Column:
    return F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"),
        F.col("trace_state").alias("traceState"), F.col("parent_span_id").alias("parentSpanId"),
        "flags", "name", "kind",
        F.col("start_time_unix_nano").alias("startTimeUnixNano"),
        F.col("end_time_unix_nano").alias("endTimeUnixNano"),
        "attributes", F.col("dropped_attributes_count").alias("droppedAttributesCount"),
        "events", F.col("dropped_events_count").alias("droppedEventsCount"),
        "links", F.col("dropped_links_count").alias("droppedLinksCount"), "status",
    )


def _point() -> Column:
    """All that a point of any kind may have; `_metric` picks the fields of its kind."""
    own = [f.name for f in flat_schema("metrics").fields if f.name.startswith(
        ("gauge_", "sum_", "histogram_", "exponential_histogram_", "summary_"))]
    return F.struct("datapoint_seq_no", "attributes", "start_time_unix_nano", "time_unix_nano", "flags", "exemplars",
                    *own)


def _number(p: Column, kind: str) -> list[Column]:
    return [
        F.when(p[f"{kind}_type"] == "AS_DOUBLE", p[f"{kind}_double"]).alias("asDouble"),
        F.when(p[f"{kind}_type"] == "AS_INT", p[f"{kind}_int"]).alias("asInt"),
    ]


def _histogram(p: Column) -> list[Column]:
    names = {"count": "count", "sum": "sum", "bucketCounts": "bucket_counts", "explicitBounds": "explicit_bounds",
             "min": "min", "max": "max"}
    return [p[f"histogram_{c}"].alias(n) for n, c in names.items()]


def _exp_histogram(p: Column) -> list[Column]:
    names = {"count": "count", "sum": "sum", "scale": "scale", "zeroCount": "zero_count", "positive": "positive",
             "negative": "negative", "min": "min", "max": "max", "zeroThreshold": "zero_threshold"}
    return [p[f"exponential_histogram_{c}"].alias(n) for n, c in names.items()]


def _summary(p: Column) -> list[Column]:
    names = {"count": "count", "sum": "sum", "quantileValues": "quantile_values"}
    return [p[f"summary_{c}"].alias(n) for n, c in names.items()]


_KIND_FIELDS = {
    "gauge": lambda p: _number(p, "gauge"),
    "sum": lambda p: _number(p, "sum"),
    "histogram": _histogram,
    "exponentialHistogram": _exp_histogram,
    "summary": _summary,
}


def _metric(head: Column, points: Column) -> Column:
    temporality = head["aggregation_temporality"].alias("aggregationTemporality")
    extra = {"sum": [temporality, head["is_monotonic"].alias("isMonotonic")], "histogram": [temporality],
             "exponentialHistogram": [temporality]}

    def kind_struct(kind: str) -> Column:
        def one(p: Column) -> Column:
            exemplars = [] if kind == "summary" else [p["exemplars"].alias("exemplars")]
            return F.struct(
                p["attributes"].alias("attributes"), p["start_time_unix_nano"].alias("startTimeUnixNano"),
                p["time_unix_nano"].alias("timeUnixNano"), p["flags"].alias("flags"), *exemplars,
                *_KIND_FIELDS[kind](p))

        body = F.struct(F.transform(points, one).alias("dataPoints"), *extra.get(kind, []))
        return F.when(head["type"] == METRIC_KINDS[kind][0], body).alias(kind)

    return F.struct(*[head[c].alias(c) for c in ("name", "description", "unit")], head["metric_metadata"].alias("metadata"),
                    *[kind_struct(k) for k in METRIC_KINDS])


_TREES = {
    "logs": ("resourceLogs", "scopeLogs", "logRecords", "log_schema_url"),
    "spans": ("resourceSpans", "scopeSpans", "spans", "span_schema_url"),
    "metrics": ("resourceMetrics", "scopeMetrics", "metrics", "metric_schema_url"),
}


def _runs(items: Column, differ) -> Column:
    """An array cut into arrays, before each item for which `differ` (item, the one before it) is true."""
    first = F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda i: (i == 0) | differ(F.get(items, i), F.get(items, i - 1)))
    return let(first, lambda at: F.transform(
        at, lambda i, k: F.slice(items, i + 1, F.coalesce(F.get(at, k + 1), F.size(items)) - i)))


def _by(*names: str):
    return lambda a, b: reduce(or_, [~a[n].eqNullSafe(b[n]) for n in names])


def deflatten(rows: DataFrame, signal: str) -> DataFrame:
    """Rebuild the packets of a signal from their rows; for profiles see `deflatten_profiles`.

    Neighbouring records (in order of their sequence numbers) that share resource and scope go back under one node; where
    either changes, a new node starts, so equal nodes of a packet stay apart unless they touch. Copies of a row (a
    packet read twice) are dropped; a packet that arrived twice has the time of its first arrival. The rows are collected
    once, by packet id, so groups are no larger than a packet and its copies, and rows that are already partitioned by
    packet id are not exchanged. The rest happens inside the list of a packet, not by sorts of whole rows.
    """
    if signal == "profiles":
        return deflatten_profiles(rows)
    root, scopes, records, schema_url = _TREES[signal]
    place = list(LINEAGE[signal])[2:]
    resource = F.struct(
        F.struct(F.col("resource_attributes").alias("attributes"),
                 F.col("resource_dropped_attributes_count").alias("droppedAttributesCount"),
                 F.col("resource_entity_refs").alias("entityRefs")).alias("resource"),
        F.col("resource_schema_url").alias("schemaUrl"))
    scope = F.struct(
        F.struct(F.col("scope_name").alias("name"), F.col("scope_version").alias("version"),
                 F.col("scope_attributes").alias("attributes"),
                 F.col("scope_dropped_attributes_count").alias("droppedAttributesCount")).alias("scope"),
        F.col(schema_url).alias("schemaUrl"))
    if signal == "metrics":
        head = F.struct("seq_no", "name", "description", "unit", "type", "metric_metadata", "aggregation_temporality",
                        "is_monotonic")
        content = [head.alias("head"), _point().alias("record")]
    else:
        content = [{"logs": _log_record, "spans": _span_record}[signal]().alias("record")]
    item = F.struct(*place, resource.alias("resource"), scope.alias("scope"), *content)
    packets = rows.groupBy("batch_UUID").agg(
        F.min("batch_timestamp").alias("batch_timestamp"), F.collect_list(item).alias("_items"))

    def records_of(items: Column) -> Column:
        if signal != "metrics":
            return F.transform(items, lambda x: x["record"])
        return F.transform(_runs(items, _by("head")), lambda of_one: _metric(
            F.get(of_one, F.lit(0))["head"], F.transform(of_one, lambda x: x["record"])))

    def scope_node(items: Column) -> Column:
        node = F.get(items, F.lit(0))["scope"]
        return F.struct(node["scope"].alias("scope"), node["schemaUrl"].alias("schemaUrl"), records_of(items).alias(records))

    def resource_node(items: Column) -> Column:
        node = F.get(items, F.lit(0))["resource"]
        return F.struct(node["resource"].alias("resource"), node["schemaUrl"].alias("schemaUrl"),
                        F.transform(_runs(items, _by("scope")), scope_node).alias(scopes))

    def tree(items: Column) -> Column:
        return F.transform(_runs(items, _by("resource")), resource_node)

    # the place comes first in an item, so they sort by it; of copies the first counts
    distinct = let(F.sort_array("_items"), lambda items: F.filter(
        items, lambda x, i: (i == 0) | _by(*place)(x, F.get(items, i - 1))))
    return packets.select("batch_timestamp", "batch_UUID", let(distinct, tree).alias(root))
