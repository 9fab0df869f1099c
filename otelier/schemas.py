"""Schemas: one flat row per record, and the nested packets the rows come from.

Flat schemas are what is stored and queried. Packet schemas are the typed form of one export request; their JSON
encoding differs only in ways `wire_schema` derives: camelCase names, 64-bit integers and bytes as text.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import types as T

SIGNALS = ("logs", "spans", "metrics", "profiles")

# ---------------------------------------------------------------- shared pieces

_ANY_FIELDS = (
    "string_value:STRING, bool_value:BOOLEAN, int_value:BIGINT, double_value:DOUBLE, "
    "array_value:STRING, kvlist_value:STRING, bytes_value:BINARY"
)
# nested lists and key-value lists stay JSON text, because a schema cannot be recursive
ANY_VALUE = f"STRUCT<{_ANY_FIELDS}>"
ANY_VALUE_INDEXED = f"STRUCT<{_ANY_FIELDS}, string_value_strindex:INT>"
KEY_VALUE = f"STRUCT<key:STRING, value:{ANY_VALUE}>"
KEY_VALUE_INDEXED = f"STRUCT<key:STRING, key_strindex:INT, value:{ANY_VALUE_INDEXED}>"
KEY_VALUE_UNIT = f"STRUCT<key:STRING, value:{ANY_VALUE}, unit:STRING>"
ENTITY = "STRUCT<schema_url:STRING, type:STRING, id_keys:ARRAY<STRING>, description_keys:ARRAY<STRING>>"
VALUE_TYPE = "STRUCT<type:STRING, unit:STRING>"
BUCKETS = "STRUCT<offset:INT, bucket_counts:ARRAY<BIGINT>>"
QUANTILE = "STRUCT<quantile:DOUBLE, value:DOUBLE>"
STATUS = "STRUCT<message:STRING, code:STRING>"
EXEMPLAR = (
    f"STRUCT<filtered_attributes:ARRAY<{KEY_VALUE}>, time_unix_nano:BIGINT, as_double:DOUBLE, as_int:BIGINT, "
    "span_id:BINARY, trace_id:BINARY>"
)
SPAN_EVENT = (
    f"STRUCT<time_unix_nano:BIGINT, name:STRING, attributes:ARRAY<{KEY_VALUE}>, dropped_attributes_count:INT>"
)
SPAN_LINK = (
    f"STRUCT<trace_id:BINARY, span_id:BINARY, trace_state:STRING, attributes:ARRAY<{KEY_VALUE}>, "
    "dropped_attributes_count:INT, flags:INT>"
)
FUNCTION = "STRUCT<name:STRING, system_name:STRING, filename:STRING, start_line:BIGINT>"
MAPPING = (
    "STRUCT<memory_start:BIGINT, memory_limit:BIGINT, file_offset:BIGINT, filename:STRING, "
    f"attributes:ARRAY<{KEY_VALUE_UNIT}>>"
)
LOCATION = (
    f"STRUCT<mapping:{MAPPING}, address:BIGINT, "
    f"lines:ARRAY<STRUCT<function:{FUNCTION}, line:BIGINT, `column`:BIGINT>>, attributes:ARRAY<{KEY_VALUE_UNIT}>>"
)

# ---------------------------------------------------------------- flat rows

_LINEAGE = "batch_timestamp BIGINT, `batch_UUID` STRING"
_RESOURCE_COLS = (
    f"resource_attributes ARRAY<{KEY_VALUE}>, resource_dropped_attributes_count INT, "
    f"resource_entity_refs ARRAY<{ENTITY}>, resource_schema_url STRING"
)
_SCOPE_COLS = (
    f"scope_name STRING, scope_version STRING, scope_attributes ARRAY<{KEY_VALUE}>, "
    "scope_dropped_attributes_count INT"
)
_VALIDITY = "is_valid BOOLEAN, error_message STRING"

FLAT_DDL = {
    "logs": f"""
        {_LINEAGE}, seq_no INT, {_RESOURCE_COLS}, {_SCOPE_COLS},
        time_unix_nano BIGINT, observed_time_unix_nano BIGINT, severity_number INT, severity_text STRING,
        body_type STRING, body_string STRING, body_bool BOOLEAN, body_int BIGINT, body_double DOUBLE,
        body_array STRING, body_kvlist STRING, body_bytes BINARY,
        attributes ARRAY<{KEY_VALUE}>, dropped_attributes_count INT, flags INT, trace_id BINARY, span_id BINARY,
        event_name STRING, log_schema_url STRING, {_VALIDITY}""",
    "spans": f"""
        {_LINEAGE}, seq_no INT, {_RESOURCE_COLS}, {_SCOPE_COLS},
        trace_id BINARY, span_id BINARY, trace_state STRING, parent_span_id BINARY, flags INT, name STRING,
        kind STRING, start_time_unix_nano BIGINT, end_time_unix_nano BIGINT,
        attributes ARRAY<{KEY_VALUE}>, dropped_attributes_count INT,
        events ARRAY<{SPAN_EVENT}>, dropped_events_count INT,
        links ARRAY<{SPAN_LINK}>, dropped_links_count INT, status {STATUS}, span_schema_url STRING, {_VALIDITY}""",
    "metrics": f"""
        {_LINEAGE}, seq_no INT, {_RESOURCE_COLS}, {_SCOPE_COLS},
        name STRING, description STRING, unit STRING, type STRING, datapoint_seq_no INT,
        attributes ARRAY<{KEY_VALUE}>, start_time_unix_nano BIGINT, time_unix_nano BIGINT,
        exemplars ARRAY<{EXEMPLAR}>, flags INT,
        gauge_type STRING, gauge_double DOUBLE, gauge_int BIGINT,
        sum_type STRING, sum_double DOUBLE, sum_int BIGINT,
        histogram_count BIGINT, histogram_sum DOUBLE, histogram_bucket_counts ARRAY<BIGINT>,
        histogram_explicit_bounds ARRAY<DOUBLE>, histogram_min DOUBLE, histogram_max DOUBLE,
        exponential_histogram_count BIGINT, exponential_histogram_sum DOUBLE, exponential_histogram_scale INT,
        exponential_histogram_zero_count BIGINT, exponential_histogram_positive {BUCKETS},
        exponential_histogram_negative {BUCKETS}, exponential_histogram_min DOUBLE,
        exponential_histogram_max DOUBLE, exponential_histogram_zero_threshold DOUBLE,
        summary_count BIGINT, summary_sum DOUBLE, summary_quantile_values ARRAY<{QUANTILE}>,
        aggregation_temporality STRING, is_monotonic BOOLEAN, metric_schema_url STRING,
        metric_metadata ARRAY<{KEY_VALUE}>, {_VALIDITY}""",
    "profiles": f"""
        {_LINEAGE}, resource_seq_no INT, {_RESOURCE_COLS}, scope_seq_no INT, {_SCOPE_COLS},
        profile_schema_url STRING, profile_seq_no INT, profile_id BINARY,
        profile_attributes ARRAY<{KEY_VALUE_UNIT}>, profile_dropped_attributes_count INT,
        original_payload_format STRING, original_payload BINARY, time_unix_nano BIGINT, duration_nano BIGINT,
        period_type {VALUE_TYPE}, period BIGINT, sample_seq_no INT, stack ARRAY<{LOCATION}>,
        attributes ARRAY<{KEY_VALUE_UNIT}>, timestamp_unix_nano BIGINT, trace_id BINARY, span_id BINARY,
        value_seq_no INT, value BIGINT, sample_type {VALUE_TYPE}, {_VALIDITY}""",
}

# Columns where null means "not set"; every other column of a flat row has the default of its type instead.
NULLABLE = {
    "logs": {"body_string", "body_bool", "body_int", "body_double", "body_array", "body_kvlist", "body_bytes",
             "error_message"},
    "spans": {"error_message"},
    "metrics": {"gauge_type", "gauge_double", "gauge_int", "sum_type", "sum_double", "sum_int",
                "histogram_count", "histogram_sum", "histogram_min", "histogram_max",
                "exponential_histogram_count", "exponential_histogram_sum", "exponential_histogram_scale",
                "exponential_histogram_zero_count", "exponential_histogram_positive",
                "exponential_histogram_negative", "exponential_histogram_min", "exponential_histogram_max",
                "exponential_histogram_zero_threshold", "summary_count", "summary_sum",
                "aggregation_temporality", "is_monotonic", "error_message"},
    "profiles": {"timestamp_unix_nano", "trace_id", "span_id", "value", "error_message"},
}

# The columns that say where a row came from; a retransmitted record differs in them.
LINEAGE = {
    "logs": ("batch_timestamp", "batch_UUID", "seq_no"),
    "spans": ("batch_timestamp", "batch_UUID", "seq_no"),
    "metrics": ("batch_timestamp", "batch_UUID", "seq_no", "datapoint_seq_no"),
    "profiles": ("batch_timestamp", "batch_UUID", "resource_seq_no", "scope_seq_no", "profile_seq_no",
                 "sample_seq_no", "value_seq_no"),
}

# The column that gives a record its event time.
EVENT_TIME = {
    "logs": "time_unix_nano",
    "spans": "start_time_unix_nano",
    "metrics": "time_unix_nano",
    "profiles": "time_unix_nano",
}

# ---------------------------------------------------------------- packets


def _resource(key_value: str) -> str:
    return f"STRUCT<attributes:ARRAY<{key_value}>, droppedAttributesCount:INT, entityRefs:ARRAY<{ENTITY}>>"


def _scope(key_value: str) -> str:
    return f"STRUCT<name:STRING, version:STRING, attributes:ARRAY<{key_value}>, droppedAttributesCount:INT>"


def _tree(scopes: str, records: str, record: str, key_value: str = KEY_VALUE) -> str:
    """resource[] -> scope[] -> record[], the nesting all signals share."""
    return (
        f"ARRAY<STRUCT<resource:{_resource(key_value)}, schemaUrl:STRING, "
        f"{scopes}:ARRAY<STRUCT<scope:{_scope(key_value)}, schemaUrl:STRING, {records}:ARRAY<{record}>>>>>"
    )


RESOURCE = _resource(KEY_VALUE)
SCOPE = _scope(KEY_VALUE)

LOG_RECORD = (
    "STRUCT<timeUnixNano:BIGINT, observedTimeUnixNano:BIGINT, severityNumber:INT, severityText:STRING, "
    f"body:{ANY_VALUE_INDEXED}, attributes:ARRAY<{KEY_VALUE}>, droppedAttributesCount:INT, flags:INT, "
    "traceId:BINARY, spanId:BINARY, eventName:STRING>"
)
SPAN_RECORD = (
    "STRUCT<traceId:BINARY, spanId:BINARY, traceState:STRING, parentSpanId:BINARY, flags:INT, name:STRING, "
    "kind:STRING, startTimeUnixNano:BIGINT, endTimeUnixNano:BIGINT, "
    f"attributes:ARRAY<{KEY_VALUE}>, droppedAttributesCount:INT, events:ARRAY<{SPAN_EVENT}>, "
    f"droppedEventsCount:INT, links:ARRAY<{SPAN_LINK}>, droppedLinksCount:INT, status:{STATUS}>"
)
_POINT = f"attributes:ARRAY<{KEY_VALUE}>, startTimeUnixNano:BIGINT, timeUnixNano:BIGINT, flags:INT"
NUMBER_POINT = f"STRUCT<{_POINT}, exemplars:ARRAY<{EXEMPLAR}>, asDouble:DOUBLE, asInt:BIGINT>"
HISTOGRAM_POINT = (
    f"STRUCT<{_POINT}, exemplars:ARRAY<{EXEMPLAR}>, count:BIGINT, sum:DOUBLE, bucketCounts:ARRAY<BIGINT>, "
    "explicitBounds:ARRAY<DOUBLE>, min:DOUBLE, max:DOUBLE>"
)
EXP_HISTOGRAM_POINT = (
    f"STRUCT<{_POINT}, exemplars:ARRAY<{EXEMPLAR}>, count:BIGINT, sum:DOUBLE, scale:INT, zeroCount:BIGINT, "
    f"positive:{BUCKETS}, negative:{BUCKETS}, min:DOUBLE, max:DOUBLE, zeroThreshold:DOUBLE>"
)
SUMMARY_POINT = f"STRUCT<{_POINT}, count:BIGINT, sum:DOUBLE, quantileValues:ARRAY<{QUANTILE}>>"

# field of a metric -> (type name of the flat row, schema of its points)
METRIC_KINDS = {
    "gauge": ("GAUGE", NUMBER_POINT),
    "sum": ("SUM", NUMBER_POINT),
    "histogram": ("HISTOGRAM", HISTOGRAM_POINT),
    "exponentialHistogram": ("EXPONENTIAL_HISTOGRAM", EXP_HISTOGRAM_POINT),
    "summary": ("SUMMARY", SUMMARY_POINT),
}
METRIC = (
    f"STRUCT<name:STRING, description:STRING, unit:STRING, metadata:ARRAY<{KEY_VALUE}>, "
    f"gauge:STRUCT<dataPoints:ARRAY<{NUMBER_POINT}>>, "
    f"sum:STRUCT<dataPoints:ARRAY<{NUMBER_POINT}>, aggregationTemporality:STRING, isMonotonic:BOOLEAN>, "
    f"histogram:STRUCT<dataPoints:ARRAY<{HISTOGRAM_POINT}>, aggregationTemporality:STRING>, "
    f"exponentialHistogram:STRUCT<dataPoints:ARRAY<{EXP_HISTOGRAM_POINT}>, aggregationTemporality:STRING>, "
    f"summary:STRUCT<dataPoints:ARRAY<{SUMMARY_POINT}>>>"
)
_VALUE_TYPE_INDEX = "STRUCT<typeStrindex:INT, unitStrindex:INT>"
SAMPLE = (
    "STRUCT<stackIndex:INT, `values`:ARRAY<BIGINT>, attributeIndices:ARRAY<INT>, linkIndex:INT, "
    "timestampsUnixNano:ARRAY<BIGINT>>"
)
PROFILE = (
    "STRUCT<profileId:BINARY, attributeIndices:ARRAY<INT>, droppedAttributesCount:INT, "
    "originalPayloadFormat:STRING, originalPayload:BINARY, timeUnixNano:BIGINT, durationNano:BIGINT, "
    f"periodType:{_VALUE_TYPE_INDEX}, period:BIGINT, sampleType:{_VALUE_TYPE_INDEX}, samples:ARRAY<{SAMPLE}>>"
)
DICTIONARY = (
    "STRUCT<stringTable:ARRAY<STRING>, "
    f"attributeTable:ARRAY<STRUCT<keyStrindex:INT, value:{ANY_VALUE_INDEXED}, unitStrindex:INT>>, "
    "mappingTable:ARRAY<STRUCT<memoryStart:BIGINT, memoryLimit:BIGINT, fileOffset:BIGINT, filenameStrindex:INT, "
    "attributeIndices:ARRAY<INT>>>, "
    "functionTable:ARRAY<STRUCT<nameStrindex:INT, systemNameStrindex:INT, filenameStrindex:INT, "
    "startLine:BIGINT>>, "
    "locationTable:ARRAY<STRUCT<mappingIndex:INT, address:BIGINT, "
    "lines:ARRAY<STRUCT<functionIndex:INT, line:BIGINT, `column`:BIGINT>>, attributeIndices:ARRAY<INT>>>, "
    "stackTable:ARRAY<STRUCT<locationIndices:ARRAY<INT>>>, "
    "linkTable:ARRAY<STRUCT<traceId:BINARY, spanId:BINARY>>>"
)

PACKET_DDL = {
    "logs": f"resourceLogs {_tree('scopeLogs', 'logRecords', LOG_RECORD)}",
    "spans": f"resourceSpans {_tree('scopeSpans', 'spans', SPAN_RECORD)}",
    "metrics": f"resourceMetrics {_tree('scopeMetrics', 'metrics', METRIC)}",
    "profiles": (
        f"resourceProfiles {_tree('scopeProfiles', 'profiles', PROFILE, KEY_VALUE_INDEXED)}, "
        f"dictionary {DICTIONARY}"
    ),
}

# ---------------------------------------------------------------- enums (fixed values of the telemetry protocol)

_SEVERITIES = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")
ENUMS = {
    "kind": ("SPAN_KIND_UNSPECIFIED", "SPAN_KIND_INTERNAL", "SPAN_KIND_SERVER", "SPAN_KIND_CLIENT",
             "SPAN_KIND_PRODUCER", "SPAN_KIND_CONSUMER"),
    "code": ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR"),
    "aggregationTemporality": ("AGGREGATION_TEMPORALITY_UNSPECIFIED", "AGGREGATION_TEMPORALITY_DELTA",
                               "AGGREGATION_TEMPORALITY_CUMULATIVE"),
    # 0, then four steps per level: TRACE, TRACE2, TRACE3, TRACE4, DEBUG, ...
    "severityNumber": ("SEVERITY_NUMBER_UNSPECIFIED",
                       *(f"SEVERITY_NUMBER_{s}{n}" for s in _SEVERITIES for n in ("", "2", "3", "4"))),
}


# ---------------------------------------------------------------- derived schema objects


@lru_cache
def struct(ddl: str) -> T.StructType:
    """The StructType of a DDL text: a list of fields or STRUCT<...> (needs a running session)."""
    return T._parse_datatype_string(ddl)


def flat_schema(signal: str) -> T.StructType:
    return struct(FLAT_DDL[signal])


def packet_schema(signal: str) -> T.StructType:
    return struct(PACKET_DDL[signal])


def camel(name: str) -> str:
    return re.sub(r"_(\w)", lambda m: m.group(1).upper(), name)


def snake(name: str) -> str:
    return re.sub(r"[A-Z]", lambda m: "_" + m.group(0).lower(), name)


# ids that the hex flavour of the JSON encoding writes in hex; other bytes are always base64
ID_FIELDS = ("traceId", "spanId", "parentSpanId", "profileId")


# The signed whole numbers of the protocol; all others are unsigned.
SIGNED = {"int_value", "as_int", "intValue", "asInt", "scale", "offset", "value", "values", "key_strindex", "period"}


def wire_schema(dtype: T.DataType, id_encoding: str = "base64", name: str = "") -> T.DataType:
    """JSON form of a packet type: camelCase names; numbers arrive as text (or as a number, read as text).

    Bytes in base64 are decoded by the JSON parser; hex ids are text.
    """
    if isinstance(dtype, T.StructType):
        return T.StructType([
            T.StructField(camel(f.name), wire_schema(f.dataType, id_encoding, camel(f.name))) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(wire_schema(dtype.elementType, id_encoding, name))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.DoubleType)):
        return T.StringType()
    if isinstance(dtype, T.BinaryType) and id_encoding == "hex" and name in ID_FIELDS:
        return T.StringType()
    return dtype


#: The field names within nested attribute values, which a schema does not reach.
VALUE_FIELDS = ("stringValue", "boolValue", "intValue", "doubleValue", "arrayValue", "kvlistValue", "bytesValue", "stringValueStrindex",
                "values", "key", "keyStrindex", "value")


def field_names(dtype: T.DataType) -> set[str]:
    """The JSON names of all fields of a packet type."""
    if isinstance(dtype, T.ArrayType):
        return field_names(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return {camel(f.name) for f in dtype.fields}.union(VALUE_FIELDS, *[field_names(f.dataType) for f in dtype.fields])
    return set()
