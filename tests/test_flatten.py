"""Cardinality and field mapping of the flatten operators, on the edge packets of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from otelier.functions.anyvalue import attributes_json, text_map
from otelier.operators.attributes import to_json_map
from otelier.operators.flatten import flatten_logs, flatten_metrics, flatten_spans, untyped_metrics
from otelier.operators.packets import ingest_counters, packet_outcome
from otelier.operators.profiles_flatten import BAD_VALUES, flatten_profiles
from otelier.schemas import flat_schema
from tests.helpers import attr, packets, rows_of

LOG = {"timeUnixNano": "5", "body": {"stringValue": "x"}}
GAUGE = {"name": "test-gauge", "gauge": {"dataPoints": [{"asInt": "3"}]}}


def tree(signal, *resources):
    root, scopes, records = {
        "logs": ("resourceLogs", "scopeLogs", "logRecords"), "spans": ("resourceSpans", "scopeSpans", "spans"),
        "metrics": ("resourceMetrics", "scopeMetrics", "metrics"),
    }[signal]
    return {root: [{scopes: [{records: list(s)} for s in r]} for r in resources]}


FLATTEN = {"logs": (flatten_logs, LOG), "spans": (flatten_spans, {"name": "s"}), "metrics": (flatten_metrics, GAUGE)}


@pytest.mark.parametrize("signal", FLATTEN)
def test_edge_packets(spark, signal):
    flatten, record = FLATTEN[signal]
    cases = {
        "no resources": ({}, 0),
        "empty resource": (tree(signal, []), 0),
        "empty scope": (tree(signal, [[]]), 0),
        "one record": (tree(signal, [[record]]), 1),
        "then empty resource": (tree(signal, [[record]], []), 1),
        "then empty scope": (tree(signal, [[record], []]), 1),
        "then both": (tree(signal, [[record], []], []), 1),
        "empties first": (tree(signal, [], [[], [record]]), 1),
    }
    for name, (packet, expected) in cases.items():
        assert flatten(packets(spark, signal, packet)).count() == expected, name
    all_packets = packets(spark, signal, *[p for p, _ in cases.values()])
    assert flatten(all_packets).count() == sum(n for _, n in cases.values())


@pytest.mark.parametrize("signal", FLATTEN)
def test_flat_schema(spark, signal):
    flatten, record = FLATTEN[signal]
    got = flatten(packets(spark, signal, tree(signal, [[record]]))).schema
    assert got.simpleString() == flat_schema(signal).simpleString()


def test_seq_no_runs_across_the_packet(spark):
    record = [LOG, LOG]
    packet = tree("logs", [record, [], record], [], [record])
    assert rows_of(flatten_logs(packets(spark, "logs", packet)), "seq_no") == [(i,) for i in range(6)]


def test_metric_numbering(spark):
    two = {"name": "a", "sum": {"dataPoints": [{"asInt": "1"}, {"asDouble": 2.5}], "isMonotonic": True,
                                "aggregationTemporality": "AGGREGATION_TEMPORALITY_CUMULATIVE"}}
    one = {"name": "b", "summary": {"dataPoints": [{"count": "2", "sum": 3.0}]}}
    packet = tree("metrics", [[{"name": "empty-metric"}, two, {"name": "no-points", "gauge": {"dataPoints": []}}]], [[one]])
    rows = flatten_metrics(packets(spark, "metrics", packet))
    assert rows_of(rows, "seq_no", "datapoint_seq_no", "name", "type") == [
        (1, 0, "a", "SUM"), (1, 1, "a", "SUM"), (2, 0, "b", "SUMMARY")]
    assert rows_of(rows.filter("type = 'SUM'"), "sum_type", "sum_int", "sum_double", "is_monotonic") == [
        ("AS_DOUBLE", 0, 2.5, True), ("AS_INT", 1, 0.0, True)]
    assert rows_of(untyped_metrics(packets(spark, "metrics", packet)), "name") == [("empty-metric",)]


def test_summary_points_are_numbered_from_zero(spark):
    summary = {"name": "s", "summary": {"dataPoints": [{"count": "1"}, {"count": "2"}]}}
    rows = flatten_metrics(packets(spark, "metrics", tree("metrics", [[summary]])))
    assert rows_of(rows, "datapoint_seq_no", "summary_count") == [(0, 1), (1, 2)]


def test_bucket_sizes_decide_validity(spark):
    def hist(counts, bounds):
        return {"name": "h", "histogram": {"dataPoints": [{"count": "3", "bucketCounts": counts, "explicitBounds": bounds}]}}

    cases = [(["1", "2"], [5.0], True), (["1"], [], True), ([], [], True), (["1", "2"], [], False), ([], [5.0], False),
             (["1"], [5.0], False)]
    for counts, bounds, valid in cases:
        row = flatten_metrics(packets(spark, "metrics", tree("metrics", [[hist(counts, bounds)]]))).first()
        assert row["is_valid"] == valid, (counts, bounds)
        assert (row["error_message"] is None) == valid


def test_log_fields(spark):
    packet = {"resourceLogs": [{
        "resource": {"attributes": [attr("resource-attribute", stringValue="test RA")], "droppedAttributesCount": 1},
        "schemaUrl": "http://resource.schema.test",
        "scopeLogs": [{
            "scope": {"name": "scope", "version": "2", "attributes": [attr("scope-attribute", intValue="3")]},
            "schemaUrl": "http://log.schema.test",
            "logRecords": [{}, {}, {
                "timeUnixNano": "5", "observedTimeUnixNano": "6", "severityNumber": "SEVERITY_NUMBER_DEBUG3",
                "severityText": "SEVERITY_DEBUG3", "body": {"stringValue": "test log message"},
                "attributes": [attr("log-attr", boolValue=False)], "traceId": "11", "spanId": "12"}],
        }]}]}
    logs = flatten_logs(packets(spark, "logs", packet))
    row = logs.filter("seq_no = 2").first()
    assert row["time_unix_nano"] == 5 and row["observed_time_unix_nano"] == 6
    assert row["severity_number"] == 7 and row["severity_text"] == "SEVERITY_DEBUG3"
    assert row["body_type"] == "STRING_VALUE" and row["body_string"] == "test log message" and row["body_int"] is None
    assert row["trace_id"] == b"\x11" and row["span_id"] == b"\x12"
    assert row["resource_attributes"][0]["value"]["string_value"] == "test RA"
    assert row["resource_dropped_attributes_count"] == 1
    assert row["resource_schema_url"] == "http://resource.schema.test" and row["log_schema_url"] == "http://log.schema.test"
    assert row["scope_attributes"][0]["value"]["int_value"] == 3
    assert row["attributes"][0]["value"]["bool_value"] is False
    assert row["is_valid"] and row["error_message"] is None
    bare = logs.filter("seq_no = 0").first()
    assert bare["trace_id"] == b"" and bare["attributes"] == [] and bare["body_type"] == "VALUE_NOT_SET"

    import json
    short = json.loads(logs.filter("seq_no = 2").select(to_json_map(logs, "logs")).first()[0])
    assert short["attributes"] == {"log-attr": False} and short["scope_attributes"] == {"scope-attribute": 3}
    assert short["seq_no"] == 2 and short["is_valid"] is True and short["trace_id"] == "EQ=="
    assert "flags" not in short and "body_int" not in short and "error_message" not in short
    filled = json.loads(logs.filter("seq_no = 0").select(to_json_map(logs, "logs", True)).first()[0])
    assert filled["flags"] == 0 and filled["body_double"] == 0.0 and filled["attributes"] == {}
    assert filled["error_message"] == "" and filled["resource_entity_refs"] == [] and filled["body_bool"] is False


BODIES = {
    "STRING_VALUE": ({"stringValue": "s"}, "body_string", "s"),
    "BOOL_VALUE": ({"boolValue": False}, "body_bool", False),
    "INT_VALUE": ({"intValue": "-7"}, "body_int", -7),
    "DOUBLE_VALUE": ({"doubleValue": 0.5}, "body_double", 0.5),
    "ARRAY_VALUE": ({"arrayValue": {"values": [{"intValue": "1"}]}}, "body_array", '{"values":[{"intValue":"1"}]}'),
    "KVLIST_VALUE": ({"kvlistValue": {"values": []}}, "body_kvlist", '{"values":[]}'),
    "BYTES_VALUE": ({"bytesValue": "AQI="}, "body_bytes", b"\x01\x02"),
    "STRING_VALUE_STRINDEX": ({"stringValueStrindex": 1}, None, None),
    "VALUE_NOT_SET": ({}, None, None),
}


@pytest.mark.parametrize("branch", BODIES)
def test_body_branches(spark, branch):
    body, column, value = BODIES[branch]
    row = flatten_logs(packets(spark, "logs", tree("logs", [[{"body": body}]]))).first()
    assert row["body_type"] == branch
    filled = {c: row[c] for c in row.asDict() if c.startswith("body_") and c != "body_type" and row[c] is not None}
    assert {k: bytes(v) if isinstance(v, bytearray) else v for k, v in filled.items()} == ({column: value} if column else {})


def test_default_resource_attributes(spark):
    packet = {"resourceLogs": [
        {"resource": {"attributes": [attr("a", intValue="7"), attr("a", intValue="8")]}, "scopeLogs": [{"logRecords": [LOG]}]},
        {"scopeLogs": [{"logRecords": [LOG]}]}]}
    rows = flatten_logs(packets(spark, "logs", packet), "a=1,b=2=3,c=,d, ,=x")
    maps = [r[0] for r in rows.orderBy("seq_no").select(text_map(F.col("resource_attributes"))).collect()]
    assert maps == [{"a": "8", "b": "2=3", "c": "", "d": None}, {"a": "1", "b": "2=3", "c": "", "d": None}]


PROFILE_PACKET = {
    "dictionary": {
        "stringTable": ["", "main", "app.c", "cpu", "ns", "k", "val"],
        "attributeTable": [{"keyStrindex": 5, "value": {"stringValueStrindex": 6}, "unitStrindex": 4}],
        "mappingTable": [{"filenameStrindex": 2, "memoryStart": "1"}],
        "functionTable": [{"nameStrindex": 1, "filenameStrindex": 2}],
        "locationTable": [{"address": "16", "lines": [{"line": "3"}, {"line": "4"}]}, {"address": "32"}],
        "stackTable": [{"locationIndices": [0, 1]}, {}],
        "linkTable": [{"traceId": "aa", "spanId": "bb"}],
    },
    "resourceProfiles": [{}, {
        "resource": {"attributes": [{"keyStrindex": 5, "value": {"arrayValue": {"values": [
            {"stringValueStrindex": 1}, {"kvlistValue": {"values": [{"keyStrindex": 6, "value": {"stringValueStrindex": 3}}]}}]}}},
            {"key": "literal", "keyStrindex": 1, "value": {"intValue": "1"}}]},
        "scopeProfiles": [{}, {"profiles": [{}, {
            "profileId": "01", "sampleType": {"typeStrindex": 3, "unitStrindex": 4},
            "samples": [
                {},
                {"values": ["1", "2"], "timestampsUnixNano": ["5", "6"], "attributeIndices": [0]},
                {"values": ["1", "2"], "timestampsUnixNano": ["5"], "stackIndex": 1},
                {"values": [9]},
                {"timestampsUnixNano": ["7"]},
            ]}]}]}],
}


def test_profiles(spark):
    rows = flatten_profiles(packets(spark, "profiles", PROFILE_PACKET))
    assert rows.schema.simpleString() == flat_schema("profiles").simpleString()
    assert rows_of(rows, "resource_seq_no", "scope_seq_no", "profile_seq_no", "sample_seq_no", "value_seq_no", "value",
                   "timestamp_unix_nano", "is_valid") == [
        (1, 1, 1, 1, 0, 1, 5, True), (1, 1, 1, 1, 1, 2, 6, True), (1, 1, 1, 2, 0, 1, 5, False),
        (1, 1, 1, 2, 1, 2, None, False), (1, 1, 1, 3, 0, 9, None, True), (1, 1, 1, 4, 0, None, 7, True)]
    row = rows.filter("sample_seq_no = 1").first()
    top, second = row["stack"]
    assert top["address"] == 16 and top["mapping"]["filename"] == "app.c" and top["mapping"]["memory_start"] == 1
    assert [(x["function"]["name"], x["line"]) for x in top["lines"]] == [("main", 3), ("main", 4)]
    assert second["address"] == 32 and second["lines"] == []
    assert (row["attributes"][0]["key"], row["attributes"][0]["value"]["string_value"], row["attributes"][0]["unit"]) == (
        "k", "val", "ns")
    assert row["sample_type"].asDict() == {"type": "cpu", "unit": "ns"} and row["period_type"].asDict() == {"type": "", "unit": ""}
    assert row["trace_id"] == b"\xaa" and row["span_id"] == b"\xbb"
    assert rows.filter("sample_seq_no = 2").first()["stack"] == []
    text = rows.select(attributes_json(F.col("resource_attributes"))).first()[0]
    assert text == '{"k":["main",{"val":"cpu"}],"literal":1}'


def test_no_link_table_no_link(spark):
    packet = {**PROFILE_PACKET, "dictionary": {**PROFILE_PACKET["dictionary"], "linkTable": []}}
    row = flatten_profiles(packets(spark, "profiles", packet)).first()
    assert row["trace_id"] is None and row["span_id"] is None


def test_outcome_and_counters(spark):
    good = {"resourceProfiles": [{"scopeProfiles": [{"profiles": [{"samples": [{"values": [1]}]}]}]}]}
    rows = flatten_profiles(packets(spark, "profiles", PROFILE_PACKET, good))
    outcome = packet_outcome(rows, "profiles")
    assert rows_of(outcome, "rows", "rejected", "error_message") == [(1, 0, None), (6, 2, BAD_VALUES)]
    assert tuple(ingest_counters(outcome, "profiles").first()) == ("profiles", 7, 2, 1, 1)


def test_counts_on_the_side(spark):
    from pyspark.sql import Observation

    from otelier.operators.flatten import observe_metrics_packets
    from otelier.operators.packets import observe_rows

    packet = tree("metrics", [[{"name": "no type"}, GAUGE, {"name": "none either"}]], [[GAUGE]])
    before, after = Observation("packets"), Observation("rows")
    seen = observe_metrics_packets(packets(spark, "metrics", packet, {}), before)
    assert len(observe_rows(flatten_metrics(seen), after).collect()) == 2
    assert before.get == {"packets": 2, "untyped_metrics": 2}
    assert after.get == {"request_items": 2, "dropped_request_items": 0}
