"""Reading packets: JSON flavours, rejection, ids; and rows back to packets."""

import json
import re

import pytest
from pyspark.sql import functions as F

from otelier.functions.anyvalue import attributes_json
from otelier.operators.flatten import flatten_logs, flatten_metrics, flatten_spans
from otelier.operators.packets import deflatten
from otelier.plans import fixtures
from otelier.plans.fixtures import encode_packets
from otelier.sources.flat import FLATTEN, read_signal
from otelier.sources.packets import accepted, read_packets, rejected
from tests.helpers import packets, rows_of

SPAN = {"resourceSpans": [{"scopeSpans": [{"spans": [
    {"traceId": "0a0B", "spanId": "01", "kind": 2, "status": {"code": "STATUS_CODE_ERROR", "message": "m"}},
    {"kind": "SPAN_KIND_CLIENT", "startTimeUnixNano": 1720000000123456789},
    {"startTimeUnixNano": "not a number"}]}]}]}


def test_ids_enums_and_numbers(spark):
    rows = flatten_spans(packets(spark, "spans", SPAN))
    assert rows_of(rows, F.hex("trace_id"), "kind", "status.code", "start_time_unix_nano") == [
        ("", "SPAN_KIND_CLIENT", "STATUS_CODE_UNSET", 1720000000123456789),
        ("", "SPAN_KIND_UNSPECIFIED", "STATUS_CODE_UNSET", 0),
        ("0A0B", "SPAN_KIND_SERVER", "STATUS_CODE_ERROR", 0)]


def test_base64_ids(spark):
    packet = {"resourceSpans": [{"scopeSpans": [{"spans": [{"traceId": "CgsM"}]}]}]}
    assert flatten_spans(packets(spark, "spans", packet, id_encoding="base64")).first()["trace_id"] == b"\x0a\x0b\x0c"


def test_rejected_packets(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([('{"resourceSpans": [',), ("{}",), ('{"resourceSpans": 5}',),
                           ('{"resourceSpans":[{"scopeSpans":[{"spans":[{"name":"x"}]}]}]}',)], "value string"
                          ).coalesce(1).write.text(path)
    read = read_packets(spark, "spans", path)
    assert rows_of(rejected(read), "corrupt_record") == [('{"resourceSpans": 5}',), ('{"resourceSpans": [',)]
    assert accepted(read).count() == 2
    assert rows_of(read_signal(spark, "spans", "raw", path), "name") == [("x",)]


def test_packet_ids_do_not_change_between_runs(spark, tmp_path, sf):
    path = str(tmp_path / "in")
    encode_packets(fixtures.log_packets(spark, sf), "logs").write.text(path)
    first, second = (rows_of(read_packets(spark, "logs", path), "batch_UUID") for _ in range(2))
    assert first == second and len(set(first)) == len(first)


def text(df):
    """Rows as text, in any order."""
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*df.columns))).collect())


@pytest.mark.parametrize("signal,direct", [("logs", fixtures.logs), ("spans", fixtures.spans)])
def test_rows_by_way_of_packets_equal_direct_rows(spark, sf, signal, direct):
    lineage = ("batch_timestamp", "batch_UUID", "seq_no")
    assert text(FLATTEN[signal](fixtures.PACKETS[signal](spark, sf)).drop(*lineage)) == text(
        direct(spark, sf).drop(*lineage))


@pytest.mark.parametrize("signal", fixtures.PACKETS)
def test_json_packets_give_the_same_rows(spark, sf, tmp_path, signal):
    sent = fixtures.PACKETS[signal](spark, sf)
    path = str(tmp_path / "in")
    encode_packets(sent, signal).write.text(path)
    drop = ("batch_timestamp", "batch_UUID")
    assert text(read_signal(spark, signal, "raw", path).drop(*drop)) == text(FLATTEN[signal](sent).drop(*drop))


@pytest.mark.parametrize("signal", ["logs", "spans", "metrics", "profiles"])
def test_deflatten_is_the_inverse(spark, sf, signal):
    rows = FLATTEN[signal](fixtures.PACKETS[signal](spark, sf)).cache()
    try:
        again = FLATTEN[signal](deflatten(rows.unionByName(rows), signal))
        assert text(again) == text(rows)
    finally:
        rows.unpersist()  # plans are shared with other tests


def test_deflatten_keeps_resources_and_scopes_apart(spark):
    def log(n):
        return {"timeUnixNano": str(n), "body": {"intValue": str(n)}}

    packet = {"resourceLogs": [
        {"resource": {"attributes": [{"key": "r", "value": {"intValue": "1"}}]},
         "scopeLogs": [{"scope": {"name": "a"}, "logRecords": [log(1), log(2)]}, {"scope": {"name": "b"}, "logRecords": [log(3)]}]},
        {"resource": {"attributes": [{"key": "r", "value": {"intValue": "2"}}]},
         "scopeLogs": [{"scope": {"name": "a"}, "logRecords": [log(4)]}]}]}
    rows = flatten_logs(packets(spark, "logs", packet))
    rebuilt = deflatten(rows, "logs").first()["resourceLogs"]
    assert [[len(s["logRecords"]) for s in r["scopeLogs"]] for r in rebuilt] == [[2, 1], [1]]
    assert text(flatten_logs(deflatten(rows, "logs"))) == text(rows)


def test_deflatten_keeps_the_order_of_repeated_nodes(spark):
    def scope(name, n):
        return {"scope": {"name": name}, "logRecords": [{"timeUnixNano": str(n)}]}

    def resource(*found):
        return {"resource": {"attributes": [{"key": "r", "value": {"intValue": "1"}}]}, "scopeLogs": list(found)}

    packet = {"resourceLogs": [resource(scope("a", 1), scope("b", 2), scope("a", 3))]}
    rows = flatten_logs(packets(spark, "logs", packet))
    rebuilt = deflatten(rows, "logs").first()["resourceLogs"]
    assert [[s["scope"]["name"] for s in r["scopeLogs"]] for r in rebuilt] == [["a", "b", "a"]]
    assert text(flatten_logs(deflatten(rows, "logs"))) == text(rows)


def test_copies_that_arrived_later_are_dropped(spark):
    """A packet read twice has two arrival times; it stays one packet, whole."""
    log = lambda n: {"timeUnixNano": str(n)}
    rows = flatten_logs(packets(spark, "logs", {"resourceLogs": [{"scopeLogs": [{"logRecords": [log(n) for n in range(50)]}]}]}))
    later = rows.withColumn("batch_timestamp", F.col("batch_timestamp") + 5)
    for both in (rows.unionByName(later), later.unionByName(rows)):
        found = deflatten(both.repartition(3), "logs").collect()
        assert [r["batch_timestamp"] for r in found] == [1000]
        assert [int(r["timeUnixNano"]) for r in found[0]["resourceLogs"][0]["scopeLogs"][0]["logRecords"]] == list(range(50))


def test_content_hash_without_lineage(spark):
    both = packets(spark, "metrics", {"resourceMetrics": [{"scopeMetrics": [{"metrics": [
        {"name": "a", "gauge": {"dataPoints": [{"asInt": 1}]}}]}]}]}).drop("batch_UUID", "batch_timestamp", "corrupt_record")
    row = flatten_metrics(both).first()
    assert len(row["batch_UUID"]) == 32 and row["batch_timestamp"] > 1_600_000_000_000


def test_equal_lines_are_packets_of_their_own(spark, tmp_path):
    from otelier.operators.packets import packet_outcome

    path = str(tmp_path / "in")
    line = '{"resourceLogs": [{"resource": {"attributes": [{"value": {"stringValue": "x"}}]}, "scopeLogs": [{"logRecords": [{"flags": 4294967295}]}]}]}'
    spark.createDataFrame([(line,), (line,)], "value string").coalesce(1).write.text(path)
    rows = read_signal(spark, "logs", "raw", path, default_resource_attributes="a=b")
    assert packet_outcome(rows, "logs").count() == 2
    assert deflatten(rows, "logs").count() == 2
    row = rows.first()
    # unsigned numbers wrap around; an attribute without key has the key ""
    assert row["flags"] == -1
    assert {kv["key"]: kv["value"]["string_value"] for kv in row["resource_attributes"]} == {"": "x", "a": "b"}


def test_unsigned_numbers_wrap(spark):
    packet = {"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "a", "sum": {"dataPoints": [
        {"timeUnixNano": str(2 ** 63 + 5), "asInt": "-7"}, {"timeUnixNano": "1e3", "asInt": "9223372036854775807"}]}}]}]}]}
    rows = flatten_metrics(packets(spark, "metrics", packet).drop("corrupt_record"))
    assert rows_of(rows, "time_unix_nano", "sum_int") == [(-(2 ** 63) + 5, -7), (1000, 2 ** 63 - 1)]


# ---------------------------------------------------------------- names and forms of the JSON encoding


def snake(x):
    if isinstance(x, list):
        return [snake(i) for i in x]
    if isinstance(x, dict):
        return {re.sub("[A-Z]", lambda m: "_" + m[0].lower(), k): snake(v) for k, v in x.items()}
    return x


LOG = {"resourceLogs": [{"resource": {"attributes": [{"key": "service.name", "value": {"stringValue": "a_b"}}], "droppedAttributesCount": 2},
                         "schemaUrl": "u", "scopeLogs": [{"scope": {"name": "s", "version": "1"}, "logRecords": [
                             {"timeUnixNano": "17", "severityNumber": 9, "body": {"doubleValue": "1.5"}, "traceId": "0a", "attributes": [
                                 {"key": "k", "value": {"arrayValue": {"values": [{"intValue": "3"}, {"kvlistValue": {"values": [
                                     {"key": "not_a_field", "value": {"stringValue": '"snake_case": 1'}}]}}]}}}]}]}]}]}


def test_both_spellings_of_field_names(spark):
    seen = []
    for packet in (LOG, snake(LOG)):
        rows = flatten_logs(packets(spark, "logs", packet))
        seen.append(rows_of(rows.drop("batch_UUID"), "time_unix_nano", "severity_number", "body_double", "resource_dropped_attributes_count",
                            F.to_json("attributes"), F.to_json("resource_attributes"), "resource_schema_url", F.hex("trace_id")))
        text = rows.select(attributes_json(F.col("attributes"))).first()[0]
        assert json.loads(text) == {"k": [3, {"not_a_field": '"snake_case": 1'}]}
    assert seen[0] == seen[1] and seen[0][0][:4] == (17, 9, 1.5, 2)


@pytest.mark.parametrize("packet,good", [
    ({"resourceLogz": []}, False), ({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"colour": 1}]}]}]}, False),
    ({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"arrayValue": {"values": [{"textValue": "x"}]}}}]}]}]}, False),
    ({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"stringValue": "x"}, "attributes": [
        {"key": ",", "value": {"stringValue": ':\\"x": {"colour":'}}, {"key": "{", "value": {"stringValue": "y" * 100_000}}]}]}]}]}, True),
    ({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"doubleValue": "1.5"}}, {"body": {"doubleValue": "-Infinity"}}]}]}]}, True),
    ({"resourceLogs": [], "resource_logs": []}, True), ({}, True)])
def test_unknown_fields_are_rejected(spark, packet, good):
    read = packets(spark, "logs", packet)
    assert (accepted(read).count(), rejected(read).count()) == ((1, 0) if good else (0, 1))
    if not good:
        assert rejected(read).first()["corrupt_record"] == json.dumps(packet)


def test_names_in_lists_of_texts(spark):
    """Texts next to each other in a list can look like fields."""
    packet = {"resourceProfiles": [], "dictionary": {"stringTable": ["x,", ":z", "{", '":', "a", ":", "string_table"]}}
    read = packets(spark, "profiles", packet)
    assert accepted(read).select("dictionary.stringTable").first()[0] == packet["dictionary"]["stringTable"]
    assert accepted(packets(spark, "profiles", snake(packet))).select("dictionary.stringTable").first()[0] == packet["dictionary"]["stringTable"]


def test_numbers_as_texts(spark):
    point = {"asDouble": "2.5", "attributes": [{"key": "a", "value": {"doubleValue": "NaN"}}]}
    hist = {"count": "3", "sum": "7.25", "bucketCounts": ["1", 2], "explicitBounds": ["0.5"], "max": "Infinity"}
    packet = {"resourceMetrics": [{"scopeMetrics": [{"metrics": [{"name": "g", "gauge": {"dataPoints": [point]}}, {"name": "h", "histogram": {"dataPoints": [hist]}}]}]}]}
    rows = flatten_metrics(packets(spark, "metrics", packet))
    assert rows_of(rows, "name", "gauge_double", "histogram_sum", "histogram_max", "histogram_explicit_bounds", "histogram_bucket_counts") == [
        ("g", 2.5, None, None, [], []), ("h", None, 7.25, float("inf"), [0.5], [1, 2])]


def test_profile_packets_are_rebuilt(spark):
    """Shared and missing entries, nodes without rows, lists of unequal length, missing links and mappings."""
    strings = ["", "main", "read", "a.c", "thread", "ns", "cpu", "env"]
    locations = [{"mappingIndex": 0, "address": 16, "lines": [{"functionIndex": 0, "line": 3}, {"functionIndex": 1, "line": 4}], "attributeIndices": [0]},
                 {"mappingIndex": 9, "address": 32, "lines": [{"functionIndex": 1}]}, {"address": 16, "lines": []}]
    samples = [{"stackIndex": 0, "values": [1, 2], "attributeIndices": [0, 1], "linkIndex": 0, "timestampsUnixNano": [7]},
               {}, {"stackIndex": 1, "values": [5], "linkIndex": 1}, {"stackIndex": 0, "timestampsUnixNano": [8, 9], "linkIndex": 7},
               {"stackIndex": 2, "values": [4], "attributeIndices": [1, 9]}]
    profile = {"profileId": "0a", "sampleType": {"typeStrindex": 6, "unitStrindex": 5}, "periodType": {"typeStrindex": 6}, "period": 10, "samples": samples,
               "attributeIndices": [1]}
    packet = {"resourceProfiles": [
        {}, {"resource": {"attributes": [{"key": "host", "value": {"intValue": "3"}}, {"keyStrindex": 7, "value": {"stringValueStrindex": 1}}]}, "schemaUrl": "u",
             "scopeProfiles": [{"profiles": []}, {"scope": {"name": "s"}, "profiles": [{}, profile, {**profile, "profileId": "0b"}]}]}],
        "dictionary": {"stringTable": strings, "functionTable": [{"nameStrindex": 1, "filenameStrindex": 3}, {"nameStrindex": 2, "startLine": 5}],
                       "attributeTable": [{"keyStrindex": 4, "value": {"stringValueStrindex": 1}, "unitStrindex": 5}, {"keyStrindex": 7, "value": {"boolValue": True}}],
                       "mappingTable": [{"memoryStart": 1, "filenameStrindex": 3, "attributeIndices": [1]}], "locationTable": locations,
                       "stackTable": [{"locationIndices": [0, 1]}, {"locationIndices": [2, 0, 0, 9]}, {}],
                       "linkTable": [{"traceId": "01", "spanId": "02"}, {"traceId": "03", "spanId": "04"}]}}
    rows = FLATTEN["profiles"](packets(spark, "profiles", packet, json.dumps({"resourceProfiles": []}), packet))
    assert rows.count() == 2 * 12
    again = deflatten(rows.unionByName(rows), "profiles")
    assert text(FLATTEN["profiles"](again)) == text(rows)
    tables = again.select("dictionary.*").first()
    assert {n: len(tables[n]) for n in tables.asDict()} == {
        "stringTable": 8, "attributeTable": 2, "mappingTable": 1, "functionTable": 2, "locationTable": 3, "stackTable": 3, "linkTable": 2}


def test_names_in_camel_case_are_not_rewritten(spark):
    """Only a packet with other than known names is looked through for names in snake_case, which costs a pass over its text."""
    plan = packets(spark, "logs", {"resourceLogs": []})._jdf.queryExecution().optimizedPlan().toString()
    known, snake_case = plan.find("(?:(?:"), plan.find("_[a-z0-9]++")
    assert 0 < known < snake_case
    texts = [{"resourceLogs": [{"schemaUrl": s}]} for s in ('a_b": 1', '\\"', "", 'x\\', '"snake_case":', "a\nb")]
    for spell in (lambda x: x, snake):
        read = packets(spark, "logs", *[spell(t) for t in texts])
        assert rejected(read).count() == 0
        found = rows_of(read, F.get("resourceLogs", F.lit(0))["schemaUrl"])
        assert found == sorted(((t["resourceLogs"][0]["schemaUrl"],) for t in texts), key=repr)
    bad = [*[spell({"resourceLogs": [{"schemaUrl": "", "colour_red": 1}]}) for spell in (lambda x: x, snake)], '{"resourceLogs": [],', '{"resourceLogs: []}']
    assert rejected(packets(spark, "logs", *bad)).count() == 4
