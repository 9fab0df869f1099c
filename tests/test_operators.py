"""Operators on small hand-made tables, checked against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from otelier.functions.anyvalue import any_value, attributes_json, last_value, to_map
from otelier.functions.expressions import number_text, running_totals
from otelier.functions.histograms import bucket_labels, exp_hist_buckets, hist_buckets
from otelier.functions import series as functions_series
from otelier.functions.series import with_previous
from otelier.operators.attributes import (
    attribute_keys, drop_empty_columns, drop_empty_rows, fill_blank, json_value, native_types, split_columns,
    to_number, widen,
)
from otelier.operators.flatten import flatten_logs, flatten_metrics
from otelier.operators.metrics import (
    first_session, hist_explode, hist_interval_mean, hist_stat_delta, metric_exploded, session_gaps, sum_delta,
    sum_delta_naive, value_delta, with_emitter,
)
from otelier.operators.profiles import prof_frames, stack_id
from otelier.operators.relational import dedup_rows, dedup_subset, log_span_join
from otelier.operators.traces import span_parent
from tests.helpers import attr, packets, rows_of


def test_running_totals(spark):
    df = spark.createDataFrame([([3, 0, 2],), ([],)], "n array<int>")
    assert [r[0] for r in df.select(running_totals(F.col("n"))).collect()] == [[0, 3, 3], []]


@pytest.mark.parametrize("x", [0.0, 5.0, -2.5, 0.25, 999.125, 9999999.0, 1e7, 12345678.5, 123456789012.0, 1e15,
                               1e16, 2.5e17, 1e300, 0.001, 0.0001, 0.00012, 0.00001, 2.5e-7, -1e8, 1e-300])
def test_number_text_is_the_shortest_decimal(spark, x):
    got = spark.createDataFrame([(x,)], "x double").select(number_text(F.col("x"))).first()[0]
    assert got == repr(x)


def test_bucket_labels(spark):
    schema = StructType([StructField("b", ArrayType(DoubleType()))])
    df = spark.createDataFrame([([],), (None,), ([0.0],), ([0.0, 5.0],), ([0.0, 5.0, 1e7],)], schema)
    assert [r[0] for r in df.select(bucket_labels(F.col("b"))).collect()] == [
        [], [], ["lt_0.0", "gt_0.0"], ["lt_0.0", "0.0-5.0", "gt_5.0"],
        ["lt_0.0", "0.0-5.0", "5.0-10000000.0", "gt_10000000.0"]]


def test_hist_buckets(spark):
    df = spark.createDataFrame(
        [([1, 2], [5.0]), ([3], []), ([], []), ([1], [5.0])], "c array<bigint>, b array<double>")
    got = [r[0] and [tuple(x) for x in r[0]] for r in df.select(hist_buckets(F.col("c"), F.col("b"))).collect()]
    assert got == [[(None, 5.0, 1), (5.0, None, 2)], [(None, None, 3)], None, None]


def test_exp_hist_buckets(spark):
    buckets = "struct<offset:int,bucket_counts:array<bigint>>"
    df = spark.createDataFrame([(0, (1, [7, 8]), (0, [9])), (1, (0, [1]), None), (-1, (-1, [2]), None)],
                               f"s int, p {buckets}, n {buckets}")
    got = [[tuple(x) for x in r[0]] for r in df.select(exp_hist_buckets(F.col("s"), F.col("p"), F.col("n"))).collect()]
    assert got[0] == [(-2.0, -1.0, 9), (2.0, 4.0, 7), (4.0, 8.0, 8)]
    assert got[1] == [(1.0, pytest.approx(2 ** 0.5), 1)]
    assert got[2] == [(0.25, 1.0, 2)]


ATTRIBUTES = [
    attr("s", stringValue='q"\\'), attr("b", boolValue=True), attr("i", intValue="7"), attr("d", doubleValue=2.5),
    attr("l", arrayValue={"values": [{"stringValue": "a]"}, {"intValue": "1"}, {}, {"arrayValue": {"values": [{"boolValue": False}]}}]}),
    attr("m", kvlistValue={"values": [{"key": "x", "value": {"doubleValue": 0.5}}, {"key": "x", "value": {"intValue": "2"}}]}),
    attr("y", bytesValue="AQI="), {"key": "none"}, attr("dup", intValue="1"), attr("dup", stringValue="last"),
]


def test_attribute_values(spark):
    logs = flatten_logs(packets(spark, "logs", {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"attributes": ATTRIBUTES}]}]}]}))
    as_json = json.loads(logs.select(attributes_json(F.col("attributes"))).first()[0])
    assert as_json == {"s": 'q"\\', "b": True, "i": 7, "d": 2.5, "l": ["a]", 1, None, [False]], "m": {"x": 2},
                       "y": "AQI=", "none": None, "dup": "last"}
    as_map = logs.select(to_map(F.col("attributes"))).first()[0]
    assert as_map["s"] == 'q"\\' and as_map["i"] == "7" and as_map["b"] == "true" and as_map["none"] is None
    assert json.loads(as_map["l"]) == ["a]", 1, None, [False]] and json.loads(as_map["m"]) == {"x": 2}
    wide = widen(logs, "attributes", keys=[a["key"] for a in ATTRIBUTES[:8]] + ["dup", "absent"]).first()
    assert wide["a_l"] == "ignoring attribute list value" and wide["a_m"] == "ignoring attribute dict value"
    assert (wide["a_s"], wide["a_b"], wide["a_i"], wide["a_d"], wide["a_y"], wide["a_none"], wide["a_dup"], wide["a_absent"]) == (
        'q"\\', "true", "7", "2.5", "AQI=", None, "last", None)
    assert logs.select(any_value(last_value(F.col("attributes"), "dup"))).first()[0] == "last"
    assert rows_of(attribute_keys(logs, "attributes"), "key") == sorted({(a["key"],) for a in ATTRIBUTES}, key=repr)
    found = widen(logs, "attributes", [r["key"] for r in attribute_keys(logs, "attributes").collect()])
    assert sorted(c for c in found.columns if c.startswith("a_")) == sorted({"a_" + a["key"] for a in ATTRIBUTES})


def test_json_value_is_scalar_only(spark):
    df = spark.createDataFrame([('{"a.b":"x","c":{"d":1},"e":[1],"f":5}',)], "j string")
    got = df.select(*[json_value(F.col("j"), k) for k in ("a.b", "c", "e", "f", "g")]).first()
    assert tuple(got) == ("x", None, None, "5", None)


def test_untyped_columns(spark):
    df = spark.createDataFrame([("1", None, "x"), ("bad", None, None), (None, None, None)], "`a.n` string, b int, c string")
    assert drop_empty_columns(df).columns == ["a.n", "c"]
    assert drop_empty_rows(df).count() == 2
    assert rows_of(fill_blank(df), "`a.n`", "b", "c") == [("", None, ""), ("1", None, "x"), ("bad", None, "")]
    assert rows_of(df, to_number(F.col("`a.n`"))) == [(1.0,), (None,), (None,)]
    assert native_types(df, {"a.n": "bigint", "b": "string"}).dtypes == [("a.n", "bigint"), ("b", "string"), ("c", "string")]


def test_split_columns():
    dims, measures = split_columns("metrics")
    assert len(measures) == 17 and "histogram" in dims and "sum_int" not in dims and "name" in dims
    dims, measures = split_columns("metrics", dimensions=("sum_int",), exclusions=("gauge_int",))
    assert dims == ["sum_int"] and "sum_int" not in measures and "gauge_int" not in measures and len(measures) == 15
    dims, measures = split_columns("profiles", exclusions=("period", "batch_UUID"), metrics=("value_seq_no",))
    assert measures == ["duration_nano", "value", "value_seq_no"]
    assert not {"period", "batch_UUID", "value_seq_no"} & set(dims)


# ---------------------------------------------------------------- series


def expected_previous(rows, series, time):
    out, before = {}, {}
    for r in sorted(rows, key=lambda r: (r[time], r["v"])):
        k = tuple(r[s] for s in series)
        out[r["id"]] = before.get(k)
        before[k] = (r[time], r["v"])
    return out


@pytest.mark.parametrize("ranges,drawn", [(1, 40), (2, 40), (7, 3), (40, 1), (300, 2), (None, 40)])
def test_previous_point_does_not_depend_on_ranges(spark, monkeypatch, ranges, drawn):
    monkeypatch.setattr(functions_series, "DRAWN", drawn)
    random.seed(4)
    # a hot series with most points, ties in time, a null key, and sparse series that skip slices
    rows = [{"id": i, "k": random.choice(["hot"] * 6 + ["a", "b", None]), "t": random.choice([0, 3, *range(0, 900, 11)]),
             "v": random.randint(0, 10 ** 6)} for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, t bigint, v bigint")
    got = with_previous(df, ["k"], "t", ["v"], ranges).collect()
    assert {r["id"]: r["_previous"] and tuple(r["_previous"]) for r in got} == expected_previous(rows, ["k"], "t")
    assert len(got) == len(rows)


def test_large_inputs_are_cut_into_ranges(spark, monkeypatch):
    df = spark.range(500).selectExpr("id % 2 AS k", "id AS t", "id AS v")
    assert "_range" not in with_previous(df, ["k"], "t", ["v"])._jdf.queryExecution().toString()
    monkeypatch.setattr(functions_series, "ONE_TASK", 100)
    cut = with_previous(df, ["k"], "t", ["v"])
    assert "_range" in cut._jdf.queryExecution().toString() and cut.where("_previous.v = v - 2").count() == 498


def sums(spark, rows):
    return spark.createDataFrame(rows, "emitter string, start_time_unix_nano bigint, time_unix_nano bigint, sum_int bigint")


def test_sum_delta_respects_resets(spark):
    df = sums(spark, [("e", 1, 10, 5), ("e", 1, 20, 9), ("e", 30, 40, 2), ("e", 30, 50, 8), ("f", 1, 10, 7)])
    assert rows_of(sum_delta(df), "emitter", "time_unix_nano", "sum_delta") == [
        ("e", 10, 5), ("e", 20, 4), ("e", 40, 2), ("e", 50, 6), ("f", 10, 7)]
    assert rows_of(sum_delta_naive(df), "emitter", "time_unix_nano", "sum_delta") == [
        ("e", 10, 5), ("e", 20, 4), ("e", 40, -7), ("e", 50, 6), ("f", 10, 7)]
    assert rows_of(first_session(df), "emitter", "time_unix_nano") == [("e", 10), ("e", 20), ("f", 10)]
    assert rows_of(session_gaps(df, ["emitter"]), "emitter", "start_time_unix_nano", "previous_start", "gap_nanos", "points") == [
        ("e", 30, 1, 20, 2)]


METRICS = {"resourceMetrics": [{"resource": {"attributes": [attr("service.name", stringValue="svc")]}, "scopeMetrics": [
    {"scope": {"name": "lib"}, "metrics": [
        {"name": "g", "gauge": {"dataPoints": [{"asInt": "3", "timeUnixNano": "1"}, {"asDouble": 1.5, "timeUnixNano": "2"}]}},
        {"name": "h", "histogram": {"dataPoints": [
            {"count": "4", "sum": 10, "min": 1, "max": 5, "bucketCounts": ["1", "3"], "explicitBounds": [2.0], "startTimeUnixNano": "1", "timeUnixNano": "5"},
            {"count": "4", "sum": 10, "min": 1, "max": 5, "bucketCounts": ["1", "3"], "explicitBounds": [2.0], "startTimeUnixNano": "1", "timeUnixNano": "6"},
            {"count": "6", "sum": 20, "min": 1, "max": 9, "bucketCounts": ["1", "5"], "explicitBounds": [2.0], "startTimeUnixNano": "1", "timeUnixNano": "7"},
            {"count": "1", "sum": 2, "bucketCounts": ["1"], "startTimeUnixNano": "8", "timeUnixNano": "9"}]}},
    ]}]}]}


def test_histograms(spark):
    rows = with_emitter(flatten_metrics(packets(spark, "metrics", METRICS)))
    assert {r["emitter"] for r in rows.select("emitter").collect()} == {"lib@svc"}
    exploded = hist_explode(rows, ["emitter", "start_time_unix_nano", "time_unix_nano"])
    assert rows_of(exploded.filter("time_unix_nano = 5"), "population_stat", "value") == [
        ("count", 4.0), ("gt_2.0", 3.0), ("lt_2.0", 1.0), ("max", 5.0), ("min", 1.0), ("sum", 10.0)]
    # a single count without bounds has no bucket labels
    assert rows_of(exploded.filter("time_unix_nano = 9"), "population_stat") == [("count",), ("max",), ("min",), ("sum",)]
    deltas = hist_stat_delta(exploded, ["emitter"])
    assert rows_of(deltas.filter("population_stat = 'gt_2.0'"), "time_unix_nano", "value_delta") == [(5, 3.0), (6, 0.0), (7, 2.0)]
    means = hist_interval_mean(rows, ["emitter"])
    assert rows_of(means, "time_unix_nano", "interval_mean") == [(5, 2.5), (6, None), (7, 5.0), (9, 2.0)]


def test_exploded_values_and_deltas(spark):
    rows = with_emitter(flatten_metrics(packets(spark, "metrics", METRICS))).select(
        "emitter", "name", "type", "start_time_unix_nano", "time_unix_nano", "gauge_type", "gauge_int", "gauge_double",
        "sum_type", "sum_int", "sum_double", "histogram_count", "histogram_sum", "histogram_min", "histogram_max",
        "histogram_bucket_counts", "histogram_explicit_bounds")
    exploded = metric_exploded(rows)
    assert exploded.count() == 2 + 3 * 6 + 4
    got = value_delta(exploded)
    assert rows_of(got.filter("name = 'g'"), "time_unix_nano", "value", "value_delta", "prev_time_unix_nano") == [
        (1, 3.0, 3.0, 0), (2, 1.5, -1.5, 1)]
    assert rows_of(got.filter("population_stat = 'count'"), "time_unix_nano", "value_delta", "prev_time_unix_nano") == [
        (5, 4.0, 0), (6, 0.0, 5), (7, 2.0, 6), (9, 1.0, 0)]


# ---------------------------------------------------------------- relational and traces


def test_dedup_rows_with_maps(spark):
    df = spark.createDataFrame([("x", {"a": "1", "b": "2"}), ("x", {"b": "2", "a": "1"}), ("y", {})], "n string, m map<string,string>")
    assert rows_of(dedup_rows(df), "n", "m") == [
        ("x", '[{"key":"a","value":"1"},{"key":"b","value":"2"}]'), ("y", "[]")]


def test_dedup_subset_keeps_one_deterministic_row(spark):
    rows = [("n", 5, i) for i in (9, 3, 7)] * 50 + [("m", None, 1), ("m", None, None)]
    df = spark.createDataFrame(rows, "name string, t bigint, sum_int bigint").repartition(8)
    assert rows_of(dedup_subset(df), "name", "t", "sum_int") == [("m", None, None), ("n", 5, 3)]


def test_join_and_parents_skip_unset_ids(spark):
    spans = spark.createDataFrame(
        [(b"t", b"1", b"", "root"), (b"t", b"2", b"1", "child"), (b"t", b"2", b"1", "child"), (b"u", b"3", b"1", "lost"),
         (b"t", b"", b"", "no id")], "trace_id binary, span_id binary, parent_span_id binary, name string")
    logs = spark.createDataFrame([(b"t", b"1", "a"), (b"t", b"", "b"), (b"", b"", "c"), (b"u", b"1", "d")],
                                 "trace_id binary, span_id binary, body string")
    assert rows_of(log_span_join(logs, spans), "body", "name") == [("a", "root")]
    assert rows_of(span_parent(spans, ["name"]), "name", "parent_name") == [
        ("child", "root"), ("child", "root"), ("lost", None), ("no id", None), ("root", None)]


def test_frames(spark):
    from otelier.schemas import LOCATION

    def frame(address, *lines):
        return ((0, 0, 0, "m", []), address, [((n, "", "f", 0), i, 0) for i, n in lines], [])

    df = spark.createDataFrame(
        [(1, [frame(16, (3, "leaf"), (4, "inlined")), frame(None), frame(48, (9, "main"))]), (2, [])],
        f"id int, stack array<{LOCATION}>")
    got = prof_frames(df, ["id"]).select(
        "`location.address`", "`location.line_0.function.name`", "`location.line_0.line`", "stacktrace_len",
        "stacktrace_max_depth", "stacktrace_depth")
    assert [tuple(r) for r in got.collect()] == [(16, "leaf", 3, 2, 1, 1), (None, None, None, 2, 1, 0), (48, "main", 9, 2, 1, -1)]
    ids = df.unionByName(df).select(stack_id(F.col("stack"))).distinct()
    assert ids.count() == 2
