"""Nested attribute values of any depth against a recursive version."""

import json
import random

import pytest
from pyspark.sql import functions as F

from otelier.functions.anyvalue import any_json, attributes_json, make_value, to_map
from otelier.functions.nested import plain_dict, plain_list, resolve_nested

TEXTS = ["x", "", 'quote " \\ end\\', "[a,{b}]", "},{", ',"key":"k"', "{", "null", "ü\n\t", 'a":{"values":[', " €", "true"]


def wire(rng, depth):
    """A wire value that nests up to `depth` levels."""
    kind = rng.choice(["stringValue", "boolValue", "intValue", "doubleValue", "bytesValue", "none"] + ["arrayValue", "kvlistValue"] * 3)
    if kind in ("arrayValue", "kvlistValue"):
        if not depth:
            return {kind: {}}
        items = [wire(rng, depth - 1) for _ in range(rng.randrange(4))]
        if kind == "kvlistValue":
            items = [{"key": rng.choice(TEXTS + ["k1", "k2", "k3"]), "value": x} for x in items]
            if items and rng.random() < 0.2:
                items.append(rng.choice([{}, {"key": "k9"}, {"value": {"intValue": "1"}}]))
        return {kind: {"values": items} if items or rng.random() < 0.5 else {}}
    value = {"stringValue": rng.choice(TEXTS), "boolValue": rng.random() < 0.5, "intValue": rng.choice(["-5", 7]), "doubleValue": rng.choice([1.5, -2.0]),
             "bytesValue": "QUI="}
    return {} if kind == "none" else {kind: value[kind]}


def plain(v):
    for kind, x in v.items():
        if kind == "arrayValue":
            return [plain(i) for i in x.get("values", [])]
        if kind == "kvlistValue":
            return {i.get("key", ""): plain(i.get("value", {})) for i in x.get("values", [])}
        return int(x) if kind == "intValue" else x
    return None


def compact(x):
    return json.dumps(x, separators=(",", ":"), ensure_ascii=False)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(11)
    found = [wire(rng, n % 7) for n in range(400)]
    found = [v for v in found if v.keys() & {"arrayValue", "kvlistValue"}]
    straight = {"stringValue": "deep"}
    for n in range(30):  # thirty levels
        straight = {"arrayValue": {"values": [straight]}} if n % 3 else {"kvlistValue": {"values": [{"key": "k", "value": straight}]}}
    wide = {"arrayValue": {"values": [{"arrayValue": {"values": [{"intValue": str(i)}]}} for i in range(2000)]}}
    return [*found, straight, wide, {"arrayValue": {"values": [{"stringValue": 'a"' * 20_000}]}}]


def test_plain_values(spark, values):
    rows = [(n, compact(v["arrayValue"]) if "arrayValue" in v else None, compact(v["kvlistValue"]) if "kvlistValue" in v else None)
            for n, v in enumerate(values)]
    df = spark.createDataFrame(rows, "n int, a string, k string").repartition(4)
    got = {r["n"]: r["a"] or r["k"] for r in df.select("n", plain_list(F.col("a")).alias("a"), plain_dict(F.col("k")).alias("k")).collect()}
    for n, v in enumerate(values):
        assert json.loads(got[n]) == plain(v), (v, got[n])


def test_values_in_attributes(spark, values):
    """Inside a list of attributes, where expressions are lambdas."""
    nested = [v for v in values if "kvlistValue" in v][:40]
    df = spark.createDataFrame([(n, compact(v["kvlistValue"])) for n, v in enumerate(nested)], "n int, k string")
    attributes = F.array(F.struct(F.lit("a").alias("key"), make_value("kvlist_value", F.col("k")).alias("value")),
                         F.struct(F.lit("b").alias("key"), make_value("int_value", F.col("n")).alias("value")))
    for r in df.select("n", attributes_json(attributes).alias("j"), to_map(attributes).alias("m"), any_json(make_value()).alias("none")).collect():
        want = plain(nested[r["n"]])
        assert json.loads(r["j"]) == {"a": want, "b": r["n"]} and json.loads(r["m"]["a"]) == want and r["none"] == "null"


def indexed(v, strings, rng):
    """The same value with some texts as indices."""
    if isinstance(v, list):
        return [indexed(x, strings, rng) for x in v]
    if not isinstance(v, dict):
        return v
    out = {}
    for k, x in v.items():
        if k in ("stringValue", "key") and rng.random() < 0.7:
            strings.append(x)
            out["stringValueStrindex" if k == "stringValue" else "keyStrindex"] = len(strings) - 1
        else:
            out[k] = indexed(x, strings, rng)
    return out


def test_indices_at_every_level(spark, values):
    rng, rows = random.Random(3), []
    for n, v in enumerate(values):
        strings = [""]
        text = compact(indexed(v, strings, rng))
        rows.append((n, text, strings))
    df = spark.createDataFrame(rows, "n int, t string, s array<string>")
    for r in df.select("n", resolve_nested(F.col("t"), F.col("s")).alias("t")).collect():
        assert json.loads(r["t"]) == values[r["n"]]


def test_odd_texts(spark):
    cases = {'{"values":[{"stringValueStrindex":3}]}': [None], "{}": [], '{"values":null}': [], '{"values":[{"doubleValue":"NaN"},{"doubleValue":1}]}': ["NaN", 1.0],
             '{"values":[{"intValue":null},{"kvlistValue":{"values":[{"key":"a","value":null},{"value":{"intValue":1},"key":"a"}]}}]}': [None, {"a": 1}]}
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    got = {r[0]: r[1] for r in df.select("t", plain_list(F.col("t"))).collect()}
    assert got.pop(None) is None
    assert {t: json.loads(x) for t, x in got.items()} == cases
