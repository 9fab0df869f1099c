"""Packets as Python dicts -> typed packets."""

import json

from otelier.sources.packets import parse_packets


def packets(spark, signal, *objects, id_encoding="hex"):
    rows = [(f"p{i}", o if isinstance(o, str) else json.dumps(o), 1000 + i) for i, o in enumerate(objects)]
    raw = spark.createDataFrame(rows, "position string, payload string, batch_timestamp bigint")
    return parse_packets(raw, signal, id_encoding)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def attr(key, **value):
    return {"key": key, "value": value}
