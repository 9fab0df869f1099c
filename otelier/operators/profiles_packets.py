"""Flat profile rows back to packets: the dictionary of each packet is built again from what its rows hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from otelier.functions.expressions import let, place_in, search_steps, sorted_table
from otelier.operators.flatten import RESOURCE_COLUMNS, SCOPE_COLUMNS
from otelier.operators.profiles_flatten import PROFILE_COLUMNS
from otelier.schemas import (
    ANY_VALUE_INDEXED, DICTIONARY, KEY_VALUE_INDEXED, KEY_VALUE_UNIT, LINEAGE, PROFILE, SAMPLE, packet_schema,
)

_PACKET = ["batch_timestamp", "batch_UUID"]
_PLACES = list(LINEAGE["profiles"])[2:]
_SAMPLE_COLUMNS = ("stack", "attributes", "trace_id", "span_id")
_OUTER = (*RESOURCE_COLUMNS, *SCOPE_COLUMNS, "profile_schema_url", *PROFILE_COLUMNS)


def _samples(rows: DataFrame) -> DataFrame:
    """One row per sample, copies dropped, with the number of its stack among the distinct ones of the packet."""
    copy = Window.partitionBy("batch_UUID", *_PLACES).orderBy(_PLACES[-1])
    once = rows.repartition("batch_UUID").withColumn("_copy", F.row_number().over(copy)).filter("_copy = 1")
    samples = once.groupBy(*_PACKET, *_PLACES[:-1]).agg(
        F.sort_array(F.collect_list(F.struct("value_seq_no", "value", "timestamp_unix_nano"))).alias("points"),
        F.first(F.struct(*_SAMPLE_COLUMNS, *_OUTER)).alias("_first"))
    # all that is made of the samples refers to both lists of columns as wholes (no sample is without a point), so that it
    # shares one exchange of the rows; with columns pruned differently the rows would be computed once for each
    samples = samples.filter(F.size("points") > 0).select(
        *_PACKET, *_PLACES[:-1], "points", *[F.col(f"_first.{c}").alias(c) for c in (*_SAMPLE_COLUMNS, *_OUTER)])
    return samples.withColumn("stack_no", F.dense_rank().over(Window.partitionBy("batch_UUID").orderBy("stack")) - 1)


def _stacks_and_locations(samples: DataFrame) -> DataFrame:
    """Per packet its distinct stacks, as lists of location numbers, and its distinct locations, each in order of its number."""
    first = Window.partitionBy("batch_UUID", "stack_no").orderBy("sample_seq_no")
    stacks = samples.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    frames = stacks.select("batch_UUID", "stack_no", F.posexplode_outer("stack").alias("pos", "at"))
    number = F.dense_rank().over(Window.partitionBy("batch_UUID").orderBy(F.col("at").isNull(), "at")) - 1
    frames = frames.withColumn("number", F.when(F.col("at").isNull(), -1).otherwise(number))
    seen = Window.partitionBy("batch_UUID", "number").orderBy("stack_no", "pos")
    frames = frames.withColumn("_new", (F.row_number().over(seen) == 1) & (F.col("number") >= 0))
    per_stack = frames.groupBy("batch_UUID", "stack_no").agg(
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "number")))).alias("frames"),
        F.collect_list(F.when(F.col("_new"), F.struct("number", "at"))).alias("locations"))
    return per_stack.groupBy("batch_UUID").agg(
        F.sort_array(F.collect_list(F.struct("stack_no", F.transform("frames", lambda f: f["number"]).alias("indices")))).alias("stacks"),
        F.array_sort(F.flatten(F.collect_list("locations")), lambda a, b: a["number"] - b["number"]).alias("locations"))


def _filled(items: Column, place: str, build: Callable[[Column], Column], kind: str) -> Column:
    """Nodes in order of their place; places that gave no rows become empty nodes."""
    nothing = F.lit(None).cast(kind)

    def node(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(items, i - 1)[place], F.lit(-1))
        return F.concat(F.array_repeat(nothing, x[place] - before - 1), F.array(build(x).cast(kind)))

    return F.flatten(F.transform(items, node))


def _at(table: Column, x: Column) -> Column:
    """The number of an entry in its table, which is sorted, -1 (which is no entry) for null."""
    return F.coalesce(place_in(table, F.col("steps"), x), F.lit(-1))


def _indices(table: Column, entries: Column) -> Column:
    return F.transform(entries, lambda x: _at(table, x))


def deflatten_profiles(rows: DataFrame) -> DataFrame:
    """Rebuild profile packets from their rows: `flatten_profiles` of the result gives the rows again.

    Strings, attributes, functions, mappings, locations, stacks and links that are equal within a packet become one entry
    of its dictionary. Stacks and locations are numbered by windows over the packet, on the one exchange by packet id; the
    other tables are sorted and searched by halves. Nodes of a packet that gave no rows come back empty; copies of a row (a packet read
    twice) are dropped. Groups are no larger than a packet and its copies.
    """
    samples = _samples(rows)
    sample = F.struct("sample_seq_no", "stack_no", "points", "attributes", "trace_id", "span_id")
    profiles = samples.groupBy(*_PACKET, "resource_seq_no", "scope_seq_no", "profile_seq_no").agg(
        F.sort_array(F.collect_list(sample)).alias("samples"), *[F.first(c).alias(c) for c in _OUTER])
    profile = F.struct("profile_seq_no", "samples", *PROFILE_COLUMNS)
    scopes = profiles.groupBy(*_PACKET, "resource_seq_no", "scope_seq_no").agg(
        F.sort_array(F.collect_list(profile)).alias("profiles"),
        *[F.first(c).alias(c) for c in (*RESOURCE_COLUMNS, *SCOPE_COLUMNS, "profile_schema_url")])
    scope = F.struct("scope_seq_no", "profiles", *SCOPE_COLUMNS, "profile_schema_url")
    resources = scopes.groupBy(*_PACKET, "resource_seq_no").agg(
        F.sort_array(F.collect_list(scope)).alias("scopes"), *[F.first(c).alias(c) for c in RESOURCE_COLUMNS])
    packets = resources.groupBy(*_PACKET).agg(
        F.sort_array(F.collect_list(F.struct("resource_seq_no", "scopes", *RESOURCE_COLUMNS))).alias("resources"))

    # lists of attributes and links repeat from sample to sample: each once, by hash
    link = F.when(F.col("trace_id").isNotNull() | F.col("span_id").isNotNull(), F.struct(F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId")))
    shared = samples.groupBy("batch_UUID").agg(
        F.collect_set("attributes").alias("of_samples"), F.collect_set("profile_attributes").alias("of_profiles"),
        F.sort_array(F.collect_set(link)).alias("links"),
        F.collect_set(F.struct("period_type.type", "period_type.unit")).alias("periods"),
        F.collect_set(F.struct("sample_type.type", "sample_type.unit")).alias("types"))
    whole = packets.join(shared, "batch_UUID").join(_stacks_and_locations(samples), "batch_UUID")
    whole = whole.withColumn("locations", F.transform("locations", lambda l: l["at"]))

    whole = whole.withColumns({
        "mappings": sorted_table(F.transform("locations", lambda l: l["mapping"])),
        "functions": sorted_table(F.flatten(F.transform("locations", lambda l: F.transform(l["lines"], lambda n: n["function"]))))})
    no_list = F.array().cast(f"array<{KEY_VALUE_UNIT}>")
    listed = F.concat(F.col("of_samples"), F.col("of_profiles"), F.transform("locations", lambda l: F.coalesce(l["attributes"], no_list)),
                      F.transform("mappings", lambda m: F.coalesce(m["attributes"], no_list)))
    whole = whole.withColumn("attributes", sorted_table(F.flatten(listed)))
    texts = F.concat(
        F.array(F.lit("")), F.transform("attributes", lambda a: a["key"]), F.transform("attributes", lambda a: a["unit"]),
        F.transform("mappings", lambda m: m["filename"]), *[F.transform("functions", _field(c)) for c in ("name", "system_name", "filename")],
        *[F.transform(v, _field(c)) for v in ("periods", "types") for c in ("type", "unit")])
    whole = whole.withColumn("strings", sorted_table(texts))
    whole = whole.withColumn("steps", search_steps(F.greatest(*[F.size(t) for t in ("strings", "attributes", "functions", "mappings", "links")])))
    return whole.select(*_PACKET, _resources().alias("resourceProfiles"), _dictionary().cast(DICTIONARY).alias("dictionary"))


def _field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def _dictionary() -> Column:
    strings, attributes = F.col("strings"), F.col("attributes")
    return F.struct(
        strings.alias("stringTable"),
        F.transform(attributes, lambda a: F.struct(
            _at(strings, a["key"]).alias("k"), _indexed_value(a["value"]).alias("v"), _at(strings, a["unit"]).alias("u"))).alias("attributeTable"),
        F.transform("mappings", lambda m: F.struct(
            m["memory_start"], m["memory_limit"], m["file_offset"], _at(strings, m["filename"]), _indices(attributes, m["attributes"]))).alias("mappingTable"),
        F.transform("functions", lambda f: F.struct(
            _at(strings, f["name"]), _at(strings, f["system_name"]), _at(strings, f["filename"]), f["start_line"])).alias("functionTable"),
        F.transform("locations", lambda l: F.struct(
            _at(F.col("mappings"), l["mapping"]), l["address"],
            F.transform(l["lines"], lambda n: F.struct(_at(F.col("functions"), n["function"]), n["line"], n["column"])),
            _indices(attributes, l["attributes"]))).alias("locationTable"),
        F.transform("stacks", lambda s: F.struct(s["indices"])).alias("stackTable"),
        F.col("links").alias("linkTable"))


def _indexed_value(v: Column) -> Column:
    fields = [v[f].alias(f) for f in ("string_value", "bool_value", "int_value", "double_value", "array_value", "kvlist_value", "bytes_value")]
    return F.when(v.isNotNull(), F.struct(*fields, F.lit(None).cast("int").alias("string_value_strindex"))).cast(ANY_VALUE_INDEXED)


def _indexed_list(attributes: Column) -> Column:
    """Attributes of a resource or scope: literal keys and texts."""
    return F.transform(attributes, lambda a: F.struct(
        a["key"].alias("key"), F.lit(None).cast("int").alias("key_strindex"), _indexed_value(a["value"]).alias("value"))).cast(f"array<{KEY_VALUE_INDEXED}>")


def _resources() -> Column:
    strings, attributes, links = F.col("strings"), F.col("attributes"), F.col("links")
    resource_type = packet_schema("profiles")["resourceProfiles"].dataType.elementType
    scope_type = resource_type["scopeProfiles"].dataType.elementType

    def sample(s: Column) -> Column:
        linked = s["trace_id"].isNotNull() | s["span_id"].isNotNull()
        link = F.when(linked, F.struct(s["trace_id"].alias("traceId"), s["span_id"].alias("spanId")))
        numbers = lambda f: F.filter(F.transform(s["points"], lambda p: p[f]), lambda x: x.isNotNull())
        return F.struct(s["stack_no"], numbers("value"), _indices(attributes, s["attributes"]), _at(links, link), numbers("timestamp_unix_nano"))

    def value_type(v: Column) -> Column:
        return F.struct(_at(strings, v["type"]), _at(strings, v["unit"]))

    def profile(p: Column) -> Column:
        return F.struct(
            p["profile_id"], _indices(attributes, p["profile_attributes"]), p["profile_dropped_attributes_count"], p["original_payload_format"],
            p["original_payload"], p["time_unix_nano"], p["duration_nano"], value_type(p["period_type"]), p["period"], value_type(p["sample_type"]),
            let(p["samples"], lambda items: _filled(items, "sample_seq_no", sample, SAMPLE)))

    def scope(s: Column) -> Column:
        return F.struct(
            F.struct(s["scope_name"], s["scope_version"], _indexed_list(s["scope_attributes"]), s["scope_dropped_attributes_count"]),
            s["profile_schema_url"], let(s["profiles"], lambda items: _filled(items, "profile_seq_no", profile, PROFILE)))

    def resource(r: Column) -> Column:
        return F.struct(
            F.struct(_indexed_list(r["resource_attributes"]), r["resource_dropped_attributes_count"], r["resource_entity_refs"]),
            r["resource_schema_url"], let(r["scopes"], lambda items: _filled(items, "scope_seq_no", scope, scope_type.simpleString())))

    return _filled(F.col("resources"), "resource_seq_no", resource, resource_type.simpleString())
