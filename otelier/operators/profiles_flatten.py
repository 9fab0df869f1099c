"""Profile packets to flat rows: the tables of a packet's dictionary travel with its samples, which are resolved few at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from otelier.functions.anyvalue import resolve_attributes, resolve_text, resolve_value, with_defaults
from otelier.functions.expressions import compute_once, explode_level, let, or_empty
from otelier.operators.flatten import RESOURCE_COLUMNS, SCOPE_COLUMNS, flat_row, with_lineage
from otelier.schemas import KEY_VALUE_UNIT, LOCATION

#: Samples that are resolved together: their stacks are what a row holds at once, beside the dictionary.
CHUNK = 64
BAD_VALUES = "a profile sample has a different number of values than of timestamps"


def _pick(indices: Column, table: Column, ddl: str) -> Column:
    """The table entries at some indices; a missing list is empty."""
    return F.coalesce(F.transform(indices, lambda i: F.get(table, i)), F.array().cast(f"array<{ddl}>"))


def _index(i: Column) -> Column:
    return F.coalesce(i, F.lit(0))


def _attributes(dictionary: Column, strings: Column) -> Column:
    return F.transform(or_empty(dictionary["attributeTable"]), lambda a: F.struct(
        resolve_text(strings, a["keyStrindex"]).alias("key"),
        resolve_value(a["value"], strings).alias("value"),
        resolve_text(strings, a["unitStrindex"]).alias("unit"),
    ))


def _functions(dictionary: Column, strings: Column) -> Column:
    return F.transform(or_empty(dictionary["functionTable"]), lambda f: F.struct(
        resolve_text(strings, f["nameStrindex"]).alias("name"),
        resolve_text(strings, f["systemNameStrindex"]).alias("system_name"),
        resolve_text(strings, f["filenameStrindex"]).alias("filename"),
        F.coalesce(f["startLine"], F.lit(0)).alias("start_line"),
    ))


def _mappings(dictionary: Column, strings: Column, attributes: Column) -> Column:
    return F.transform(or_empty(dictionary["mappingTable"]), lambda m: F.struct(
        F.coalesce(m["memoryStart"], F.lit(0)).alias("memory_start"),
        F.coalesce(m["memoryLimit"], F.lit(0)).alias("memory_limit"),
        F.coalesce(m["fileOffset"], F.lit(0)).alias("file_offset"),
        resolve_text(strings, m["filenameStrindex"]).alias("filename"),
        _pick(m["attributeIndices"], attributes, KEY_VALUE_UNIT).alias("attributes"),
    ))


def _locations(dictionary: Column, mappings: Column, functions: Column, attributes: Column) -> Column:
    return F.transform(or_empty(dictionary["locationTable"]), lambda l: F.struct(
        F.get(mappings, _index(l["mappingIndex"])).alias("mapping"),
        F.coalesce(l["address"], F.lit(0)).alias("address"),
        F.transform(or_empty(l["lines"]), lambda n: F.struct(
            F.get(functions, _index(n["functionIndex"])).alias("function"),
            F.coalesce(n["line"], F.lit(0)).alias("line"),
            F.coalesce(n["column"], F.lit(0)).alias("column"),
        )).alias("lines"),
        _pick(l["attributeIndices"], attributes, KEY_VALUE_UNIT).alias("attributes"),
    ))


def _sample(s: Column, tables: Column) -> Column:
    # no link table: no link; otherwise index 0 is an entry like any other
    link = F.when(F.size(or_empty(tables["links"])) > 0, F.get(tables["links"], _index(s["linkIndex"])))
    values = F.coalesce(s["values"], F.array().cast("array<bigint>"))
    times = F.coalesce(s["timestampsUnixNano"], F.array().cast("array<bigint>"))
    unequal = (F.size(values) > 0) & (F.size(times) > 0) & (F.size(values) != F.size(times))
    return F.struct(
        _pick(F.get(tables["stacks"], _index(s["stackIndex"]))["locationIndices"], tables["locations"], LOCATION).alias("stack"),
        _pick(s["attributeIndices"], tables["attributes"], KEY_VALUE_UNIT).alias("attributes"),
        link["traceId"].alias("trace_id"),
        link["spanId"].alias("span_id"),
        F.arrays_zip(values.alias("value"), times.alias("timestamp")).alias("values"),
        unequal.alias("unequal"),
    )


def _tables(dictionary: Column) -> Column:
    """The dictionary with attributes and locations resolved, each once. Stacks stay lists of indices: resolved, they would
    repeat their locations."""
    strings = dictionary["stringTable"]

    def struct(attributes: Column, locations: Column) -> Column:
        return F.struct(strings.alias("strings"), attributes.alias("attributes"), locations.alias("locations"),
                        or_empty(dictionary["stackTable"]).alias("stacks"), dictionary["linkTable"].alias("links"))

    return let(_attributes(dictionary, strings), lambda attributes: let(
        _functions(dictionary, strings), lambda functions: let(
            _mappings(dictionary, strings, attributes), lambda mappings: let(
                _locations(dictionary, mappings, functions, attributes), lambda locations: struct(attributes, locations)))))


PROFILE_COLUMNS = ("profile_id", "profile_attributes", "profile_dropped_attributes_count",
                   "original_payload_format", "original_payload", "time_unix_nano", "duration_nano",
                   "period_type", "period", "sample_type")


def _profile_columns(p: Column, tables: Column) -> list[Column]:
    def value_type(v: Column) -> Column:
        return F.struct(
            resolve_text(tables["strings"], v["typeStrindex"]).alias("type"),
            resolve_text(tables["strings"], v["unitStrindex"]).alias("unit"),
        )

    columns = (p["profileId"], _pick(p["attributeIndices"], tables["attributes"], KEY_VALUE_UNIT), p["droppedAttributesCount"],
               p["originalPayloadFormat"], p["originalPayload"], p["timeUnixNano"], p["durationNano"],
               value_type(p["periodType"]), p["period"], value_type(p["sampleType"]))
    return [c.alias(name) for name, c in zip(PROFILE_COLUMNS, columns)]


def _fields(struct: str, names) -> list[Column]:
    return [F.col(f"{struct}.{n}") for n in names]


def flatten_profiles(packets: DataFrame, default_resource_attributes: str | None = None) -> DataFrame:
    """One row per sample value. The five positions count from 0 in their parent, empty parents included.

    Values and timestamps of a sample are paired by position and one list may be empty. Lists of unequal length
    give rows that are marked invalid. Stacks are resolved for `CHUNK` samples at a time, so no row holds those of a
    whole packet.
    """
    head = ["batch_timestamp", "batch_UUID"]
    dictionary = let(F.col("dictionary"), _tables)
    resources = explode_level(
        compute_once(with_lineage(packets), [*head, "resourceProfiles"], dictionary, "_d"), [*head, "_d"], "resourceProfiles", "resource_seq_no", "_r")

    head += ["resource_seq_no"]
    tables = F.col("_d")
    received = resolve_attributes(F.col("_r.resource.attributes"), tables["strings"])
    if default_resource_attributes:
        received = with_defaults(received, default_resource_attributes)
    resources = resources.select(
        *head, "_d", received.alias("resource_attributes"),
        F.col("_r.resource.droppedAttributesCount").alias("resource_dropped_attributes_count"),
        F.col("_r.resource.entityRefs").alias("resource_entity_refs"), F.col("_r.schemaUrl").alias("resource_schema_url"),
        F.col("_r.scopeProfiles").alias("_scopes"))
    head += RESOURCE_COLUMNS
    scopes = explode_level(resources, [*head, "_d"], "_scopes", "scope_seq_no", "_s")

    scopes = scopes.select(
        *head, "_d", "scope_seq_no", F.col("_s.scope.name").alias("scope_name"), F.col("_s.scope.version").alias("scope_version"),
        resolve_attributes(F.col("_s.scope.attributes"), tables["strings"]).alias("scope_attributes"),
        F.col("_s.scope.droppedAttributesCount").alias("scope_dropped_attributes_count"),
        F.col("_s.schemaUrl").alias("profile_schema_url"), F.col("_s.profiles").alias("_profiles"))
    head += ["scope_seq_no", *SCOPE_COLUMNS, "profile_schema_url"]
    profiles = explode_level(scopes, [*head, "_d"], "_profiles", "profile_seq_no", "_p")

    head += ["profile_seq_no"]
    starts = F.sequence(F.lit(1), F.greatest(F.size(or_empty(F.col("_p.samples"))), F.lit(1)), F.lit(CHUNK))
    chunks = F.transform(starts, lambda i: F.slice("_p.samples", i, F.lit(CHUNK)))
    profiles = profiles.select(*head, "_d", *_profile_columns(F.col("_p"), tables), chunks.alias("_chunks"))
    head += PROFILE_COLUMNS
    chunked = explode_level(profiles, [*head, "_d"], "_chunks", "_chunk_no", "_chunk")

    chunked = chunked.select(*head, "_chunk_no", let(tables, lambda d: F.transform("_chunk", lambda s: _sample(s, d))).alias("_samples"))
    samples = explode_level(chunked, [*head, "_chunk_no"], "_samples", "_in_chunk", "_sample")

    sample_fields = ["stack", "attributes", "trace_id", "span_id", "unequal"]
    samples = samples.select(
        *head, (F.col("_chunk_no") * CHUNK + F.col("_in_chunk")).alias("sample_seq_no"), *_fields("_sample", sample_fields),
        F.col("_sample.values").alias("_values"))
    head += ["sample_seq_no", *sample_fields]
    values = explode_level(samples, head, "_values", "value_seq_no", "_value")

    known = {c: F.col(c) for c in (*head, "value_seq_no") if c != "unequal"}
    return values.select(*flat_row("profiles", {
        **known,
        "value": F.col("_value.value"),
        "timestamp_unix_nano": F.col("_value.timestamp"),
        "is_valid": ~F.col("unequal"),
        "error_message": F.when(F.col("unequal"), BAD_VALUES),
    }))
