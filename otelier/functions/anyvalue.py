"""Expressions over attribute lists (ARRAY<key, value>) and their union-typed values.

All are built-in Spark expressions on the row; none shuffles or leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from otelier.functions.expressions import no_items, typed_struct
from otelier.functions.nested import json_scalar, plain_dict, plain_list, resolve_nested
from otelier.schemas import ANY_VALUE, KEY_VALUE

# Fixed texts that stand for values too complex to compare as text.
LIST_VALUE_TEXT = "ignoring attribute list value"
DICT_VALUE_TEXT = "ignoring attribute dict value"

# branch of the value -> its name in `body_type`
BRANCHES = {
    "string_value": "STRING_VALUE",
    "bool_value": "BOOL_VALUE",
    "int_value": "INT_VALUE",
    "double_value": "DOUBLE_VALUE",
    "array_value": "ARRAY_VALUE",
    "kvlist_value": "KVLIST_VALUE",
    "bytes_value": "BYTES_VALUE",
    "string_value_strindex": "STRING_VALUE_STRINDEX",
}


def make_value(branch: str | None = None, value: Column | None = None) -> Column:
    """An attribute value with one branch set (or none)."""
    return typed_struct(ANY_VALUE, **({branch: value} if branch else {}))


def make_attribute(key: Column | str, branch: str, value: Column) -> Column:
    return typed_struct(KEY_VALUE, key=F.lit(key) if isinstance(key, str) else key, value=make_value(branch, value))


def value_branch(v: Column) -> Column:
    """Name of the branch that is set, VALUE_NOT_SET if none is."""
    fields = list(BRANCHES.items())
    branch = F.when(v[fields[0][0]].isNotNull(), fields[0][1])
    for field, name in fields[1:]:
        branch = branch.when(v[field].isNotNull(), name)
    return branch.otherwise("VALUE_NOT_SET")


def any_value(v: Column) -> Column:
    """A value as one text: bytes in base64, scalars as they are, lists and dicts as a fixed text."""
    return F.coalesce(
        F.base64(v["bytes_value"]),
        F.when(v["kvlist_value"].isNotNull(), DICT_VALUE_TEXT),
        F.when(v["array_value"].isNotNull(), LIST_VALUE_TEXT),
        scalar_text(v),
    )


def scalar_text(v: Column) -> Column:
    """A scalar value as text; null for lists, dicts and bytes."""
    return F.coalesce(
        v["double_value"].cast("string"),
        v["int_value"].cast("string"),
        v["bool_value"].cast("string"),
        v["string_value"],
    )


def last_value(attributes: Column, key: str) -> Column:
    """The value struct of one key without building a map: the last occurrence wins."""
    return F.try_element_at(F.filter(attributes, lambda kv: kv["key"] == key), F.lit(-1))["value"]


def text_map(attributes: Column, render=any_value) -> Column:
    """Attribute list -> MAP<key, rendered value>, as text by default; the last duplicate of a key wins."""
    return F.map_from_entries(
        F.transform(attributes, lambda kv: F.struct(F.coalesce(kv["key"], F.lit("")), render(kv["value"])))
    )


def scalar_map(attributes: Column) -> Column:
    """Attribute list -> MAP<key, text> where nested values are null, as a scalar JSON path lookup gives."""
    return text_map(attributes, scalar_text)


# ---------------------------------------------------------------- nested values


def _nested_json(v: Column) -> list[Column]:
    """JSON of the list and the dict branch, without the type wrappers of the wire form."""
    return [F.when(v["array_value"].isNotNull(), plain_list(v["array_value"])),
            F.when(v["kvlist_value"].isNotNull(), plain_dict(v["kvlist_value"]))]


def any_json(v: Column) -> Column:
    """A value as JSON: native scalars, plain lists and objects, bytes in base64, `null` if unset."""
    return F.coalesce(
        json_scalar(v["string_value"]), v["bool_value"].cast("string"), v["int_value"].cast("string"),
        json_scalar(v["double_value"]), *_nested_json(v), json_scalar(F.base64(v["bytes_value"])), F.lit("null"),
    )


def native_text(v: Column) -> Column:
    """A value as text: scalars unquoted, lists and dicts as JSON, bytes in base64, null if unset."""
    return F.coalesce(scalar_text(v), *_nested_json(v), F.base64(v["bytes_value"]))


def to_map(attributes: Column) -> Column:
    """Attribute list -> MAP<key, text> with nested values as JSON text; the last duplicate wins."""
    return text_map(attributes, native_text)


def any_variant(v: Column) -> Column:
    """A value as VARIANT: native scalars, plain lists and objects, bytes in base64, null if unset."""
    nested = [F.when(v[f].isNotNull(), F.parse_json(plain(v[f], exponents=True)))
              for f, plain in (("array_value", plain_list), ("kvlist_value", plain_dict))]
    scalars = [v[f].cast(T.VariantType()) for f in ("string_value", "bool_value", "int_value", "double_value")]
    return F.coalesce(*scalars, *nested, F.base64(v["bytes_value"]).cast(T.VariantType()))


def variant_map(attributes: Column) -> Column:
    """Attribute list -> MAP<key, VARIANT>; the last duplicate of a key wins."""
    return text_map(attributes, any_variant)


def attributes_json(attributes: Column) -> Column:
    """Attribute list -> JSON object text with native value types; the keys of nested dicts come in alphabetical order."""
    return F.to_json(variant_map(attributes))


# ---------------------------------------------------------------- string indices


def resolve_text(strings: Column, index: Column) -> Column:
    return F.get(strings, F.coalesce(index, F.lit(0)))


def resolve_key(key: Column, index: Column, strings: Column) -> Column:
    """A literal key wins over an index."""
    return F.coalesce(F.nullif(key, F.lit("")), resolve_text(strings, index))


def resolve_value(v: Column, strings: Column) -> Column:
    """A value whose texts may be indices into `strings`, at any depth, as a plain value."""

    def nested(text: Column) -> Column:
        return F.when(text.contains("trindex"), resolve_nested(text, strings)).otherwise(text)

    return F.when(
        v.isNotNull(),
        F.struct(
            F.coalesce(v["string_value"],
                       F.when(v["string_value_strindex"].isNotNull(), F.get(strings, v["string_value_strindex"])))
            .alias("string_value"),
            *[v[f].alias(f) for f in ("bool_value", "int_value", "double_value")],
            nested(v["array_value"]).alias("array_value"),
            nested(v["kvlist_value"]).alias("kvlist_value"),
            v["bytes_value"].alias("bytes_value"),
        ),
    )


def resolve_attributes(attributes: Column, strings: Column) -> Column:
    """Key-value list with indexed keys and texts -> plain key-value list."""
    return F.transform(
        attributes,
        lambda kv: F.struct(
            resolve_key(kv["key"], kv["key_strindex"], strings).alias("key"),
            resolve_value(kv["value"], strings).alias("value"),
        ),
    )


# ---------------------------------------------------------------- defaults


def with_defaults(attributes: Column, defaults: str) -> Column:
    """Add the attributes of `k=v,k2=,k3` that are missing; received values win, blank keys are ignored.

    `k2=` is an empty text, `k3` without `=` has no value, and a value may itself hold `=`.
    """
    pairs = [item.split("=", 1) for item in defaults.split(",") if item.strip()]
    pairs = [p for p in pairs if p[0].strip()]
    if not pairs:
        return attributes
    added = F.array(*[
        typed_struct(KEY_VALUE, key=F.lit(p[0]),
                     value=make_value("string_value", F.lit(p[1])) if len(p) > 1 else make_value())
        for p in pairs
    ])
    # a received attribute without key has the key ""
    received = F.transform(F.coalesce(attributes, no_items(KEY_VALUE)), lambda kv: kv.withField("key", F.coalesce(kv["key"], F.lit(""))))
    return F.map_entries(F.map_from_entries(F.concat(added, received)))

