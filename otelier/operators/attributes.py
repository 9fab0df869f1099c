"""Operators on attribute columns and on columns of uncertain type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from otelier.functions.anyvalue import scalar_map, text_map, variant_map
from otelier.functions.expressions import column, default_for
from otelier.schemas import NULLABLE, flat_schema

# prefix of the wide columns made from an attribute column
PREFIXES = {"resource_attributes": "ra_", "scope_attributes": "sa_", "attributes": "a_", "profile_attributes": "pa_"}

# The columns of a flat row that are measures unless the caller makes them dimensions.
MEASURES = {
    "logs": (),
    "spans": (),
    "metrics": (
        "gauge_double", "gauge_int", "sum_double", "sum_int", "histogram_count", "histogram_sum", "histogram_min",
        "histogram_max", "exponential_histogram_count", "exponential_histogram_sum", "exponential_histogram_scale",
        "exponential_histogram_zero_count", "exponential_histogram_min", "exponential_histogram_max",
        "exponential_histogram_zero_threshold", "summary_count", "summary_sum",
    ),
    "profiles": ("duration_nano", "period", "value"),
}
# columns that hist_buckets and exp_hist_buckets add to metrics
EXTRACTED = {"metrics": ("histogram", "exponential_histogram")}


def attribute_keys(df: DataFrame, col: str) -> DataFrame:
    """The distinct keys of an attribute column, as column `key`."""
    return df.select(F.explode(F.transform(col, lambda kv: kv["key"])).alias("key")).distinct()


def widen(df: DataFrame, col: str, keys: list[str], prefix: str | None = None) -> DataFrame:
    """Add one text column per named attribute key, called prefix + key. `attribute_keys` lists the keys there are."""
    prefix = PREFIXES.get(col, "") if prefix is None else prefix
    with_map = df.withColumn("_map", text_map(F.col(col)))
    return with_map.select(*[column(c) for c in df.columns], *[F.col("_map")[k].alias(prefix + k) for k in keys])


def widen_all(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Widen several attribute columns, each with its usual prefix, and drop the originals."""
    for col, wanted in keys.items():
        df = widen(df, col, keys=wanted)
    return df.drop(*PREFIXES)


def is_key_value_list(dtype: T.DataType) -> bool:
    return (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)
            and dtype.elementType.names[:2] == ["key", "value"])


def _json_ready(value: Column, dtype: T.DataType, fill: bool, keep_default: bool) -> Column:
    """A field as `to_json` should write it; null, which it leaves out, where the field is unset and not to be filled."""
    if is_key_value_list(dtype):
        members = variant_map(value)
        return F.coalesce(members, F.create_map().cast("map<string,variant>")) if fill else F.when(F.size(value) > 0, members)
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[_json_ready(value[f.name], f.dataType, fill, False).alias(f.name) for f in dtype.fields])
        return inner if fill else F.when(value.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType):
        present = F.coalesce(value, F.array().cast(dtype)) if fill else F.when(F.size(value) > 0, value)
        if not fill and not isinstance(dtype.elementType, T.StructType):
            return present
        return F.transform(present, lambda x: _json_ready(x, dtype.elementType, fill, True))
    default = default_for(dtype)
    if fill:
        return F.coalesce(value, default)
    return value if keep_default else F.when(value != default, value)


def to_json_map(df: DataFrame, signal: str, with_defaults: bool = False) -> Column:
    """A whole flat row as one JSON object text; attribute lists become objects, bytes base64.

    Without defaults only fields that are set appear: a field that can be null if it is not null, any other if it
    differs from the default of its type. With defaults every field appears: 0, 0.0, false, "", [] or {}.
    """
    return F.to_json(F.struct(*[
        _json_ready(F.col(f.name), f.dataType, with_defaults, f.name in NULLABLE[signal]).alias(f.name)
        for f in flat_schema(signal).fields if f.name in df.columns]))


def split_columns(
    signal: str, dimensions: tuple[str, ...] = (), exclusions: tuple[str, ...] = (), metrics: tuple[str, ...] = (),
) -> tuple[list[str], list[str]]:
    """(dimension columns, measure columns) of a signal.

    A usual measure that is named as a dimension or an exclusion leaves the measures. `dimensions`, if given, are
    the dimensions; otherwise they are all other columns but the exclusions and the extra `metrics`.
    """
    measures = [m for m in MEASURES[signal] if m not in dimensions and m not in exclusions]
    columns = [*flat_schema(signal).names, *EXTRACTED.get(signal, ())]
    free = [c for c in columns if c not in measures and c not in metrics and c not in exclusions]
    return (list(dimensions) if dimensions else free), measures + [m for m in metrics if m not in measures]


def json_value(text: Column, key: str) -> Column:
    """Scalar at a (dotted) key of a JSON object text; null for lists and objects."""
    found = F.get_json_object(text, f"$['{key}']")
    return F.when(~F.substr(found, F.lit(1), F.lit(1)).isin("{", "["), found)


def first_attribute(attributes: Column, *keys: str) -> Column:
    """First non-null of several attribute names, as text: old and new names of a semantic convention."""
    lookup = scalar_map(attributes)
    return F.coalesce(*[lookup[k] for k in keys])


def with_attribute(df: DataFrame, name: str) -> DataFrame:
    """Rows where a widened attribute column is set."""
    return df.filter(column(name).isNotNull())


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every row: one aggregation with a count per column."""
    counts = df.agg(*[F.count(column(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[column(c) for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop the rows where every column is null."""
    present = F.lit(False)
    for c in df.columns:
        present = present | column(c).isNotNull()
    return df.filter(present)


def fill_blank(df: DataFrame) -> DataFrame:
    """Nulls of text columns become empty text, for display."""
    return df.select(*[
        (F.coalesce(column(f.name), F.lit("")) if isinstance(f.dataType, T.StringType) else column(f.name))
        .alias(f.name) for f in df.schema.fields
    ])


def to_number(value: Column, dtype: str = "double") -> Column:
    """Text as a number; text that is none becomes null."""
    return value.try_cast(dtype)


def native_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to the given types; what does not fit becomes null. Other columns stay as they are."""
    return df.select(*[
        column(c).try_cast(types[c]).alias(c) if c in types else column(c) for c in df.columns
    ])

