"""Profile operators: prepared sample values and stack frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from otelier.functions.expressions import column
from otelier.operators.attributes import widen
from otelier.operators.relational import filter_id, filter_valid


def stack_id(stack: Column) -> Column:
    """An id that equal stacks share; the format itself carries none."""
    return F.sha2(F.to_json(stack), 256)


BASE_COLUMNS = ("profile_id", "start_time_unix_nano", "end_time_unix_nano", "duration_nano", "period",
                "period_type.type", "period_type.unit", "type.type", "type.unit", "stacktrace_id",
                "timestamp_unix_nano", "trace_id", "span_id", "value")


def prof_prepare(profiles: DataFrame, *keep: str) -> DataFrame:
    """Valid sample values: base columns, period and sample type split, stack id; and the columns `keep`."""
    valid = filter_valid(profiles)
    return valid.select(
        "profile_id",
        F.col("time_unix_nano").alias("start_time_unix_nano"),
        (F.col("time_unix_nano") + F.col("duration_nano")).alias("end_time_unix_nano"),
        "duration_nano",
        "period",
        F.col("period_type.type").alias("period_type.type"),
        F.col("period_type.unit").alias("period_type.unit"),
        F.col("sample_type.type").alias("type.type"),
        F.col("sample_type.unit").alias("type.unit"),
        stack_id(F.col("stack")).alias("stacktrace_id"),
        "timestamp_unix_nano", "trace_id", "span_id", "value",
        *[column(k) for k in keep],
    )


def prof_filter(prepared: DataFrame, profile_id: bytes | str | None = None, stacktrace_id: str | None = None) -> DataFrame:
    """Rows of one profile or of one stack."""
    if profile_id is not None:
        prepared = filter_id(prepared, "profile_id", profile_id)
    if stacktrace_id is not None:
        prepared = prepared.filter(F.col("stacktrace_id") == stacktrace_id)
    return prepared


MAPPING_FIELDS = ("memory_start", "memory_limit", "file_offset", "filename", "attributes")
FUNCTION_FIELDS = ("name", "system_name", "filename", "start_line")


def prof_frames(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row per location of a stack: mapping, address, first line (null if there is none) and depth.

    `stacktrace_len` counts the frames with an address, `stacktrace_depth` is 0 at the outermost frame. Both come
    from the row itself: the length of the array and the position in it.
    """
    located = F.size(F.filter("stack", lambda frame: frame["address"].isNotNull()))
    exploded = df.select(
        *[column(c) for c in keep], located.alias("stacktrace_len"), F.posexplode("stack").alias("_pos", "_at"))
    line = F.get(F.col("_at.lines"), F.lit(0))
    return exploded.select(
        *[column(c) for c in keep],
        *[F.col(f"_at.mapping.{f}").alias(f"location.map.{f}") for f in MAPPING_FIELDS],
        F.col("_at.address").alias("location.address"),
        *[line["function"][f].alias(f"location.line_0.function.{f}") for f in FUNCTION_FIELDS],
        line["line"].alias("location.line_0.line"),
        line["column"].alias("location.line_0.column"),
        F.col("_at.attributes").alias("location.attributes"),
        "stacktrace_len",
        (F.col("stacktrace_len") - 1).alias("stacktrace_max_depth"),
        (F.col("stacktrace_len") - F.col("_pos") - 1).alias("stacktrace_depth"),
    )


def prof_full(profiles: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Prepared values, frames, depths and the named attributes as columns, in one narrow stage."""
    prepared = prof_prepare(profiles, "stack", *keys)
    wide = prepared
    for col, wanted in keys.items():
        wide = widen(wide, col, keys=wanted)
    wide = wide.drop(*keys)
    return prof_frames(wide, [c for c in wide.columns if c != "stack"])
