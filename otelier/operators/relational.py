"""Relational operators on flat tables. Most are a line of Spark; they fix names, null rules and skew behaviour."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from otelier.functions.expressions import column
from otelier.operators.attributes import widen_all
from otelier.schemas import LINEAGE

# ---------------------------------------------------------------- rows and columns


def filter_valid(df: DataFrame) -> DataFrame:
    """Rows that were received without error."""
    return df.filter("is_valid")


def filter_eq(df: DataFrame, **values) -> DataFrame:
    """Rows where every named column equals its value. Names with dots: filter_eq(df, **{"a_http.method": "GET"})."""
    for name, value in values.items():
        df = df.filter(column(name) == F.lit(value))
    return df


def filter_in(df: DataFrame, name: str, values: list) -> DataFrame:
    return df.filter(column(name).isin(*values))


def filter_id(df: DataFrame, name: str, value: bytes | str) -> DataFrame:
    """Rows with a binary id, given as bytes or hex text. The literal is binary, so the filter reaches the scan."""
    raw = bytes.fromhex(value) if isinstance(value, str) else bytes(value)
    return df.filter(column(name) == F.lit(raw))


def project(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[column(n) for n in names])


LOG_COLUMNS = ("scope_name", "scope_version", "time_unix_nano", "observed_time_unix_nano", "severity_number",
               "severity_text", "flags", "trace_id", "span_id")
METRIC_COLUMNS = (
    "scope_name", "scope_version", "name", "description", "unit", "type", "gauge_type", "gauge_int", "gauge_double",
    "sum_type", "sum_int", "sum_double", "histogram_count", "histogram_sum", "histogram_min", "histogram_max",
    "histogram_bucket_counts", "histogram_explicit_bounds", "start_time_unix_nano", "time_unix_nano",
    "aggregation_temporality", "is_monotonic",
)
SPAN_COLUMNS = ("scope_name", "scope_version", "trace_id", "span_id", "trace_state", "parent_span_id", "flags",
                "name", "kind", "start_time_unix_nano", "end_time_unix_nano")


def _prepare(df: DataFrame, columns: list, keys: dict[str, list[str]]) -> DataFrame:
    return widen_all(filter_valid(df).select(*columns, *keys), keys)


def log_prepare(logs: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Valid logs: base columns, `body` (null unless it is a text) and the named attributes as columns.

    `keys` maps an attribute column to the keys to widen: {"attributes": ["k"], "resource_attributes": [...]}.
    """
    body = F.when(F.col("body_type") == "STRING_VALUE", F.col("body_string")).alias("body")
    return _prepare(logs, [*LOG_COLUMNS, body], keys)


def metric_prepare(metrics: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Valid metric points: base columns and the named attributes as columns."""
    return _prepare(metrics, list(METRIC_COLUMNS), keys)


def span_prepare(spans: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Valid spans: base columns, status as `status.message` and `status.code`, events, links, named attributes."""
    status = [F.col("status.message").alias("status.message"), F.col("status.code").alias("status.code")]
    return _prepare(spans, [*SPAN_COLUMNS, *status, "events", "links"], keys)


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return project(df, *names).distinct()


# ---------------------------------------------------------------- retransmissions


def _comparable(df: DataFrame) -> DataFrame:
    """Maps have no equality; as sorted JSON text they do."""
    return df.select(*[
        F.to_json(F.array_sort(F.map_entries(column(f.name)))).alias(f.name)
        if isinstance(f.dataType, T.MapType) else column(f.name)
        for f in df.schema.fields
    ])


def dedup_rows(df: DataFrame, signal: str | None = None) -> DataFrame:
    """Keep one of equal rows. The lineage columns of `signal` go first: a retransmission has a new packet id.

    The copies of a row are combined before the shuffle, so many copies of one row do not gather in one task.
    """
    if signal:
        df = df.drop(*LINEAGE[signal])
    return _comparable(df).dropDuplicates()


METRIC_VALUE_COLUMNS = ("gauge_int", "gauge_double", "sum_int", "sum_double", "histogram_bucket_counts",
                        "histogram_explicit_bounds")


def dedup_subset(df: DataFrame, value_columns: tuple[str, ...] = METRIC_VALUE_COLUMNS) -> DataFrame:
    """Keep one of the rows that are equal in all columns but the value columns: the one with the least values.

    `row_number() = 1` lets Spark keep one row per key and task before the shuffle (WindowGroupLimit), which also
    holds for a key that has a third of all rows.
    """
    values = [c for c in df.columns if c in value_columns]
    keys = [c for c in df.columns if c not in value_columns]
    order = Window.partitionBy(*[column(k) for k in keys]).orderBy(*[column(v) for v in values])
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


# ---------------------------------------------------------------- order, union, groups


def sort_rows(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*[column(n).asc() for n in names])


def limit_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows in an order; Spark keeps n per task and merges those."""
    return sort_rows(df, *order).limit(n)


def union_values(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack frames of equal shape, by column name."""
    return reduce(DataFrame.unionByName, others, first)


def group_sum(df: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Sum of the value columns per key; sums are partial in each task before the shuffle."""
    return df.groupBy(*[column(k) for k in keys]).agg(*[F.sum(column(v)).alias(v) for v in values])


def count_rows(df: DataFrame, *dimensions: str) -> DataFrame:
    """COUNT(*) per set of dimensions, as column `count`."""
    return df.groupBy(*[column(d) for d in dimensions]).agg(F.count(F.lit(1)).alias("count"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Open tables to free SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# ---------------------------------------------------------------- joins


def join_back(base: DataFrame, values: DataFrame, signal: str, columns: list[str]) -> DataFrame:
    """Add `columns` of values (1:n per row) to base rows by lineage. Carry columns along instead where possible."""
    keys = list(LINEAGE[signal])
    return base.join(values.select(*keys, *[column(c) for c in columns]), keys, "left")


def log_span_join(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs with the span they were written in: inner join on trace and span id.

    Rows without a span id cannot match and go before the shuffle; they may be the largest group of all. Neither
    side has a size bound, so there is no broadcast hint: adaptive execution broadcasts a side it has measured as
    small, and splits a hot span id over several tasks otherwise.
    """
    keys = ["trace_id", "span_id"]

    def has_span(df: DataFrame) -> DataFrame:
        return df.filter((F.length("span_id") > 0) & (F.length("trace_id") > 0))

    return has_span(logs).join(has_span(spans), keys, "inner")
