"""Metric operators: values, series, deltas that respect resets, histograms and exemplars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from otelier.functions.anyvalue import any_value, last_value
from otelier.functions.expressions import column
from otelier.functions.histograms import exp_hist_buckets, hist_buckets, histogram_statistics
from otelier.functions.series import delta, with_previous

START, TIME = "start_time_unix_nano", "time_unix_nano"

# ---------------------------------------------------------------- identity and values


def emitter_id(scope_name: Column, service: Column) -> Column:
    """scope@service; null if either is null."""
    return F.concat(scope_name, F.lit("@"), service)


def with_emitter(df: DataFrame) -> DataFrame:
    """Add `emitter` and drop the columns it stands for: resource attributes, scope name and version.

    Takes flat rows (service from `resource_attributes`) or prepared rows (from `ra_service.name`).
    """
    if "ra_service.name" in df.columns:
        service = column("ra_service.name")
    else:
        service = any_value(last_value(F.col("resource_attributes"), "service.name"))
    rest = [c for c in df.columns if not c.startswith("ra_")
            and c not in ("scope_name", "scope_version", "resource_attributes")]
    return df.select(emitter_id(F.col("scope_name"), service).alias("emitter"), *[column(c) for c in rest])


def metric_over_time(df: DataFrame, name: str) -> DataFrame:
    """Points of one metric in order of start and time."""
    return df.filter(F.col("name") == name).orderBy(START, TIME)


def number_value() -> Column:
    """The value of a gauge or a sum as double, chosen by its type column and never by null tests."""

    def pick(kind: str) -> Column:
        return (F.when(F.col(f"{kind}_type") == "AS_INT", F.col(f"{kind}_int").cast("double"))
                .when(F.col(f"{kind}_type") == "AS_DOUBLE", F.col(f"{kind}_double")))

    return F.when(F.col("type") == "GAUGE", pick("gauge")).when(F.col("type") == "SUM", pick("sum"))


def metric_value(df: DataFrame) -> DataFrame:
    """Gauge and sum points with their number in `value`."""
    return df.filter(F.col("type").isin("GAUGE", "SUM")).withColumn("value", number_value())


# factors of the unit changes in use: shares to percent, bytes to megabytes, nanoseconds to milliseconds
UNIT_FACTORS = {"percent": (100.0, 1.0), "megabytes": (1.0, 1024.0 * 1024.0), "milliseconds": (1.0, 1_000_000.0)}


def unit_scale(value: Column, to: str) -> Column:
    times, by = UNIT_FACTORS[to]
    return value * F.lit(times) / F.lit(by)


def gauge_series(df: DataFrame, name: str, **where) -> DataFrame:
    """One line of a chart: time and value of a gauge, filtered by column values, in order of time."""
    df = df.filter((F.col("name") == name) & (F.col("type") == "GAUGE"))
    for key, value in where.items():
        df = df.filter(column(key) == F.lit(value))
    return df.select(TIME, number_value().alias("value")).orderBy(TIME)


# ---------------------------------------------------------------- sums


def sum_by_emitter(df: DataFrame, name: str, by_session: bool = True) -> DataFrame:
    """Sum of the sub-series of a metric per emitter (and session) and time, by the type of its points: `sum_int` adds whole
    numbers exactly and is null where a point is a double, `sum_value` adds all points as doubles."""
    keys = ["emitter", START, TIME] if by_session else ["emitter", TIME]
    points = df.filter(F.col("name") == name).withColumn("_value", number_value())
    exact = F.when(F.count_if(F.col("sum_type") == "AS_DOUBLE") == 0, F.sum("sum_int"))
    return points.groupBy(*keys).agg(exact.alias("sum_int"), F.sum("_value").alias("sum_value"))


def first_session(df: DataFrame) -> DataFrame:
    """Points of the first session (least start time) of each emitter."""
    first = df.groupBy("emitter").agg(F.min(START).alias("_first"))
    return df.join(first, "emitter").filter(F.col(START) == F.col("_first")).drop("_first")


#: Differences of the columns of sum_by_emitter.
_DELTAS = {"sum_int": "sum_delta", "sum_value": "sum_delta_value"}


def _with_deltas(sums: DataFrame, series: list[str], ranges: int | None) -> DataFrame:
    names = {c: d for c, d in _DELTAS.items() if c in sums.columns}
    points = with_previous(sums, series, TIME, list(names), ranges)
    return points.withColumns({d: delta(c) for c, d in names.items()}).drop("_previous")


def sum_delta(sums: DataFrame, ranges: int | None = None) -> DataFrame:
    """Cumulative sums to differences inside a session; a reset starts from zero again. `sum_delta` is that of `sum_int`, exact
    and null where a sum holds doubles, `sum_delta_value` that of `sum_value`; each where its column is there."""
    return _with_deltas(sums, ["emitter", START], ranges)


def sum_delta_naive(sums: DataFrame, ranges: int | None = None) -> DataFrame:
    """The same over a whole emitter: differences are wrong where a session ends. For comparison only."""
    return _with_deltas(sums, ["emitter"], ranges)


def session_gaps(df: DataFrame, series: list[str]) -> DataFrame:
    """Sessions of series that have more than one: start, first and last point, and the previous session's last point.

    Points are reduced to one row per session first, so a long series is no large group.
    """
    sessions = df.groupBy(*[column(c) for c in series], START).agg(
        F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"), F.count(F.lit(1)).alias("points"))
    chained = with_previous(sessions, series, START, ["last_time"])
    return (
        chained.filter(F.col("_previous").isNotNull())
        .withColumn("previous_start", F.col("_previous")[START])
        .withColumn("gap_nanos", F.col("first_time") - F.col("_previous")["last_time"])
        .drop("_previous")
    )


# ---------------------------------------------------------------- histograms


def hist_mean(df: DataFrame) -> DataFrame:
    """Histogram points with `mean` = sum / count, null for an empty histogram."""
    return df.filter(F.col("type") == "HISTOGRAM").withColumn(
        "mean", F.col("histogram_sum") / F.nullif(F.col("histogram_count"), F.lit(0)))


def hist_explode(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row per statistic of each histogram point: columns `keep`, `value` and `population_stat`."""
    return df.filter(F.col("type") == "HISTOGRAM").select(
        *[column(c) for c in keep], F.inline(histogram_statistics()))


def hist_series(df: DataFrame, name: str, attributes: list[str]) -> DataFrame:
    """Exploded histogram of one metric with some attribute columns, sorted by attributes, statistic and time."""
    points = df.filter(F.col("name") == name)
    return hist_explode(points, [START, TIME, *attributes]).orderBy(
        *[column(a) for a in attributes], "population_stat", START, TIME)


def hist_stat_delta(exploded: DataFrame, series: list[str], ranges: int | None = None) -> DataFrame:
    """Differences of one statistic over time; `series` are the identity columns besides session and statistic."""
    points = with_previous(exploded, [*series, START, "population_stat"], TIME, ["value"], ranges)
    return points.withColumn("value_delta", delta("value")).drop("_previous")


def hist_interval_mean(df: DataFrame, series: list[str], ranges: int | None = None) -> DataFrame:
    """Mean per interval: difference of sums / difference of counts, null for an interval without events."""
    points = df.filter(F.col("type") == "HISTOGRAM")
    points = with_previous(points, [*series, START], TIME, ["histogram_sum", "histogram_count"], ranges)
    return points.withColumn(
        "interval_mean", delta("histogram_sum") / F.nullif(delta("histogram_count"), F.lit(0))).drop("_previous")


def with_hist_buckets(df: DataFrame) -> DataFrame:
    """Add `histogram`: the buckets of histogram points, null for other kinds."""
    buckets = hist_buckets(F.col("histogram_bucket_counts"), F.col("histogram_explicit_bounds"))
    return df.withColumn("histogram", F.when(F.col("type") == "HISTOGRAM", buckets))


def with_exp_hist_buckets(df: DataFrame) -> DataFrame:
    """Add `exponential_histogram`: the buckets of exponential histogram points, null for other kinds."""
    buckets = exp_hist_buckets(
        F.col("exponential_histogram_scale"), F.col("exponential_histogram_positive"),
        F.col("exponential_histogram_negative"))
    return df.withColumn("exponential_histogram", F.when(F.col("type") == "EXPONENTIAL_HISTOGRAM", buckets))


# ---------------------------------------------------------------- all values in one column

VALUE_SOURCES = ("gauge_type", "gauge_int", "gauge_double", "sum_type", "sum_int", "sum_double", "histogram_count",
                 "histogram_sum", "histogram_min", "histogram_max", "histogram_bucket_counts",
                 "histogram_explicit_bounds")


def metric_exploded(df: DataFrame) -> DataFrame:
    """Gauges, sums and histogram statistics as rows of one shape: base columns, `value`, `population_stat`.

    The statistic is null for gauges and sums; a point without a value (other kinds) keeps one row with null. One
    pass over the input: the kinds differ in an array expression, not in branches of a union.
    """
    base = [c for c in df.columns if c not in VALUE_SOURCES]
    single = F.array(F.struct(number_value().alias("value"), F.lit(None).cast("string").alias("population_stat")))
    values = F.when(F.col("type") == "HISTOGRAM", histogram_statistics()).otherwise(single)
    return df.select(*[column(c) for c in base], F.inline(values))


def value_delta(exploded: DataFrame, series: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """`value_delta` and `prev_time_unix_nano` per series, in order of time; first point: the value itself and 0.

    A series is what shares all columns but time and value, unless `series` names the columns.
    """
    if series is None:
        series = [c for c in exploded.columns if c not in (TIME, "value")]
    points = with_previous(exploded, series, TIME, ["value"], ranges)
    return (
        points.withColumn("value_delta", delta("value"))
        .withColumn("prev_time_unix_nano", F.coalesce(F.col("_previous")[TIME], F.lit(0)))
        .drop("_previous")
    )


# ---------------------------------------------------------------- nested lists of a point


def exemplars(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """A row per exemplar of one metric, with the fields of the exemplar after `keep`, sorted by start and time.

    The times of point and exemplar share a name, so the fields of the exemplar get the prefix `exemplar_`.
    """
    keep = keep or ["scope_name", "name", "description", "unit", "type", START, TIME]
    fields = ("filtered_attributes", "time_unix_nano", "as_double", "as_int", "span_id", "trace_id")
    return (
        df.filter(F.col("name") == name)
        .select(*[column(c) for c in keep], F.explode("exemplars").alias("_e"))
        .select(*[column(c) for c in keep], *[F.col(f"_e.{f}").alias(f"exemplar_{f}") for f in fields])
        .orderBy(START, TIME)
    )


def quantile_values(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row per (quantile, value) pair of summary points."""
    return df.filter(F.col("type") == "SUMMARY").select(
        *[column(c) for c in keep], F.inline("summary_quantile_values"))
