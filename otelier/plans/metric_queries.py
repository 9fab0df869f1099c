"""Queries on metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from otelier.functions.expressions import column
from otelier.operators.attributes import widen
from otelier.operators.metrics import (
    exemplars, first_session, gauge_series, hist_explode, hist_interval_mean, hist_mean, hist_series,
    hist_stat_delta, metric_exploded, metric_over_time, metric_value, quantile_values, session_gaps,
    sum_by_emitter, sum_delta, sum_delta_naive, unit_scale, value_delta, with_emitter, with_exp_hist_buckets,
    with_hist_buckets,
)
from otelier.operators.relational import filter_valid, metric_prepare
from otelier.plans import fixtures
from otelier.plans.fixtures import EXP_BUCKETS, planned_once
from otelier.plans.oracle import HOURS, N_BUCKETS, POINTS, STATS
from otelier.plans.registry import hexed, query
from otelier.plans.relational_queries import METRIC_KEYS

# the emitter and event type the chart queries show
EMITTER, EVENT = "app@shop-0", "error"
KEY = "a_event.type"


@planned_once
def prepared(spark, sf) -> DataFrame:
    """Valid points with emitter and event type: what the metric operators start from."""
    return with_emitter(metric_prepare(fixtures.metric_rows(spark, sf), METRIC_KEYS))


@planned_once
def full(spark, sf) -> DataFrame:
    """The same with all columns of the flat row."""
    return with_emitter(widen(filter_valid(fixtures.metric_rows(spark, sf)), "attributes", keys=["event.type"]))


def point_key():
    return ["emitter", column(KEY).alias("event_type"), F.col("start_time_unix_nano").alias("start_ns"),
            F.col("time_unix_nano").alias("time_ns")]


@query("emitter", """
SELECT emitter, name, count(*) AS n FROM points GROUP BY emitter, name""", POINTS)
def emitters(spark, sf):
    return prepared(spark, sf).groupBy("emitter", "name").agg(F.count(F.lit(1)).alias("n"))


@query("metric_over_time", """
SELECT emitter, event_type, start_ns, time_ns, CAST(sum_int AS BIGINT) AS sum_int FROM points
WHERE name = 'app.events' ORDER BY start_ns, time_ns""", POINTS)
def over_time(spark, sf):
    return metric_over_time(prepared(spark, sf), "app.events").select(*point_key(), "sum_int")


@query("metric_value", """
SELECT emitter, event_type, start_ns, time_ns, name, coalesce(gauge_double, CAST(sum_int AS DOUBLE)) AS value
FROM points WHERE type IN ('GAUGE', 'SUM')""", POINTS)
def values(spark, sf):
    return metric_value(prepared(spark, sf)).select(*point_key(), "name", "value")


@query("unit_scale", """
SELECT emitter, event_type, start_ns, time_ns, CAST(sum_int AS DOUBLE) * CAST(100 AS DOUBLE) AS percent,
  CAST(sum_int AS DOUBLE) / CAST(1048576 AS DOUBLE) AS megabytes,
  CAST(sum_int AS DOUBLE) / CAST(1000000 AS DOUBLE) AS milliseconds FROM points WHERE type = 'SUM'""", POINTS)
def scaled(spark, sf):
    rows = metric_value(prepared(spark, sf).filter("type = 'SUM'"))
    return rows.select(*point_key(), *[
        unit_scale(F.col("value"), u).alias(u) for u in ("percent", "megabytes", "milliseconds")])


@query("gauge_series", f"""
SELECT time_ns AS time_unix_nano, gauge_double AS value FROM points
WHERE type = 'GAUGE' AND emitter = '{EMITTER}' AND event_type = '{EVENT}' ORDER BY time_ns""", POINTS)
def gauge_line(spark, sf):
    return gauge_series(prepared(spark, sf), "app.value.last", emitter=EMITTER, **{KEY: EVENT})


@query("sum_by_emitter", """
SELECT emitter, time_ns AS time_unix_nano, start_ns AS start_time_unix_nano, CAST(sum(sum_int) AS BIGINT) AS sum_int,
  CAST(sum(sum_int) AS DOUBLE) AS sum_value FROM points WHERE name = 'app.events' GROUP BY emitter, start_ns, time_ns""", POINTS)
def by_emitter(spark, sf):
    return sum_by_emitter(prepared(spark, sf), "app.events")


@query("first_session", """
SELECT emitter, event_type, start_ns, time_ns, CAST(sum_int AS BIGINT) AS sum_int FROM (
  SELECT *, min(start_ns) OVER (PARTITION BY emitter) AS first_ns FROM points WHERE name = 'app.events')
WHERE start_ns = first_ns""", POINTS)
def first(spark, sf):
    return first_session(prepared(spark, sf).filter("name = 'app.events'")).select(*point_key(), "sum_int")


_SUMS = """
sums AS (SELECT emitter, start_ns, time_ns, CAST(sum(sum_int) AS BIGINT) AS sum_int FROM points
  WHERE name = 'app.events' GROUP BY emitter, start_ns, time_ns)"""


@query("sum_delta", """
SELECT emitter, start_ns AS start_time_unix_nano, time_ns AS time_unix_nano, sum_int,
  sum_int - lag(sum_int, 1, 0) OVER (PARTITION BY emitter, start_ns ORDER BY time_ns) AS sum_delta
FROM sums""", POINTS, _SUMS)
def deltas(spark, sf):
    return sum_delta(sum_by_emitter(prepared(spark, sf), "app.events").drop("sum_value"))


@query("sum_delta_naive", """
SELECT emitter, start_ns AS start_time_unix_nano, time_ns AS time_unix_nano, sum_int,
  sum_int - lag(sum_int, 1, 0) OVER (PARTITION BY emitter ORDER BY time_ns, sum_int) AS sum_delta
FROM sums""", POINTS, _SUMS)
def naive_deltas(spark, sf):
    return sum_delta_naive(sum_by_emitter(prepared(spark, sf), "app.events").drop("sum_value"))


@query("sum_delta_double", """
SELECT emitter, start_ns AS start_time_unix_nano, time_ns AS time_unix_nano, sum_int / 4 AS sum_value,
  sum_int / 4 - lag(sum_int / 4, 1, 0) OVER (PARTITION BY emitter, start_ns ORDER BY time_ns) AS sum_delta
FROM sums""", POINTS, _SUMS)
def double_deltas(spark, sf):
    # the same counter as doubles; quarters add up exactly
    points = prepared(spark, sf).withColumns({
        "sum_type": F.when(F.col("type") == "SUM", "AS_DOUBLE"), "sum_double": F.col("sum_int") / 4,
        "sum_int": F.lit(None).cast("bigint")})
    sums = sum_delta(sum_by_emitter(points, "app.events"))
    return sums.filter("sum_int IS NULL AND sum_delta IS NULL").select(
        "emitter", "start_time_unix_nano", "time_unix_nano", "sum_value", F.col("sum_delta_value").alias("sum_delta"))


@query("session_gaps", """
SELECT emitter, event_type, start_ns AS start_time_unix_nano, first_time, last_time, points, previous_start,
  first_time - previous_last AS gap_nanos FROM (
    SELECT *, lag(start_ns) OVER w AS previous_start, lag(last_time) OVER w AS previous_last FROM (
      SELECT emitter, event_type, start_ns, min(time_ns) AS first_time, max(time_ns) AS last_time, count(*) AS points
      FROM points WHERE name = 'app.events' GROUP BY emitter, event_type, start_ns)
    WINDOW w AS (PARTITION BY emitter, event_type ORDER BY start_ns))
WHERE previous_start IS NOT NULL""", POINTS)
def gaps(spark, sf):
    rows = prepared(spark, sf).filter("name = 'app.events'").withColumnRenamed(KEY, "event_type")
    return session_gaps(rows, ["emitter", "event_type"])


@query("hist_mean", """
SELECT emitter, event_type, start_ns, time_ns, CAST(cs AS DOUBLE) / CAST(cn AS DOUBLE) AS mean FROM hours""", HOURS)
def means(spark, sf):
    return hist_mean(prepared(spark, sf)).select(*point_key(), "mean")


@query("hist_explode", """
SELECT emitter, event_type, start_ns, time_ns, stat, value FROM stats""", STATS)
def exploded_histograms(spark, sf):
    rows = prepared(spark, sf).withColumns({"event_type": column(KEY), "start_ns": F.col("start_time_unix_nano"),
                                            "time_ns": F.col("time_unix_nano")})
    return hist_explode(rows, ["emitter", "event_type", "start_ns", "time_ns"]).withColumnRenamed(
        "population_stat", "stat")


@query("hist_series", """
SELECT start_ns AS start_time_unix_nano, time_ns AS time_unix_nano, emitter, event_type AS "a_event.type", value,
  stat AS population_stat FROM stats""", STATS)
def histogram_line(spark, sf):
    return hist_series(prepared(spark, sf), "app.value.dist", ["emitter", KEY])


@query("hist_stat_delta", """
SELECT emitter, event_type AS "a_event.type", start_ns AS start_time_unix_nano, time_ns AS time_unix_nano,
  stat AS population_stat, value,
  value - lag(value, 1, 0) OVER (PARTITION BY emitter, event_type, start_ns, stat ORDER BY time_ns) AS value_delta
FROM stats""", STATS)
def histogram_deltas(spark, sf):
    rows = hist_explode(prepared(spark, sf), ["emitter", KEY, "start_time_unix_nano", "time_unix_nano"])
    return hist_stat_delta(rows, ["emitter", KEY])


@query("hist_interval_mean", """
SELECT emitter, event_type, start_ns, time_ns,
  CAST(cs - lag(cs, 1, 0) OVER w AS DOUBLE) / CAST(cn - lag(cn, 1, 0) OVER w AS DOUBLE) AS interval_mean
FROM hours WINDOW w AS (PARTITION BY emitter, event_type, start_ns ORDER BY time_ns)""", HOURS)
def interval_means(spark, sf):
    return hist_interval_mean(prepared(spark, sf), ["emitter", KEY]).select(*point_key(), "interval_mean")


_EXPLODED = """
exploded AS (
  SELECT emitter, event_type, start_ns, time_ns, 'app.value.dist' AS name, stat, value FROM stats
  UNION ALL SELECT emitter, event_type, start_ns, time_ns, 'app.value.last', NULL, last_value FROM hours
  UNION ALL SELECT emitter, event_type, start_ns, time_ns, 'app.events', NULL, CAST(cn AS DOUBLE) FROM hours
  UNION ALL SELECT emitter, event_type, start_ns, time_ns, unnest(['app.value.exp', 'app.value.summary']), NULL, NULL
    FROM hours)"""


@query("metric_exploded", """
SELECT emitter, event_type, start_ns, time_ns, name, stat, value FROM exploded""", STATS, _EXPLODED)
def exploded(spark, sf):
    return metric_exploded(prepared(spark, sf)).select(
        *point_key(), "name", F.col("population_stat").alias("stat"), "value")


@query("value_delta", """
SELECT emitter, event_type, start_ns, time_ns, name, stat, value,
  CASE WHEN row_number() OVER w = 1 THEN value ELSE value - lag(value) OVER w END AS value_delta,
  coalesce(lag(time_ns) OVER w, 0) AS prev_time_unix_nano
FROM exploded WINDOW w AS (PARTITION BY emitter, event_type, start_ns, name, stat ORDER BY time_ns)""", STATS, _EXPLODED)
def value_deltas(spark, sf):
    return value_delta(metric_exploded(prepared(spark, sf))).select(
        *point_key(), "name", F.col("population_stat").alias("stat"), "value", "value_delta", "prev_time_unix_nano")


_BOUNDS = [None, "500", "1000", "2500", "5000", "7500", "10000", None]


def _bound(i: int) -> str:
    return f"CAST({_BOUNDS[i] or 'NULL'} AS DOUBLE)"


@query("hist_buckets", "\nUNION ALL ".join(
    f"SELECT emitter, event_type, start_ns, time_ns, {_bound(i)} AS lower_bound, {_bound(i + 1)} AS upper_bound, "
    f"c{i} AS n FROM hours" for i in range(N_BUCKETS)), HOURS)
def buckets(spark, sf):
    return with_hist_buckets(prepared(spark, sf)).select(*point_key(), F.inline("histogram")).withColumnRenamed("count", "n")


@query("exp_hist_buckets", "\nUNION ALL ".join(
    f"SELECT emitter, event_type, start_ns, time_ns, CAST({2 ** i} AS DOUBLE) AS lower_bound, "
    f"CAST({2 ** (i + 1)} AS DOUBLE) AS upper_bound, e{i} AS n FROM hours" for i in range(EXP_BUCKETS)), HOURS)
def exponential_buckets(spark, sf):
    return with_exp_hist_buckets(full(spark, sf)).select(
        *point_key(), F.inline("exponential_histogram")).withColumnRenamed("count", "n")


@query("exemplars", """
SELECT 'app.value.dist' AS name, 'HISTOGRAM' AS type, emitter, start_ns AS start_time_unix_nano,
  time_ns AS time_unix_nano, x_at AS exemplar_time_unix_nano, x_v AS exemplar_as_int,
  CASE WHEN event_type <> 'click' THEN lpad(lower(hex(x_id + 1)), 32, '0') ELSE '' END AS exemplar_trace_id,
  CASE WHEN event_type <> 'click' THEN lpad(lower(hex((x_id + 1) * 16)), 16, '0') ELSE '' END AS exemplar_span_id
FROM hours""", HOURS)
def exemplar_rows(spark, sf):
    rows = exemplars(full(spark, sf), "app.value.dist",
                     ["emitter", "name", "type", "start_time_unix_nano", "time_unix_nano"])
    return rows.select("name", "type", "emitter", "start_time_unix_nano", "time_unix_nano", "exemplar_time_unix_nano",
                       "exemplar_as_int", *hexed("exemplar_trace_id", "exemplar_span_id"))


@query("quantile_values", """
SELECT emitter, event_type AS "a_event.type", time_ns AS time_unix_nano, CAST(0 AS DOUBLE) AS quantile,
  CAST(lo AS DOUBLE) AS value FROM hours
UNION ALL SELECT emitter, event_type, time_ns, CAST(1 AS DOUBLE), CAST(hi AS DOUBLE) FROM hours""", HOURS)
def quantiles(spark, sf):
    return quantile_values(full(spark, sf), ["emitter", KEY, "time_unix_nano"])


