"""Expressions on the bucket arrays of histogram points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from otelier.functions.expressions import number_text, or_empty


def bucket_labels(bounds: Column) -> Column:
    """Labels of the n + 1 buckets of n bounds: lt_b0, b0-b1, ..., gt_bn; none without bounds.

    An upper bound belongs to its bucket.
    """
    texts = F.transform(bounds, number_text)
    # pair each bound with the next; the first and the last bucket are open
    middle = F.zip_with(
        F.slice(texts, F.lit(1), F.greatest(F.size(texts) - 1, F.lit(0))),
        F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0))),
        lambda low, high: F.concat(low, F.lit("-"), high),
    )
    labels = F.concat(
        F.array(F.concat(F.lit("lt_"), F.get(texts, F.lit(0)))),
        middle,
        F.array(F.concat(F.lit("gt_"), F.get(texts, F.size(texts) - 1))),
    )
    return F.when(F.size(or_empty(bounds)) > 0, labels).otherwise(F.array().cast("array<string>"))


def histogram_statistics() -> Column:
    """Statistics of a flat histogram row as ARRAY<STRUCT<value, population_stat>>: count, sum, min, max, buckets.

    Buckets are listed only where counts and bounds fit each other.
    """

    def stat(name: str, value: Column) -> Column:
        return F.struct(value.cast("double").alias("value"), F.lit(name).alias("population_stat"))

    counts, bounds = F.col("histogram_bucket_counts"), F.col("histogram_explicit_bounds")
    fit = (F.size(or_empty(bounds)) > 0) & (F.size(or_empty(counts)) == F.size(or_empty(bounds)) + 1)
    buckets = F.zip_with(counts, bucket_labels(bounds), lambda c, label: F.struct(
        c.cast("double").alias("value"), label.alias("population_stat")))
    none = F.array().cast("array<struct<value:double,population_stat:string>>")
    return F.concat(
        F.array(
            stat("count", F.col("histogram_count")), stat("sum", F.col("histogram_sum")),
            stat("min", F.col("histogram_min")), stat("max", F.col("histogram_max")),
        ),
        F.when(fit, buckets).otherwise(none),
    )


def hist_buckets(counts: Column, bounds: Column) -> Column:
    """Buckets as ARRAY<STRUCT<lower_bound, upper_bound, count>>; the first lower and last upper bound are null.

    Null if there is nothing or if the sizes do not fit.
    """
    buckets = F.transform(counts, lambda c, i: F.struct(
        F.get(bounds, i - 1).alias("lower_bound"), F.get(bounds, i).alias("upper_bound"), c.alias("count")))
    return F.when(F.size(or_empty(counts)) == F.size(or_empty(bounds)) + 1, buckets)


def exp_hist_buckets(scale: Column, positive: Column, negative: Column) -> Column:
    """Buckets of an exponential histogram, negative ones first, with lower < upper bound.

    Bucket i covers base^(offset + i) to base^(offset + i + 1) where base = 2^(2^-scale).
    """
    base = F.pow(F.lit(2.0), F.pow(F.lit(2.0), -scale))

    def edge(buckets: Column, i: Column) -> Column:
        return F.pow(base, F.coalesce(buckets["offset"], F.lit(0)) + i)

    none = F.array().cast("array<struct<lower_bound:double,upper_bound:double,count:bigint>>")
    below = F.transform(negative["bucket_counts"], lambda c, i: F.struct(
        (-edge(negative, i + 1)).alias("lower_bound"), (-edge(negative, i)).alias("upper_bound"), c.alias("count")))
    above = F.transform(positive["bucket_counts"], lambda c, i: F.struct(
        edge(positive, i).alias("lower_bound"), edge(positive, i + 1).alias("upper_bound"), c.alias("count")))
    return F.concat(F.coalesce(below, none), F.coalesce(above, none))
