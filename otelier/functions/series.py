"""The previous point of a time series, without putting a whole series into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from otelier.functions.expressions import column

#: Estimated bytes up to which a series may be sorted by one task.
ONE_TASK = 64 << 20
#: Points drawn per range to choose the bounds of the ranges; only their hashes and times come to the driver.
DRAWN = 40


def _bounds(df: DataFrame, series: list[Column], time: str, ranges: int) -> list[tuple[int, int]]:
    """Pairs (hash of the series, time) that cut the points into about equal ranges, from `DRAWN` random points per range."""
    points = df.select(F.xxhash64(*series).alias("h"), column(time).cast("bigint").alias("t"), F.rand(7).alias("r")).where("t IS NOT NULL")
    drawn = sorted((r["h"], r["t"]) for r in points.orderBy("r").limit(DRAWN * ranges).collect())
    step = max(DRAWN, -(-len(drawn) // ranges))
    return sorted(set(drawn[step::step]))


def _range_of(point: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds a point has reached, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.expr(f"array({', '.join(f'named_struct({chr(39)}h{chr(39)}, {h}L, {chr(39)}t{chr(39)}, {t}L)' for h, t in bounds)})")
    steps, step = [], 1 << (len(bounds).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1

    def advance(reached: Column, n: Column) -> Column:
        bound = F.get(table, reached + n - 1)
        return reached + F.when(bound.isNotNull() & (bound <= point), n).otherwise(0)

    return F.aggregate(F.lit(steps), F.lit(0), advance)


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate, from the sizes of the files that are read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def with_previous(df: DataFrame, series: list[str], time: str, values: list[str], ranges: int | None = None) -> DataFrame:
    """Add `_previous`: struct of `time` and `values` of the preceding point of the same series, null on the first.

    Points are ordered by time, ties by the values. A plain `lag` sorts a whole series in one task; that is done where the
    input as a whole is estimated at no more than `ONE_TASK` bytes. Beyond that one series may hold a third of all rows,
    even within an hour. So the points are cut into ranges of (series, time) of about equal size, and the lag runs per
    range: one exchange, one sort, one window over all points. The last point of each range then goes to the first
    point of the next, through a table of one row per range. `ranges` is their number (by default that of shuffle
    partitions); their bounds are drawn from the points, so this runs a first job.
    """
    keys = [column(s) for s in series]
    if ranges is None:
        if _estimated_bytes(df) <= ONE_TASK:
            point = F.struct(*[column(c).alias(c) for c in (time, *values)])
            in_series = Window.partitionBy(*keys).orderBy(column(time), *[column(v) for v in values])
            return df.withColumn("_previous", F.lag(point).over(in_series))
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.xxhash64(*keys)
    point = F.struct(hashed.alias("h"), column(time).cast("bigint").alias("t"))
    points = df.withColumn("_range", _range_of(point, _bounds(df, keys, time, ranges))).repartition("_range")

    order = [F.xxhash64(*keys), *keys, column(time), *[column(v) for v in values]]
    place = F.struct(hashed.alias("hash"), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("series"),
                     F.struct(*[column(c).alias(c) for c in (time, *values)]).alias("point"))
    in_range = Window.partitionBy("_range").orderBy(*order)
    # as many rows as ranges: each range's last point, handed to the next range that has points
    last = points.groupBy("_range").agg(F.max(place).alias("_place"))
    handed = last.select(F.col("_range").alias("_at"), F.lag("_place").over(Window.orderBy("_range")).alias("_handed"))

    lagged = points.withColumn("_before", F.lag(place).over(in_range))
    joined = lagged.join(handed, F.col("_range") == F.col("_at"), "left")
    before = F.coalesce("_before", "_handed")
    same = before["series"].eqNullSafe(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    return joined.withColumn("_previous", F.when(same, before["point"])).drop("_range", "_before", "_at", "_handed")


def delta(value: str) -> Column:
    """Value minus that of the previous point; the value itself on the first point of a series."""
    before = F.col("_previous").getField(value)
    return F.when(F.col("_previous").isNull(), column(value)).otherwise(column(value) - before)
