"""Flat tables in and out, event time, and one entry point for all input layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from otelier.functions.expressions import NANOS_PER_HOUR, column, nanos_to_timestamp
from otelier.operators.flatten import flatten_logs, flatten_metrics, flatten_spans
from otelier.operators.profiles_flatten import flatten_profiles
from otelier.schemas import EVENT_TIME, FLAT_DDL, flat_schema
from otelier.session import scratch_path
from otelier.sources.packets import read_packets, stream_packets

FLATTEN = {
    "logs": flatten_logs,
    "spans": flatten_spans,
    "metrics": flatten_metrics,
    "profiles": flatten_profiles,
}

# ---------------------------------------------------------------- in


def read_flat(spark: SparkSession, signal: str, path: str) -> DataFrame:
    """A directory of flat Parquet files as one table; filters and columns reach the scan."""
    return spark.read.schema(FLAT_DDL[signal]).parquet(path)


def read_signal(
    spark: SparkSession, signal: str, layout: str, path: str, id_encoding: str = "base64",
    default_resource_attributes: str | None = None, equal_lines: bool = True,
) -> DataFrame:
    """Flat rows from any of the input modes: 4 signals x {raw, flat}. Raw packets are flattened as they are read, and
    resources get the default attributes (`k=v,k2=v2`) that they lack; for `equal_lines` see `read_packets`."""
    if layout == "flat":
        return read_flat(spark, signal, path)
    if layout == "raw":
        packets = read_packets(spark, signal, path, id_encoding, equal_lines).drop("corrupt_record")
        return FLATTEN[signal](packets, default_resource_attributes)
    raise ValueError(f"layout is raw or flat, not {layout!r}")


def stream_signal(
    spark: SparkSession, signal: str, layout: str, path: str, id_encoding: str = "base64",
    default_resource_attributes: str | None = None,
) -> DataFrame:
    """`read_signal` as a stream over a growing directory."""
    if layout == "flat":
        return spark.readStream.schema(FLAT_DDL[signal]).parquet(path)
    if layout == "raw":
        packets = stream_packets(spark, signal, "text", {"path": path}, id_encoding).drop("corrupt_record")
        return FLATTEN[signal](packets, default_resource_attributes)
    raise ValueError(f"layout is raw or flat, not {layout!r}")


def with_event_time(df: DataFrame, signal: str) -> DataFrame:
    """Add `event_time`, the timestamp of the record's own time in nanoseconds."""
    return df.withColumn("event_time", nanos_to_timestamp(EVENT_TIME[signal]))


def read_hourly(spark: SparkSession, signal: str, path: str, start_nanos: int, end_nanos: int) -> DataFrame:
    """Rows of [start, end) from an hourly table. The hours prune partitions, the nanos filter within them."""
    schema = T.StructType([*flat_schema(signal).fields, T.StructField("event_hour", T.TimestampType())])
    table = spark.read.schema(schema).parquet(path)
    first, last = start_nanos // NANOS_PER_HOUR, (end_nanos - 1) // NANOS_PER_HOUR
    time = F.col(EVENT_TIME[signal])
    return table.filter(
        (F.col("event_hour") >= F.timestamp_seconds(F.lit(first * 3600)))
        & (F.col("event_hour") <= F.timestamp_seconds(F.lit(last * 3600)))
        & (time >= start_nanos) & (time < end_nanos)
    )


# ---------------------------------------------------------------- out

# The limits of one output file that small collectors use. Too small for a large cluster; pass them where wanted.
SMALL_FILES = {"row_group_bytes": 1 << 20, "max_records_per_file": 10_000, "max_file_bytes": 10 << 20}

#: How much smaller than the limit files are planned, as rows of a file do not compress alike.
_MARGIN = 1.5


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of a table's files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def _with_file(df: DataFrame) -> DataFrame:
    """The rows of stored files with the file and their place in it."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))


def _cut(stored: DataFrame, plan: DataFrame, by_rows: bool) -> DataFrame:
    """The rows of files that are too large, dealt in their order to `pieces` tasks for each file, from task `first` on. Cuts
    follow the number of the rows, which needs no sort of them, or their length as text, where rows differ in size."""
    names = [column(c) for c in stored.columns]
    rows = _with_file(stored).join(plan, F.col("_file") == F.col("file"))
    if by_rows:
        share = F.col("_index") / F.col("rows")
    else:
        rows = rows.withColumn("_size", F.octet_length(F.to_json(F.struct(*names))))
        in_file = Window.partitionBy("_file")
        upto = in_file.orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
        share = F.coalesce(F.sum("_size").over(upto), F.lit(0)) / F.sum("_size").over(in_file)
    piece = (F.col("first") + F.floor(share * F.col("pieces"))).cast("int")
    total = plan.agg(F.sum("pieces")).first()[0]
    return rows.withColumn("_piece", piece).repartitionById(int(total), "_piece").sortWithinPartitions("_file", "_index").select(*names)


def _in_small_files(df: DataFrame, max_file_bytes: int, options: dict[str, int]) -> DataFrame:
    """The rows dealt to as many tasks as there must be files, each of them for one file below the limit.

    Sizes are known only once rows are encoded, and small files hold more bytes than their share of a large one. So the table
    is written to the scratch folder first, files that came out too large are cut and written again, until all that hold
    more than a row are small enough. Each of these files then becomes one task, with the same rows in the same order.
    """
    spark, schema, base = df.sparkSession, df.schema, scratch_path(df.sparkSession, "limited")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    small, number = [], 0
    while True:
        path = f"{base}/{number}"
        df.write.options(**options).parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        counted = _with_file(stored).groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        # written down, since each use would open all files again
        file_sizes(spark, path).join(counted, "file").withColumn(
            "pieces", F.when((F.col("bytes") > max_file_bytes) & (F.col("rows") > 1),
                             F.least(F.col("rows"), F.ceil(F.col("bytes") * _MARGIN / max_file_bytes)))).write.parquet(f"{base}/sizes-{number}")
        sizes = spark.read.schema("file string, bytes long, rows long, pieces long").parquet(f"{base}/sizes-{number}")
        small.append(sizes.filter("pieces IS NULL").select("file"))
        plan = sizes.filter("pieces IS NOT NULL").select("file", "rows", "pieces", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
        if plan.isEmpty():
            break
        df, number = _cut(stored, plan, by_rows=number % 2 == 0), number + 1
    files = small[0]
    for more in small[1:]:
        files = files.unionByName(more)
    files = files.withColumn("_piece", F.row_number().over(Window.orderBy("file")) - 1)
    total = files.count()
    if not total:
        return df
    kept = spark.read.schema(schema).parquet(*[f"{base}/{i}" for i in range(number + 1)])
    dealt = _with_file(kept).join(files, F.col("_file") == F.col("file")).repartitionById(total, "_piece")
    return dealt.sortWithinPartitions("_index").select(*[column(c) for c in schema.names])


def write_flat(
    df: DataFrame, signal: str, base: str, row_group_bytes: int | None = None,
    max_records_per_file: int | None = None, max_file_bytes: int | None = None,
) -> str:
    """Append rows to the flat table of a signal in `base/<signal>` and return its path. No shuffle, unless
    `max_file_bytes` limits the files: then rows are written to the scratch folder first, to learn their sizes. A single
    row larger than the limit is a file of its own."""
    limits = {"parquet.block.size": row_group_bytes, "maxRecordsPerFile": max_records_per_file}
    options = {name: value for name, value in limits.items() if value}
    if max_file_bytes:
        df = _in_small_files(df, max_file_bytes, options)
    path = f"{base}/{signal}"
    df.write.mode("append").options(**options).parquet(path)
    return path


def with_event_hour(df: DataFrame, signal: str) -> DataFrame:
    return df.withColumn("event_hour", F.date_trunc("hour", nanos_to_timestamp(EVENT_TIME[signal])))


def write_hourly(df: DataFrame, signal: str, path: str) -> str:
    """Append rows in hour partitions (`event_hour`), without roll-up.

    The rebalance hint gives an hour few large files instead of one per task, and splits an hour that holds much
    of the data over several tasks.
    """
    rows = with_event_hour(df, signal).hint("rebalance", "event_hour")
    rows.write.mode("append").partitionBy("event_hour").parquet(path)
    return path


_META = "run_metadata"


def with_run_metadata(df: DataFrame, metadata: dict[str, str]) -> DataFrame:
    """Attach key-values to everything written from this frame. They travel with the schema in each file's footer."""
    first = df.columns[0]
    return df.withMetadata(first, {**df.schema[first].metadata, _META: dict(metadata)})


def run_metadata(df: DataFrame) -> dict[str, str]:
    """The key-values a table was written with."""
    return dict(df.schema[df.columns[0]].metadata.get(_META, {}))


def write_all(frames: dict[str, DataFrame], base: str, **limits) -> dict[str, str]:
    """One location per signal: {signal: path}."""
    return {signal: write_flat(df, signal, base, **limits) for signal, df in frames.items()}


def write_prepared(df: DataFrame, path: str) -> str:
    """Save a prepared (wide, exploded) table, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
    return path
