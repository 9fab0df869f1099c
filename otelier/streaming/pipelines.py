"""Continuous ingestion: packets to flat tables, and retransmissions dropped on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from otelier.functions.expressions import column
from otelier.operators.relational import METRIC_VALUE_COLUMNS
from otelier.schemas import LINEAGE, flat_schema
from otelier.sources.flat import FLATTEN, with_event_hour, with_event_time

FILE_AGE = "5 minutes"


def stream_rows(packets: DataFrame, signal: str, default_resource_attributes: str | None = None) -> DataFrame:
    """Flat rows of a packet stream; the same narrow operator as in batch, so no state."""
    return FLATTEN[signal](packets.drop("corrupt_record"), default_resource_attributes)


def write_stream(
    rows: DataFrame, signal: str, path: str, checkpoint: str, hourly: bool = False, once: bool = False,
    every: str = FILE_AGE, files_per_hour: int = 8,
) -> StreamingQuery:
    """Append a stream of flat rows to Parquet: plain, one file per task and trigger, or in hour partitions.

    Rows of one hour are dealt to `files_per_hour` tasks by packet, so a trigger writes that many files per hour at most,
    and an hour that holds most rows is no single task. `once` takes what is there and stops. The checkpoint makes
    the sink exactly-once over failures.
    """
    if hourly:
        part = F.pmod(F.xxhash64("batch_UUID"), F.lit(files_per_hour))
        rows = with_event_hour(rows, signal).repartition("event_hour", part)
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if hourly:
        writer = writer.partitionBy("event_hour")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(path)


def dedup_key(signal: str) -> list[str]:
    """What identifies a record across retransmissions: all columns but lineage and, for metrics, the values."""
    skip = {*LINEAGE[signal], *(METRIC_VALUE_COLUMNS if signal == "metrics" else ())}
    return [f.name for f in flat_schema(signal).fields if f.name not in skip]


def stream_dedup(rows: DataFrame, signal: str, delay: str = "1 hour") -> DataFrame:
    """Drop retransmissions that arrive within `delay` of the first copy.

    The watermark follows the time of arrival, so a record that is new stays, however old the event it tells of. State
    is one hash per record and is dropped behind the watermark, so it is bounded by the delay. The key is a
    256-bit hash of the compared columns; equal rows meet in one state partition, the copies of a record are
    dropped as they come and are never collected.
    """
    key = F.sha2(F.to_json(F.struct(*[column(c) for c in dedup_key(signal)])), 256)
    return (
        with_event_time(rows, signal)
        .withColumn("_key", key)
        .withColumn("_arrival", F.timestamp_millis("batch_timestamp"))
        .withWatermark("_arrival", delay)
        .dropDuplicatesWithinWatermark(["_key"])
        .drop("_key", "_arrival")
    )
