"""Packets to flat tables batch by batch: every packet with its own id, files by size, counters per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from otelier.operators.packets import ingest_counters, packet_outcome
from otelier.sources.flat import FLATTEN, with_event_hour
from otelier.sources.packets import CORRUPT, numbered, parse_packets, stream_payloads

BATCH = "ingest_batch"


def _replace_batch(df: DataFrame, number: int, path: str, *hours: str) -> None:
    """Write the rows of a batch in place of what an earlier attempt at it has written."""
    rows = df.withColumn(BATCH, F.lit(number))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*hours, BATCH).parquet(path)


def ingest(
    spark: SparkSession, signal: str, path: str, checkpoint: str, source: str = "text", options: dict[str, str] | None = None,
    id_encoding: str = "base64", default_resource_attributes: str | None = None, hourly: bool = False, once: bool = False,
    every: str = "5 minutes",
) -> StreamingQuery:
    """Stream packets into the flat table `path/rows`, and one row of counters per batch into `path/counters`.

    Inside a batch packets are numbered and parsed as in a batch read, so equal lines of a file are packets of their own
    and ids are those that `read_packets` gives. A batch that runs again replaces its own partition (`ingest_batch`), so
    rows are neither lost nor doubled. With `hourly` rows are also partitioned by `event_hour`; a rebalance sizes the
    files of an hour by its data, in as many tasks as that takes. `once` takes what is there and stops. Counters hold
    packets, rejected packets and those of `ingest_counters`.
    """

    def take(payloads: DataFrame, number: int) -> None:
        seen = Observation()
        lost = F.col(CORRUPT).isNotNull()
        packets = parse_packets(numbered(payloads), signal, id_encoding).observe(
            seen, F.count(F.lit(1)).alias("packets"), F.count_if(lost).alias("rejected_packets"))
        rows = FLATTEN[signal](packets.drop(CORRUPT), default_resource_attributes)
        if hourly:
            rows = with_event_hour(rows, signal).hint("rebalance", "event_hour")
        _replace_batch(rows, number, f"{path}/rows", *(["event_hour"] if hourly else []))
        counted = seen.get
        written = payloads.sparkSession.read.schema(rows.withColumn(BATCH, F.lit(number)).schema).parquet(f"{path}/rows")
        counters = ingest_counters(packet_outcome(written.filter(F.col(BATCH) == number), signal), signal)
        _replace_batch(counters.select("*", F.lit(counted["packets"]).cast("bigint").alias("packets"),
                                       F.lit(counted["rejected_packets"]).cast("bigint").alias("rejected_packets")), number, f"{path}/counters")

    writer = stream_payloads(spark, source, options).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all batches so far, added up per signal, and how many batches there were."""
    names = ("request_items", "dropped_request_items", "succeeded_requests", "partially_succeeded_requests", "packets", "rejected_packets")
    return spark.read.parquet(f"{path}/counters").groupBy("signal").agg(
        *[F.sum(c).alias(c) for c in names], F.count_distinct(BATCH).alias("batches"))
