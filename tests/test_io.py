"""Sinks, hourly partitions, run metadata and streams."""

import os

import pytest
from pyspark.sql import functions as F

from otelier.operators.packets import deflatten, packet_outcome
from otelier.plans import fixtures
from otelier.plans.fixtures import encode_packets
from otelier.plans.io_queries import write_packets
from otelier.session import scratch_path
from otelier.sources.flat import (
    FLATTEN, SMALL_FILES, _cut, file_sizes, read_flat, read_hourly, read_signal, run_metadata, stream_signal, with_event_time, with_run_metadata,
    write_all, write_flat, write_hourly,
)
from otelier.sources.packets import read_packets, stream_packets
from otelier.streaming.ingest import ingest, read_counters
from otelier.streaming.pipelines import stream_dedup, stream_rows, write_stream
from tests.test_packets import text


def test_write_flat_appends_and_limits_files(spark, sf, tmp_path):
    rows = fixtures.spans(spark, sf)
    path = write_flat(rows, "spans", str(tmp_path), **{**SMALL_FILES, "max_records_per_file": 500})
    assert path == write_flat(rows, "spans", str(tmp_path))
    back = read_flat(spark, "spans", path)
    assert back.count() == 2 * rows.count()
    per_file = back.groupBy("_metadata.file_path").count().orderBy("count")
    assert per_file.first()["count"] <= 500


def test_hourly_read_prunes_partitions(spark, sf, tmp_path):
    logs = fixtures.logs(spark, sf)
    path = write_hourly(logs, "logs", str(tmp_path / "hourly"))
    low, high = 1_704_844_800_000_000_000, 1_704_931_200_000_000_000 + 5
    rows = read_hourly(spark, "logs", path, low, high)
    expected = logs.filter((F.col("time_unix_nano") >= low) & (F.col("time_unix_nano") < high))
    assert rows.count() == expected.count() > 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_hour" in partition_filters and ">=" in partition_filters


def test_run_metadata_survives(spark, sf, tmp_path):
    rows = with_run_metadata(fixtures.logs(spark, sf), {"run": "7"})
    path = write_all({"logs": rows}, str(tmp_path))["logs"]
    assert run_metadata(spark.read.parquet(path)) == {"run": "7"}
    assert run_metadata(fixtures.logs(spark, sf)) == {}


def test_event_time(spark, sf):
    row = with_event_time(fixtures.spans(spark, sf), "spans").select(
        F.unix_micros("event_time"), "start_time_unix_nano").first()
    assert row[0] == row[1] // 1000


def test_scratch_path_follows_the_session(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


def stream(spark, signal, source, tmp_path, name, transform=lambda rows: rows, **kwargs):
    rows = transform(stream_rows(stream_packets(spark, signal, "text", {"path": source, "maxFilesPerTrigger": "2"}), signal))
    out = str(tmp_path / name)
    write_stream(rows, signal, out, out + "-checkpoint", once=True, **kwargs).awaitTermination()
    return out


def test_stream_equals_batch(spark, sf, tmp_path):
    for signal in FLATTEN:
        source = str(tmp_path / f"in-{signal}")
        encode_packets(fixtures.PACKETS[signal](spark, sf), signal).repartition(5).write.text(source)
        out = stream(spark, signal, source, tmp_path, f"out-{signal}")
        # a stream notes when a packet arrives; a batch numbers the lines of a file
        lineage = ("batch_timestamp", "batch_UUID")
        batch = read_signal(spark, signal, "raw", source)
        assert text(read_flat(spark, signal, out).drop(*lineage)) == text(batch.drop(*lineage)), signal


def test_stream_continues_where_it_stopped(spark, sf, tmp_path):
    source = str(tmp_path / "in")
    sent = encode_packets(fixtures.log_packets(spark, sf), "logs")
    sent.write.text(source)
    stream(spark, "logs", source, tmp_path, "out", hourly=True)
    sent.limit(3).write.mode("append").text(source)
    out = stream(spark, "logs", source, tmp_path, "out", hourly=True)
    assert spark.read.parquet(out).count() == read_signal(spark, "logs", "raw", source).count()
    assert "event_hour" in spark.read.parquet(out).columns


def test_stream_dedup_across_triggers(spark, sf, tmp_path):
    source = str(tmp_path / "in")
    sent = encode_packets(fixtures.log_packets(spark, sf), "logs").repartition(3)
    for _ in range(3):
        sent.write.mode("append").text(source)
    out = stream(spark, "logs", source, tmp_path, "out", lambda rows: stream_dedup(rows, "logs"))
    lineage = ("batch_timestamp", "batch_UUID", "seq_no")
    assert text(read_flat(spark, "logs", out).drop(*lineage)) == text(fixtures.logs(spark, sf).drop(*lineage))


def test_late_new_records_are_kept(spark, tmp_path):
    """Three triggers, each with one log; the third tells of an event ten days older, and the second comes twice."""
    source, now = str(tmp_path / "in"), 1_700_000_000_000_000_000
    day = 86_400_000_000_000

    def send(nanos):
        line = '{"resourceLogs": [{"scopeLogs": [{"logRecords": [{"timeUnixNano": "%d"}]}]}]}' % nanos
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(source)
        return stream(spark, "logs", source, tmp_path, "out", lambda rows: stream_dedup(rows, "logs"))

    for nanos in (now, now + day, now + day, now - 10 * day):
        out = send(nanos)
    assert [r[0] for r in read_flat(spark, "logs", out).select("time_unix_nano").orderBy("time_unix_nano").collect()] == [
        now - 10 * day, now, now + day]


def test_flat_tables_as_streams(spark, sf, tmp_path):
    """Flat rows stream on to hour partitions, with a bounded number of files per hour."""
    rows = fixtures.logs(spark, sf)
    path = write_flat(rows, "logs", str(tmp_path / "flat"))
    out = str(tmp_path / "out")
    write_stream(stream_signal(spark, "logs", "flat", path), "logs", out, out + "-checkpoint", hourly=True, once=True,
                 files_per_hour=2).awaitTermination()
    back = spark.read.parquet(out)
    assert text(back.drop("event_hour")) == text(rows)
    files = back.select("event_hour", F.col("_metadata.file_path").alias("f")).distinct().groupBy("event_hour").count()
    assert files.agg(F.max("count")).first()[0] <= 2
    with pytest.raises(ValueError):
        stream_signal(spark, "logs", "other", path)


# ---------------------------------------------------------------- limits of files, streams batch by batch


def test_files_stay_below_a_size(spark, tmp_path):
    """Rows of very different size, a third of them in one long text each."""
    rows = spark.range(6000).select(F.col("id").alias("time_unix_nano"), F.when(F.col("id") % 3 == 0, F.concat(
        *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(10)])).otherwise("x").alias("severity_text")).coalesce(2)
    path = write_flat(rows, "logs", str(tmp_path), max_file_bytes=200_000)
    sizes = [r["bytes"] for r in file_sizes(spark, path).collect()]
    assert max(sizes) <= 200_000 and sum(sizes) > 1_000_000 and len(sizes) < 20 * sum(sizes) / 200_000
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("time_unix_nano")).first()[:] == (6000, sum(range(6000)))
    assert write_flat(rows.limit(0), "logs", str(tmp_path / "none"), max_file_bytes=100)


LINES = ['{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"eventName":"e%d"}]}]}]}' % (i % 7) for i in range(40)]


def ids(df):
    return sorted(r["batch_UUID"] for r in df.select("batch_UUID").collect())


def test_ids_do_not_depend_on_splits_or_streams(spark, tmp_path):
    """Equal lines of a file are packets of their own, with the same ids however the file is read."""
    source = str(tmp_path / "in")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(source)
    whole = ids(read_packets(spark, "logs", source))
    assert len(set(whole)) == 40
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert ids(read_packets(spark, "logs", source)) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert set(ids(read_packets(spark, "logs", source, equal_lines=False))) < set(whole)
    out = str(tmp_path / "out")
    ingest(spark, "logs", out, f"{out}/checkpoint", options={"path": source}, once=True).awaitTermination()
    rows = read_flat(spark, "logs", f"{out}/rows")
    assert ids(rows) == whole
    assert packet_outcome(rows, "logs").count() == 40 and deflatten(rows, "logs").count() == 40


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(x,) for x in LINES], "value string").repartition(4).write.text(source)

    def run():
        ingest(spark, "logs", out, f"{out}/checkpoint", options={"path": source, "maxFilesPerTrigger": "1"}, hourly=True, once=True).awaitTermination()
        return ids(spark.read.parquet(f"{out}/rows"))

    first = run()
    batches = sorted(int(n) for n in os.listdir(f"{out}/checkpoint/commits") if n.isdigit())
    assert len(first) == 40 and len(batches) == 4
    # as if the driver had died before the last batch was marked as done
    for name in (str(batches[-1]), f".{batches[-1]}.crc"):
        if os.path.exists(f"{out}/checkpoint/commits/{name}"):
            os.unlink(f"{out}/checkpoint/commits/{name}")
    assert run() == first
    total = read_counters(spark, out).first()
    assert (total["packets"], total["request_items"], total["rejected_packets"], total["batches"]) == (40, 40, 0, 4)


def test_packets_are_written_compressed(spark, sf):
    """JSON lines repeat their field names; written plainly they filled the disk."""
    path = write_packets(spark, sf, "spans")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).agg(F.sum("length")).first()[0]
    text_bytes = spark.read.text(path).agg(F.sum(F.octet_length("value"))).first()[0]
    assert files * 5 < text_bytes


def test_small_files_of_many_columns_stay_below_a_size(spark, tmp_path):
    """What each file holds besides rows (its schema, a header per column) is much of a small file."""
    rows = spark.range(4000).select(F.col("id").alias("time_unix_nano"), F.sha2(F.col("id").cast("string"), 256).alias("c"), *[
        (F.col("id") % (i + 2)).alias(f"c{i}") for i in range(100)]).coalesce(1)
    path = write_flat(rows, "logs", str(tmp_path), max_file_bytes=40_000)
    sizes = [r["bytes"] for r in file_sizes(spark, path).collect()]
    assert max(sizes) <= 40_000 and len(sizes) > 5
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("time_unix_nano")).first()[:] == (4000, sum(range(4000)))


def test_a_large_row_among_small_ones_is_a_file_of_its_own(spark, tmp_path):
    """A row above the limit can't be cut; those around it still leave its file."""
    long = F.concat(*[F.sha2(F.lit(str(i)), 512) for i in range(400)])
    rows = spark.range(50).select(F.col("id").alias("time_unix_nano"), F.when(F.col("id") == 30, long).otherwise("x").alias("severity_text")).coalesce(1)
    path = write_flat(rows, "logs", str(tmp_path), max_file_bytes=20_000)
    back = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows")).join(file_sizes(spark, path), "file")
    large = back.filter("bytes > 20000").collect()
    assert [r["rows"] for r in large] == [1] and back.agg(F.sum("rows")).first()[0] == 50


def test_files_are_cut_by_rows_without_a_sort_of_all(spark, tmp_path):
    """Whole rows went through a window and were written as JSON to weigh them, also where they are alike."""
    path = str(tmp_path / "in")
    spark.range(900).select(F.col("id").alias("time_unix_nano"), F.lit("x").alias("severity_text")).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows")).select("file", "rows", F.lit(7).alias("pieces"), F.lit(0).alias("first"))
    for by_rows in (True, False):
        cut = _cut(stored, plan, by_rows=by_rows)
        text_plan = cut._jdf.queryExecution().executedPlan().toString()
        assert ("Window" in text_plan or "to_json" in text_plan) != by_rows
        pieces = cut.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("time_unix_nano").alias("a"), F.max("time_unix_nano").alias("z")).orderBy("a").collect()
        assert len(pieces) == 7 and sum(r["n"] for r in pieces) == 900 and all(r["z"] - r["a"] == r["n"] - 1 for r in pieces)
        assert max(r["n"] for r in pieces) <= 135
