"""Queries that write and read: sources, sinks and streams, checked by what comes back.

Everything goes to a fresh folder below the cluster's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from otelier.operators.metrics import metric_exploded
from otelier.plans import fixtures
from otelier.plans.fixtures import packet_text
from otelier.plans.metric_queries import _EXPLODED, point_key, prepared
from otelier.plans.oracle import LOGS, POINTS, PROFILES, SPANS, STATS, micros_text
from otelier.plans.registry import attribute, hexed, query
from otelier.schemas import SIGNALS, snake
from otelier.session import scratch_path
from otelier.sources.flat import (
    SMALL_FILES, file_sizes, read_flat, read_hourly, read_signal, run_metadata, stream_signal, with_event_time, with_run_metadata, write_all,
    write_flat, write_hourly, write_prepared,
)
from otelier.sources.packets import read_packets, stream_packets
from otelier.streaming.ingest import ingest, read_counters
from otelier.streaming.pipelines import stream_dedup, stream_rows, write_stream

LOG_SQL = """
SELECT time_ns, service, severity_text, body_type, body_string, body_int, k, trace_id, span_id FROM logs"""


def log_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("time_unix_nano").alias("time_ns"), attribute("resource_attributes", "service.name", "service"),
        "severity_text", "body_type", "body_string", "body_int",
        attribute("attributes", "k", "k").cast("bigint"), *hexed("trace_id", "span_id"))


#: Lines that are no packets: cut off, an unknown field at the top, one in a record, one in a nested value.
BROKEN = ('{"resourceLogs": [{', '{"resourceLogz":[]}', '{"resource_logs":[{"scopeLogs":[{"log_records":[{"colour":1}]}]}]}',
          '{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"body":{"arrayValue":{"values":[{"textValue":"x"}]}}}]}]}]}')


#: Lines of one compressed file, which a single task must read. Even, so neighbouring copies of a line share a file.
LINES_PER_FILE = 10_000


def write_lines(lines: DataFrame, path: str) -> None:
    """Append JSON lines, compressed, since field names and ids make up most of them."""
    lines.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)


def write_packets(spark: SparkSession, sf: str, signal: str, copies: int = 1, broken: bool = False) -> str:
    """Packets of a signal as a directory of compressed JSON lines; with `broken`, about half of them with field names in
    snake_case, and lines that are no packets."""
    path = scratch_path(spark, f"packets-{signal}")
    text = packet_text(signal)
    if broken:
        text = F.when(F.xxhash64("batch_UUID") % 2 == 0, packet_text(signal, snake)).otherwise(text)
    lines = fixtures.PACKETS[signal](spark, sf).select(text.alias("value"))
    for _ in range(copies):
        write_lines(lines, path)
    if broken:
        write_lines(spark.createDataFrame([(line,) for line in BROKEN], "value string"), path)
    return path


# what a signal's rows must hold besides their number: (column, its SQL counterpart, SQL table, text column and counterpart)
CONTENT = {
    "logs": ("time_unix_nano", "time_ns", "logs", "severity_text", "severity_text"),
    "spans": ("start_time_unix_nano", "start_ns", "spans", "name", "name"),
    "metrics": ("time_unix_nano", "time_ns", "points", "name", "name"),
    "profiles": ("value", "value", "profile_rows", None, None),
}


def counts_sql(layouts: tuple[str, ...], signals: tuple[str, ...] = SIGNALS) -> str:
    """Rows per signal and layout, with sums over a number and over the length of a text."""
    return " UNION ALL ".join(
        f"SELECT '{s}' AS signal, '{layout}' AS layout, count(*) AS n, CAST(sum({number} % 1000003) AS BIGINT) AS numbers, "
        f"CAST({f'sum(length({text}))' if text else 0} AS BIGINT) AS texts FROM {t}"
        for s, (_, number, t, _, text) in CONTENT.items() if s in signals for layout in layouts)


def sums(signal: str) -> list[Column]:
    number, _, _, text, _ = CONTENT[signal]
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col(number) % 1000003).alias("numbers"),
            (F.sum(F.length(text)) if text else F.lit(0)).cast("bigint").alias("texts")]


def counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    rows = [
        df.groupBy().agg(*sums(a)).select(F.lit(a).alias("signal"), F.lit(b).alias("layout"), "n", "numbers", "texts")
        for (a, b), df in tables.items()
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table


@query("src_flat", LOG_SQL, LOGS)
def flat_source(spark, sf):
    path = write_flat(fixtures.logs(spark, sf), "logs", scratch_path(spark, "flat"))
    return log_view(read_flat(spark, "logs", path))


@query("src_raw_json", LOG_SQL, LOGS)
def json_source(spark, sf):
    return log_view(read_signal(spark, "logs", "raw", write_packets(spark, sf, "logs", broken=True)))


@query("src_raw_json_rejected", f"""
SELECT CAST(count(DISTINCT batch) AS BIGINT) AS parsed, CAST({len(BROKEN)} AS BIGINT) AS rejected,
  '{" ".join(sorted(BROKEN))}' AS payloads FROM logs""", LOGS)
def rejected_packets(spark, sf):
    packets = read_packets(spark, "logs", write_packets(spark, sf, "logs", broken=True))
    lost = F.col("corrupt_record")
    return packets.agg(F.count_if(lost.isNull()).alias("parsed"), F.count_if(lost.isNotNull()).alias("rejected"),
                       F.array_join(F.array_sort(F.collect_list(lost)), " ").alias("payloads"))


@query("src_dispatch", counts_sql(("raw", "flat")), LOGS, SPANS, POINTS, PROFILES)
def dispatch(spark, sf):
    """Raw rows are counted as they pass on to the flat table, so packets are parsed once."""
    base, tables, raw_rows = scratch_path(spark, "dispatch"), {}, []
    for signal in SIGNALS:
        raw, seen = read_signal(spark, signal, "raw", write_packets(spark, sf, signal)), Observation()
        tables[signal, "flat"] = read_signal(spark, signal, "flat", write_flat(raw.observe(seen, *sums(signal)), signal, base))
        raw_rows.append(F.struct(F.lit(signal).alias("signal"), F.lit("raw").alias("layout"), *[
            F.lit(seen.get[c]).cast("bigint").alias(c) for c in ("n", "numbers", "texts")]))
    return counts(tables).unionByName(spark.range(1).select(F.inline(F.array(*raw_rows))))


@query("src_stream", LOG_SQL, LOGS)
def stream_source(spark, sf):
    return log_view(ingested(spark, "logs", write_packets(spark, sf, "logs")))


def ingested(spark: SparkSession, signal: str, packets: str, **options) -> DataFrame:
    """The flat rows of a directory of packets by way of a stream."""
    out = scratch_path(spark, "ingest")
    ingest(spark, signal, out, f"{out}/checkpoint", options={"path": packets, **options}, once=True).awaitTermination()
    return read_flat(spark, signal, f"{out}/rows")


@query("src_dispatch_stream", counts_sql(("raw", "flat")), LOGS, SPANS, POINTS, PROFILES)
def dispatch_streams(spark, sf):
    """All signals and layouts as streams."""
    tables = {}
    for signal in SIGNALS:
        raw = ingested(spark, signal, write_packets(spark, sf, signal))
        tables[signal, "raw"] = raw
        out = scratch_path(spark, "stream")
        flat = stream_signal(spark, signal, "flat", write_flat(raw, signal, f"{out}/in"))
        write_stream(flat, signal, f"{out}/{signal}", f"{out}/checkpoint", once=True).awaitTermination()
        tables[signal, "flat"] = read_flat(spark, signal, f"{out}/{signal}")
    return counts(tables)


@query("stream_lineage", """
SELECT CAST(2 * count(DISTINCT batch) AS BIGINT) AS packets, CAST(2 * count(*) AS BIGINT) AS n,
  CAST(2 * count(DISTINCT batch) AS BIGINT) AS same_ids FROM logs""", LOGS)
def stream_lineage(spark, sf):
    """Every line twice in one file, in as many files as tasks write: twice the packets, with the ids that a batch read gives
    them."""
    path = scratch_path(spark, "twice")
    lines = spark.read.text(write_packets(spark, sf, "logs"))
    write_lines(lines.select(F.explode(F.array("value", "value")).alias("value")), path)
    streamed = ingested(spark, "logs", path).groupBy("batch_UUID").agg(F.count(F.lit(1)).alias("n"))
    # compressed files look small enough to broadcast their ids, of which the driver would hold one per packet
    read = read_packets(spark, "logs", path).select("batch_UUID", F.lit(1).alias("read")).hint("merge")
    return streamed.join(read, "batch_UUID", "left").agg(
        F.count_distinct("batch_UUID").alias("packets"), F.sum("n").alias("n"), F.count("read").alias("same_ids"))


@query("stream_counters", """
SELECT 'profiles' AS signal, count(*) AS items, count(*) FILTER (WHERE NOT is_valid) AS dropped,
  count(DISTINCT batch) AS packets, count(DISTINCT batch) FILTER (WHERE NOT is_valid) AS partly,
  count(DISTINCT batch) - count(DISTINCT batch) FILTER (WHERE NOT is_valid) AS succeeded,
  CAST(1 AS BIGINT) AS rejected_packets, CAST(3 AS BIGINT) AS batches FROM profile_rows""", PROFILES)
def stream_counters(spark, sf):
    """Counters of a stream that takes three batches; one of its packets is broken."""
    path, out = scratch_path(spark, "packets-profiles"), scratch_path(spark, "ingest")
    lines = fixtures.PACKETS["profiles"](spark, sf).select(packet_text("profiles").alias("value"))
    tasks = max(9, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_lines(lines.unionByName(spark.createDataFrame([('{"resourceProfilez":[]}',)], "value string")).repartition(tasks, F.rand(1)), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).count()
    # a third of the files, rounded up, makes three batches of any number from five on
    options = {"path": path, "maxFilesPerTrigger": str(-(-files // 3))}
    ingest(spark, "profiles", out, f"{out}/checkpoint", options=options, once=True).awaitTermination()
    return read_counters(spark, out).select(
        "signal", F.col("request_items").alias("items"), F.col("dropped_request_items").alias("dropped"),
        (F.col("packets") - F.col("rejected_packets")).alias("packets"), F.col("partially_succeeded_requests").alias("partly"),
        F.col("succeeded_requests").alias("succeeded"), "rejected_packets", "batches")


@query("event_time", f"""
SELECT 'logs' AS signal, {micros_text('time_ns')} AS event_time, count(*) AS n FROM logs GROUP BY 2
UNION ALL SELECT 'spans', {micros_text('start_ns')}, count(*) FROM spans GROUP BY 2
UNION ALL SELECT 'metrics', {micros_text('time_ns')}, count(*) FROM points GROUP BY 2""", LOGS, SPANS, POINTS)
def event_times(spark, sf):
    tables = {"logs": fixtures.logs(spark, sf), "spans": fixtures.spans(spark, sf),
              "metrics": fixtures.metric_rows(spark, sf)}
    parts = [
        with_event_time(df, s).groupBy(
            F.lit(s).alias("signal"), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        ).agg(F.count(F.lit(1)).alias("n")) for s, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SMALL = 256 << 10


@query("snk_flat", f"""
SELECT n, numbers, texts, true AS within_limits, true AS several_files FROM ({counts_sql(("flat",), ("spans",))})""", SPANS)
def flat_sink(spark, sf):
    """What was written, and whether each file keeps the limits of rows and bytes."""
    limits = {**SMALL_FILES, "max_file_bytes": SMALL}
    path = write_flat(fixtures.spans(spark, sf), "spans", scratch_path(spark, "sink"), **limits)
    back = read_flat(spark, "spans", path)
    rows = back.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    files = file_sizes(spark, path).join(rows, "file").agg(
        (F.max("bytes") <= SMALL).alias("small"), (F.max("rows") <= limits["max_records_per_file"]).alias("few"), F.count("*").alias("files"))
    return counts({("spans", "flat"): back}).join(files.withColumn("signal", F.lit("spans")), "signal").select(
        "n", "numbers", "texts", F.expr("small AND few").alias("within_limits"), F.expr("files > 1").alias("several_files"))


# ten days in the middle of the events
_FROM, _TO = 1_704_844_800_000_000_000, 1_705_708_800_000_000_000


@query("snk_hourly", f"""
SELECT strftime(date_trunc('hour', make_timestamp(time_ns // 1000)), '%Y-%m-%d %H') AS hour, severity_text, count(*) AS n,
  CAST(sum(time_ns % 1000003) AS BIGINT) AS times,
  count(*) FILTER (time_ns >= {_FROM} AND time_ns < {_TO}) AS in_window FROM logs GROUP BY 1, 2""", LOGS)
def hourly_sink(spark, sf):
    """Every hour of the table that was written, and what a read of ten days finds in it."""
    path = write_hourly(fixtures.logs(spark, sf), "logs", scratch_path(spark, "hourly"))
    keys = [F.date_format("event_hour", "yyyy-MM-dd HH").alias("hour"), "severity_text"]
    every = read_hourly(spark, "logs", path, 0, 1 << 62).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("time_unix_nano") % 1000003).alias("times"))
    window = read_hourly(spark, "logs", path, _FROM, _TO).groupBy(*keys).agg(F.count(F.lit(1)).alias("in_window"))
    return every.join(window, ["hour", "severity_text"], "left").fillna(0, ["in_window"])


@query("snk_run_meta", f"""
SELECT 'nightly' AS run, 'eu-1' AS site, n, numbers, texts FROM ({counts_sql(("flat",), ("logs",))})""", LOGS)
def metadata_sink(spark, sf):
    rows = with_run_metadata(fixtures.logs(spark, sf), {"run": "nightly", "site": "eu-1"})
    path = write_flat(rows, "logs", scratch_path(spark, "metadata"))
    back = spark.read.parquet(path)
    found = run_metadata(back)
    return counts({("logs", "flat"): back}).select(
        F.lit(found.get("run")).alias("run"), F.lit(found.get("site")).alias("site"), "n", "numbers", "texts")


@query("snk_signals", counts_sql(("flat",)), LOGS, SPANS, POINTS, PROFILES)
def all_signals(spark, sf):
    frames = {"logs": fixtures.logs(spark, sf), "spans": fixtures.spans(spark, sf),
              "metrics": fixtures.metric_rows(spark, sf), "profiles": fixtures.profile_rows(spark, sf)}
    paths = write_all(frames, scratch_path(spark, "signals"))
    return counts({(s, "flat"): read_flat(spark, s, p) for s, p in paths.items()})


@query("snk_prepared", """
SELECT emitter, event_type, start_ns, time_ns, name, stat, value FROM exploded""", STATS, _EXPLODED)
def prepared_sink(spark, sf):
    path = write_prepared(metric_exploded(prepared(spark, sf)), scratch_path(spark, "prepared"))
    return spark.read.parquet(path).select(
        *point_key(), "name", F.col("population_stat").alias("stat"), "value")


@query("stream_flat", """
SELECT strftime(date_trunc('hour', make_timestamp(time_ns // 1000)), '%Y-%m-%d %H') AS hour, service,
  severity_text, count(*) AS n, CAST(sum(k) AS BIGINT) AS k FROM logs GROUP BY 1, 2, 3""", LOGS)
def streamed(spark, sf):
    out = scratch_path(spark, "stream")
    ingest(spark, "logs", out, f"{out}/checkpoint", options={"path": write_packets(spark, sf, "logs")}, hourly=True,
           once=True).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.groupBy(
        F.date_format("event_hour", "yyyy-MM-dd HH").alias("hour"),
        attribute("resource_attributes", "service.name", "service"), "severity_text",
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(attribute("attributes", "k", "k").cast("bigint")).alias("k"))


@query("stream_dedup", LOG_SQL, LOGS)
def stream_deduplicated(spark, sf):
    # every packet is sent twice; arrival order is not event order
    packets = stream_packets(spark, "logs", "text", {"path": write_packets(spark, sf, "logs", copies=2)})
    out = scratch_path(spark, "stream")
    rows = stream_dedup(stream_rows(packets, "logs"), "logs")
    write_stream(rows, "logs", f"{out}/logs", f"{out}/checkpoint", once=True).awaitTermination()
    return log_view(read_flat(spark, "logs", f"{out}/logs"))
