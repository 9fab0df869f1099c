"""Telemetry derived from the star-schema tables, as nested packets and as flat rows.

Orders and their lines are spans, events are logs and (aggregated per hour) metrics, conversation turns are profile
samples. The packets are what an exporter would send. No packet grows with the data: its key holds a range of a
unique id (or a day of hourly values), so a customer, user or conversation with very many rows fills many packets.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from otelier.functions.anyvalue import make_attribute
from otelier.functions.expressions import let, no_items, place_in, running_totals, search_steps, typed_struct
from otelier.operators.flatten import (
    flat_row, flatten_metrics, log_columns, resource_columns, scope_columns, span_columns,
)
from otelier.operators.profiles_flatten import flatten_profiles
from otelier.schemas import (
    ANY_VALUE_INDEXED, BUCKETS, DICTIONARY, EXEMPLAR, KEY_VALUE, LOG_RECORD, METRIC, METRIC_KINDS, PROFILE, QUANTILE,
    RESOURCE, SCOPE, SPAN_EVENT, SPAN_RECORD, STATUS, camel, packet_schema, snake,
)

ORDERS_PER_PACKET = 1000
LOGS_PER_PACKET = 10_000
TURNS_PER_PACKET = 16
#: Tasks that hold whole spans, per shuffle partition.
SMALL_TASKS = 4
BOUNDS = (500.0, 1000.0, 2500.0, 5000.0, 7500.0, 10000.0)
EXP_BUCKETS = 20
HOUR = 3_600_000_000_000
MILLI = 1_000_000


def planned_once(build):
    """Build the (lazy) plan once per application and input. Only the plan is kept; no data is cached."""
    plans: dict[tuple[str, str], DataFrame] = {}

    @wraps(build)
    def get(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf)
        if key not in plans:
            plans[key] = build(spark, sf)
        return plans[key]

    return get


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def nanos(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) * 1000


def id_bytes(n: Column, digits: int) -> Column:
    """A number as a binary id of a fixed width."""
    return F.unhex(F.lpad(F.hex(n), digits, "0"))


def _resource(service: Column) -> Column:
    return typed_struct(RESOURCE, attributes=F.array(make_attribute("service.name", "string_value", service)),
                        droppedAttributesCount=F.lit(0))


def _scope(name: str) -> Column:
    return typed_struct(SCOPE, name=F.lit(name), version=F.lit("1.0"), attributes=no_items(KEY_VALUE),
                        droppedAttributesCount=F.lit(0))


def _fields(array: T.ArrayType) -> str:
    return array.elementType.simpleString()


def _packets(rows: DataFrame, key: list[str], order: list[str], signal: str, scope: str, record, tasks: int | None = None) -> DataFrame:
    """Group rows to packets of one resource and scope, between empty ones that give no rows.

    Rows are collected as they come from the tables, narrow; `record` builds the record of one from its fields, in the packet.
    Partitioned by packet id, as later steps want it. A record takes many times the memory of its row; where whole records are
    held, `tasks` sets the number of tasks, which adaptive execution, going by the shuffled bytes, then may not lower.
    """
    root, scopes, records = {"logs": ("resourceLogs", "scopeLogs", "logRecords"),
                             "spans": ("resourceSpans", "scopeSpans", "spans")}[signal]
    root_type = packet_schema(signal)[root].dataType
    scope_type = root_type.elementType[scopes].dataType
    fields = [c for c in rows.columns if c not in (*key, *order, "service")]
    packet_id = F.concat_ws("/", F.lit(signal), *[F.col(k).cast("string") for k in key])
    dealt = [tasks, "batch_UUID"] if tasks else ["batch_UUID"]
    grouped = rows.withColumn("batch_UUID", packet_id).repartition(*dealt).groupBy("batch_UUID", *key).agg(
        F.any_value("service").alias("service"),
        F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("_rows"))

    def scope_node(name: str, items: Column) -> Column:
        return typed_struct(_fields(scope_type), scope=_scope(name), schemaUrl=F.lit(""), **{records: items})

    none = F.array().cast(scope_type.elementType[records].dataType)
    built = F.transform("_rows", lambda r: record(lambda c: F.col(c) if c in key else r[c]))
    node = typed_struct(_fields(root_type), resource=_resource(F.col("service")), schemaUrl=F.lit(""), **{scopes: F.array(
        scope_node("empty", none), scope_node(scope, built))})
    return grouped.select(
        F.lit(0).cast("bigint").alias("batch_timestamp"), "batch_UUID",
        F.array(F.lit(None).cast(root_type.elementType), node).alias(root),
    )


# ---------------------------------------------------------------- spans


def span_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per span: packet key, order keys, service and what its record is built from."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(F.floor("l_quantity")).alias("qty"))
    start = nanos(F.col("o_orderdate"))
    null = F.lit(None)
    roots = orders.select(
        "o_custkey", "o_orderkey", F.lit(0).alias("line"), start.alias("start"),
        (start + F.floor("o_totalprice") * 1000).alias("end"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )
    children = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "o_custkey", "o_orderkey", F.col("l_linenumber").alias("line"),
        (start + F.col("l_linenumber") * MILLI).alias("start"),
        (start + F.col("l_linenumber") * MILLI + F.col("qty") * MILLI).alias("end"),
        null.cast("string").alias("status"), null.cast("string").alias("priority"),
    )
    service = F.concat(F.lit("shop-"), (F.col("o_custkey") % 5).cast("string"))
    return roots.unionByName(children).select(
        "o_custkey", F.expr(f"o_orderkey div {ORDERS_PER_PACKET}").alias("part"), "o_orderkey", "line",
        service.alias("service"), "start", "end", "status", "priority")


def span_record(field) -> Column:
    """The record of a span; `field` gives a field of its row."""
    key, line, start, status = (field(c) for c in ("o_orderkey", "line", "start", "status"))
    root = line == 0
    even = key % 2 == 0
    server = F.array(
        make_attribute(F.when(even, "http.method").otherwise("http.request.method"), "string_value", F.lit("POST")),
        make_attribute("http.status_code", "int_value",
                       F.when(status == "F", 500).otherwise(200).cast("bigint")),
    )
    client = F.array(make_attribute("rpc.method", "string_value", F.lit("pick")),
                     make_attribute("rpc.system", "string_value", F.lit("grpc")))
    event = typed_struct(SPAN_EVENT, time_unix_nano=start, name=field("priority"),
                         attributes=no_items(KEY_VALUE), dropped_attributes_count=F.lit(0))
    code = (F.when(status == "F", "STATUS_CODE_ERROR").when(status == "O", "STATUS_CODE_OK")
            .otherwise("STATUS_CODE_UNSET"))
    return typed_struct(
        SPAN_RECORD,
        traceId=id_bytes(key + 1, 32),
        spanId=id_bytes((key + 1) * 16 + line, 16),
        traceState=F.lit(""),
        parentSpanId=F.when(root, F.lit(b"")).otherwise(id_bytes((key + 1) * 16, 16)),
        flags=F.lit(0),
        name=F.when(root, "place_order").otherwise(F.concat(F.lit("line_"), line.cast("string"))),
        kind=F.when(root, "SPAN_KIND_SERVER").otherwise("SPAN_KIND_CLIENT"),
        startTimeUnixNano=start,
        endTimeUnixNano=field("end"),
        attributes=F.when(root, server).otherwise(client),
        droppedAttributesCount=F.lit(0),
        events=F.when(root, F.array(event)).otherwise(no_items(SPAN_EVENT)),
        droppedEventsCount=F.lit(0),
        droppedLinksCount=F.lit(0),
        status=typed_struct(STATUS, message=F.lit(""), code=code),
    )


@planned_once
def span_packets(spark: SparkSession, sf: str) -> DataFrame:
    return _packets(span_rows(spark, sf), ["o_custkey", "part"], ["o_orderkey", "line"], "spans", "orders", span_record)


@planned_once
def span_packets_in_small_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """The same packets, for steps that hold all spans of a task."""
    tasks = SMALL_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _packets(span_rows(spark, sf), ["o_custkey", "part"], ["o_orderkey", "line"], "spans", "orders", span_record, tasks)


@planned_once
def spans(spark: SparkSession, sf: str) -> DataFrame:
    """Flat spans without the way through packets: equal rows, but for lineage."""
    return _flat(span_rows(spark, sf), "spans", "orders", span_record, span_columns)


def _flat(rows: DataFrame, signal: str, scope: str, record, columns) -> DataFrame:
    records = rows.select(_resource(F.col("service")).alias("resource"), record(F.col).alias("record"))
    return records.select(*flat_row(signal, {
        **resource_columns(F.col("resource"), F.lit("")), **scope_columns(_scope(scope)),
        **columns(F.col("record"), F.lit("")),
    }))


# ---------------------------------------------------------------- logs


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per log: packet key, event id, service and what its record is built from."""
    service = F.concat(F.lit("shop-"), (F.col("user_id") % 5).cast("string"))
    return table(spark, sf, "events").select(
        "user_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"),
        F.expr(f"event_id div {LOGS_PER_PACKET}").alias("part"), "event_id",
        service.alias("service"), "ts", "event_type", "value", "props")


def log_record(field) -> Column:
    """The record of a log; `field` gives a field of its row."""
    event_id, kind, time = field("event_id"), field("event_type"), nanos(field("ts"))
    linked = kind != "click"
    is_view, is_error = kind == "view", kind == "error"
    body = typed_struct(ANY_VALUE_INDEXED, string_value=F.when(~is_view, kind),
                        int_value=F.when(is_view, F.floor(field("value"))))
    return typed_struct(
        LOG_RECORD,
        timeUnixNano=time,
        observedTimeUnixNano=time + 1000,
        severityNumber=F.when(is_error, 17).otherwise(9),
        severityText=F.when(is_error, "ERROR").otherwise("INFO"),
        body=body,
        attributes=F.array(
            make_attribute("event.type", "string_value", kind),
            make_attribute("user.id", "int_value", field("user_id")),
            make_attribute("k", "int_value", F.get_json_object(field("props"), "$.k").try_cast("bigint")),
        ),
        droppedAttributesCount=F.lit(0),
        flags=F.lit(0),
        traceId=F.when(linked, id_bytes(event_id + 1, 32)).otherwise(F.lit(b"")),
        spanId=F.when(linked, id_bytes((event_id + 1) * 16, 16)).otherwise(F.lit(b"")),
        eventName=F.lit(""),
    )


@planned_once
def log_packets(spark: SparkSession, sf: str) -> DataFrame:
    return _packets(log_rows(spark, sf), ["user_id", "day", "part"], ["event_id"], "logs", "app", log_record)


@planned_once
def logs(spark: SparkSession, sf: str) -> DataFrame:
    """Flat logs without the way through packets: equal rows, but for lineage."""
    return _flat(log_rows(spark, sf), "logs", "app", log_record, log_columns)


# ---------------------------------------------------------------- metrics


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Events per service, type and hour, with running values since the start of the day.

    Every aggregate has a fixed-size numeric state, so the hash aggregation combines in each task before the shuffle.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, sf, "events").select(
        F.concat(F.lit("shop-"), (F.col("user_id") % 3).cast("string")).alias("service"), "event_type",
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_id", "value",
        F.round(F.col("value") * 100).cast("bigint").alias("v"), (micros * 1000).alias("at"))
    v = F.col("v")
    edges = (None, *BOUNDS, None)

    def in_bucket(low, high) -> Column:
        test = F.lit(True)
        if low is not None:
            test = test & (v > low)
        if high is not None:
            test = test & (v <= high)
        return F.count_if(test)

    by_hour = e.groupBy("service", "event_type", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.max_by("value", "event_id").alias("last"),
        F.min("event_id").alias("x_id"), F.min_by("v", "event_id").alias("x_v"), F.min_by("at", "event_id").alias("x_at"),
        F.count_if(v <= 1).alias("zero"),
        *[in_bucket(edges[i], edges[i + 1]).alias(f"b{i}") for i in range(len(edges) - 1)],
        *[in_bucket(2 ** i, 2 ** (i + 1)).alias(f"e{i}") for i in range(EXP_BUCKETS)],
    )
    # at most 24 hours per window
    day = Window.partitionBy("service", "event_type", "day").orderBy("hour").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return by_hour.withColumn("day", F.date_trunc("day", "hour")).withColumns({
        "cn": F.sum("n").over(day), "cs": F.sum("s").over(day),
        "clo": F.min("lo").over(day), "chi": F.max("hi").over(day),
        **{f"c{i}": F.sum(f"b{i}").over(day) for i in range(len(edges) - 1)},
    })


@planned_once
def metric_packets(spark: SparkSession, sf: str) -> DataFrame:
    """A packet per service and day, with the five kinds of metric and one that has no type."""
    rows = hourly(spark, sf)
    packet = rows.groupBy("service", "day").agg(
        F.sort_array(F.collect_list(F.struct("event_type", "hour", *[
            c for c in rows.columns if c not in ("service", "day", "event_type", "hour")]))).alias("rows"))

    kind_types = {f.name: f.dataType for f in packet_schema("metrics")["resourceMetrics"].dataType.elementType[
        "scopeMetrics"].dataType.elementType["metrics"].dataType.elementType.fields}

    def metric(name: str, **data: Column) -> Column:
        return typed_struct(METRIC, name=F.lit(name), description=F.lit(f"{name} of the shop"), unit=F.lit("1"),
                            metadata=no_items(KEY_VALUE), **data)

    def points(kind: str, build, **rest) -> Column:
        """The data of a metric of some kind: a point per row. `build` gives the fields of a point beyond the common."""
        ddl = METRIC_KINDS[kind][1]

        def point(r: Column) -> Column:
            return typed_struct(
                ddl,
                attributes=F.array(make_attribute("event.type", "string_value", r["event_type"])),
                startTimeUnixNano=nanos(F.date_trunc("day", r["hour"])),
                timeUnixNano=nanos(r["hour"]) + HOUR,
                flags=F.lit(0),
                **build(r))

        return typed_struct(kind_types[kind].simpleString(), dataPoints=F.transform("rows", point), **rest)

    def exemplar(r: Column) -> Column:
        linked = r["event_type"] != "click"
        return F.array(typed_struct(
            EXEMPLAR, filtered_attributes=no_items(KEY_VALUE), time_unix_nano=r["x_at"], as_int=r["x_v"],
            span_id=F.when(linked, id_bytes((r["x_id"] + 1) * 16, 16)).otherwise(F.lit(b"")),
            trace_id=F.when(linked, id_bytes(r["x_id"] + 1, 32)).otherwise(F.lit(b""))))

    cumulative = F.lit("AGGREGATION_TEMPORALITY_CUMULATIVE")
    delta = F.lit("AGGREGATION_TEMPORALITY_DELTA")
    gauge = points("gauge", lambda r: {"exemplars": no_items(EXEMPLAR), "asDouble": r["last"]})
    total = points("sum", lambda r: {"exemplars": no_items(EXEMPLAR), "asInt": r["cn"]},
                   aggregationTemporality=cumulative, isMonotonic=F.lit(True))
    histogram = points("histogram", lambda r: {
        "exemplars": exemplar(r), "count": r["cn"], "sum": r["cs"],
        "bucketCounts": F.array(*[r[f"c{i}"] for i in range(len(BOUNDS) + 1)]),
        "explicitBounds": F.lit(list(BOUNDS)), "min": r["clo"], "max": r["chi"],
    }, aggregationTemporality=cumulative)
    exponential = points("exponentialHistogram", lambda r: {
        "exemplars": no_items(EXEMPLAR), "count": r["n"], "sum": r["s"], "scale": F.lit(0), "zeroCount": r["zero"],
        "positive": typed_struct(BUCKETS, offset=F.lit(0),
                                 bucket_counts=F.array(*[r[f"e{i}"] for i in range(EXP_BUCKETS)])),
        "min": r["lo"], "max": r["hi"], "zeroThreshold": F.lit(1.0),
    }, aggregationTemporality=delta)
    summary = points("summary", lambda r: {
        "count": r["n"], "sum": r["s"],
        "quantileValues": F.array(typed_struct(QUANTILE, quantile=F.lit(0.0), value=r["lo"]),
                                  typed_struct(QUANTILE, quantile=F.lit(1.0), value=r["hi"])),
    })

    metrics = F.array(
        metric("app.untyped"),
        metric("app.value.last", gauge=gauge),
        metric("app.events", sum=total),
        metric("app.value.dist", histogram=histogram),
        metric("app.value.exp", exponentialHistogram=exponential),
        metric("app.value.summary", summary=summary),
    )
    root = packet_schema("metrics")["resourceMetrics"].dataType
    scope = typed_struct(_fields(root.elementType["scopeMetrics"].dataType), scope=_scope("app"),
                         schemaUrl=F.lit(""), metrics=metrics)
    node = typed_struct(_fields(root), resource=_resource(F.col("service")), schemaUrl=F.lit(""),
                        scopeMetrics=F.array(scope))
    return packet.select(
        F.lit(0).cast("bigint").alias("batch_timestamp"),
        F.concat_ws("/", F.lit("metrics"), "service", F.date_format("day", "yyyy-MM-dd")).alias("batch_UUID"),
        F.array(F.lit(None).cast(root.elementType), node).alias("resourceMetrics"),
    )


# ---------------------------------------------------------------- profiles


@planned_once
def profile_packets(spark: SparkSession, sf: str) -> DataFrame:
    """A packet per run of turns of a conversation: a turn is a sample, its words are the stack, the first is the leaf.

    Everything that can be an index is one: strings, attributes, functions, locations, stacks, link.
    A `user` turn has timestamps, an `assistant` turn has none, a `system` turn has too few (an invalid sample).
    """
    turns = table(spark, sf, "conversations").select(
        "conv_id", F.expr(f"turn div {TURNS_PER_PACKET}").alias("part"), "turn", "role",
        F.length("text").cast("bigint").alias("chars"), F.split("text", " ").alias("words"))
    packet = turns.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "chars", "words"))).alias("samples"))
    host = F.concat(F.lit("host-"), F.expr("conv_id div 10").cast("string"))
    fixed = ["", "chars", "count", "turn", "role", "host.name", "conversation"]
    strings = F.array_sort(F.array_distinct(F.concat(
        F.lit(fixed), F.array(host),
        F.transform("samples", lambda s: s["role"]), F.flatten(F.transform("samples", lambda s: s["words"])))))
    packet = packet.select("conv_id", "part", "samples", strings.alias("strings"), host.alias("host"), running_totals(
        F.transform("samples", lambda s: F.size(s["words"]))).alias("offsets")).withColumn("steps", search_steps(F.size("strings")))

    def at(text) -> Column:
        return place_in(F.col("strings"), F.col("steps"), F.lit(text) if isinstance(text, str) else text)

    def frames(build, of_sample=lambda s: F.lit(0)) -> Column:
        """One entry per word of each sample; build(what `of_sample` gives, index of the entry, word, position)."""
        return F.flatten(F.transform("samples", lambda s, k: let(of_sample(s), lambda x: F.transform(
            s["words"], lambda w, i: build(x, F.get("offsets", k) + i, w, i)))))

    zero, no_indices = F.lit(0), F.array().cast("array<int>")
    # a search costs time: once per word, once per sample for the role; the empty text is the first of the strings
    functions = frames(lambda role, n, w, i: F.struct(
        at(w).alias("nameStrindex"), zero.alias("systemNameStrindex"), role.alias("filenameStrindex"),
        zero.cast("bigint").alias("startLine")), lambda s: at(s["role"]))
    locations = frames(lambda x, n, w, i: F.struct(
        zero.alias("mappingIndex"), (i * 16).cast("bigint").alias("address"),
        F.array(F.struct(n.alias("functionIndex"), i.cast("bigint").alias("line"),
                         zero.cast("bigint").alias("column"))).alias("lines"),
        no_indices.alias("attributeIndices")))
    stacks = F.transform("samples", lambda s, k: F.struct(
        F.transform(s["words"], lambda w, i: F.get("offsets", k) + i).alias("locationIndices")))
    attributes = F.transform("samples", lambda s: F.struct(
        at("role").alias("keyStrindex"),
        F.struct(*[F.lit(None).alias(f) for f in ("s", "b", "i", "d", "a", "k", "y")], at(s["role"]).alias("x"))
        .cast(ANY_VALUE_INDEXED).alias("value"),
        at("count").alias("unitStrindex")))
    mapping = F.struct(zero.cast("bigint").alias("memoryStart"), F.lit(4096).cast("bigint").alias("memoryLimit"),
                       zero.cast("bigint").alias("fileOffset"), at("conversation").alias("filenameStrindex"),
                       no_indices.alias("attributeIndices"))
    link = F.struct(id_bytes(F.col("conv_id") + 1, 32).alias("traceId"),
                    id_bytes((F.col("conv_id") + 1) * 16, 16).alias("spanId"))
    dictionary = F.struct(
        F.col("strings").alias("stringTable"), attributes.alias("attributeTable"),
        F.array(mapping).alias("mappingTable"), functions.alias("functionTable"), locations.alias("locationTable"),
        stacks.alias("stackTable"), F.array(link).alias("linkTable"),
    ).cast(DICTIONARY)

    def times(s: Column) -> Column:
        first = F.col("conv_id") * 1_000_000_000 + s["turn"] * MILLI
        return (F.when(s["role"] == "user", F.array(first, first + 1)).when(s["role"] == "system", F.array(first))
                .otherwise(F.array().cast("array<bigint>")))

    samples = F.transform("samples", lambda s, k: F.struct(
        k.alias("stackIndex"), F.array(s["chars"], F.size(s["words"]).cast("bigint")).alias("values"),
        F.array(k).alias("attributeIndices"), zero.alias("linkIndex"), times(s).alias("timestampsUnixNano")))

    def value_type(kind: str, unit: str) -> Column:
        return F.struct(at(kind).alias("typeStrindex"), at(unit).alias("unitStrindex"))

    profile = F.struct(
        id_bytes(F.col("conv_id") + 1, 32).alias("profileId"), no_indices.alias("attributeIndices"),
        zero.alias("droppedAttributesCount"), F.lit("").alias("originalPayloadFormat"),
        F.lit(b"").alias("originalPayload"), (F.col("conv_id") * 1_000_000_000).alias("timeUnixNano"),
        F.lit(1_000_000_000).cast("bigint").alias("durationNano"), value_type("turn", "count").alias("periodType"),
        F.lit(1).cast("bigint").alias("period"), value_type("chars", "count").alias("sampleType"),
        samples.alias("samples"),
    ).cast(PROFILE)
    root = packet_schema("profiles")["resourceProfiles"].dataType
    indexed = F.struct(F.lit("").alias("key"), at("host.name").alias("key_strindex"), F.struct(
        *[F.lit(None).alias(f) for f in ("s", "b", "i", "d", "a", "k", "y")], at(F.col("host")).alias("x"),
    ).cast(ANY_VALUE_INDEXED).alias("value"))
    scope = F.struct(
        F.struct(F.lit("sampler").alias("name"), F.lit("1.0").alias("version"), F.array().alias("attributes"),
                 zero.alias("droppedAttributesCount")).alias("scope"),
        F.lit("").alias("schemaUrl"), F.array(profile).alias("profiles"))
    resource = F.struct(
        F.struct(F.array(indexed).alias("attributes"), zero.alias("droppedAttributesCount"),
                 F.lit(None).alias("entityRefs")).alias("resource"),
        F.lit("").alias("schemaUrl"), F.array(scope).alias("scopeProfiles"))
    return packet.select(
        F.lit(0).cast("bigint").alias("batch_timestamp"),
        F.concat_ws("/", F.lit("profiles"), F.col("conv_id").cast("string"), F.col("part").cast("string"))
        .alias("batch_UUID"),
        # an empty resource first: it gives no rows but counts in resource_seq_no
        F.array(F.lit(None).cast(root.elementType), resource.cast(root.elementType)).alias("resourceProfiles"),
        dictionary.alias("dictionary"),
    )


@planned_once
def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat metrics by way of the packets; they are few, since the events are aggregated first."""
    return flatten_metrics(metric_packets(spark, sf))


@planned_once
def profile_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat profiles by way of the packets."""
    return flatten_profiles(profile_packets(spark, sf))


# ---------------------------------------------------------------- nested values

NEST_LEVELS = 6


def nested_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as attribute lists: `v` is a list that holds the market segment 1 to 6 levels deep, and the key. In
    `indexed` all texts and keys of `v` are indices into `strings`."""
    # a file of a few MB is one task, but to render its values takes minutes: the rows are dealt evenly, however few their bytes
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("levels", F.col("c_custkey") % NEST_LEVELS + 1)

    def wire(text: Column, key: str) -> Column:
        for level in range(2, NEST_LEVELS + 1):
            inner = F.concat(F.lit(f'{{"kvlistValue":{{"values":[{{{key},"value":'), text, F.lit("}]}}")) if level % 2 else F.concat(
                F.lit('{"arrayValue":{"values":['), text, F.lit("]}}"))
            text = F.when(F.col("levels") >= level, inner).otherwise(text)
        return F.concat(F.lit('{"values":['), text, F.lit(',{"intValue":"'), F.col("c_custkey").cast("string"), F.lit('"}]}'))

    literal = wire(F.concat(F.lit('{"stringValue":"'), F.col("c_mktsegment"), F.lit('"}')), '"key":"k"')
    by_index = wire(F.lit('{"stringValueStrindex":1}'), '"keyStrindex":2')
    indexed_value = typed_struct(ANY_VALUE_INDEXED, array_value=by_index)
    return customers.select(
        "c_custkey", "levels", F.array(make_attribute("v", "array_value", literal)).alias("attributes"),
        F.array(F.struct(F.lit("").alias("key"), F.lit(3).alias("key_strindex"), indexed_value.alias("value"))).alias("indexed"),
        F.array(F.lit(""), F.col("c_mktsegment"), F.lit("k"), F.lit("v")).alias("strings"))


PACKETS = {"logs": log_packets, "spans": span_packets, "metrics": metric_packets, "profiles": profile_packets}


# ---------------------------------------------------------------- JSON


def _encode(value: Column, dtype: T.DataType, spelling) -> Column:
    if isinstance(dtype, T.StructType):
        fields = [_encode(value[f.name], f.dataType, spelling).alias(spelling(f.name)) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _encode(x, dtype.elementType, spelling))
    if isinstance(dtype, T.LongType) or isinstance(dtype, T.DoubleType) and spelling is snake:
        return value.cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    return value


def packet_text(signal: str, spelling=camel) -> Column:
    """A packet as JSON, as an exporter writes it. With `snake` as spelling of the field names doubles are texts too, which the
    encoding allows."""
    return F.to_json(F.struct(*[_encode(F.col(f.name), f.dataType, spelling).alias(spelling(f.name)) for f in packet_schema(signal).fields]))


def encode_packets(packets: DataFrame, signal: str) -> DataFrame:
    """Packets as JSON text, one per row in `value`."""
    return packets.select(packet_text(signal).alias("value"))
