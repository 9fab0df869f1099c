"""Packets in: JSON-encoded export requests, from files or streams, to typed nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from otelier.functions.expressions import compute_once, let
from otelier.functions.nested import apply, bound, replaced
from otelier.schemas import ENUMS, SIGNED, camel, field_names, packet_schema, wire_schema

CORRUPT = "corrupt_record"

def _enum_name(value: Column, names: tuple[str, ...]) -> Column:
    """Enum by name or by number, as the name. A cast that fails costs an exception, so names are not cast."""
    return F.when(value.isin(*names), value).otherwise(F.coalesce(F.get(F.lit(list(names)), value.try_cast("int")), value))


def _enum_number(value: Column, names: tuple[str, ...]) -> Column:
    return F.when(value.isin(*names), F.array_position(F.lit(list(names)), value).cast("int") - 1).otherwise(value.try_cast("int"))


def _whole_number(text: Column, dtype: T.DataType, name: str) -> Column:
    """Text to a number; unsigned fields wrap around where the signed type that stores them ends. Decimals are made only
    of what does not fit at once."""
    number = text.try_cast("decimal(20,0)")
    if name not in SIGNED:
        bits = 31 if isinstance(dtype, T.IntegerType) else 63
        wrapped = number - F.lit(str(1 << bits + 1)).cast("decimal(20,0)")
        number = F.when(number >= F.lit(str(1 << bits)).cast("decimal(20,0)"), wrapped).otherwise(number)
    return F.coalesce(text.try_cast(dtype), number.try_cast(dtype))


def _conform(col: Column, dtype: T.DataType, name: str, id_encoding: str) -> Column:
    """Wire form of a value -> its packet type. Text that does not fit becomes null."""
    if name in ENUMS:
        build = _enum_number if isinstance(dtype, T.IntegerType) else _enum_name
        return build(col, ENUMS[name])
    if isinstance(dtype, T.StructType):
        fields = [_conform(col[camel(f.name)], f.dataType, f.name, id_encoding).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        if wire_schema(dtype, id_encoding, camel(name)) == dtype:
            return col
        return F.transform(col, lambda x: _conform(x, dtype.elementType, name, id_encoding))
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return _whole_number(col, dtype, name)
    if isinstance(dtype, T.DoubleType):
        return col.try_cast(dtype)
    if wire_schema(dtype, id_encoding, camel(name)) != dtype:
        return F.try_to_binary(col, F.lit("hex"))
    return col


#: A field name in snake_case. What follows a string that ends never begins with a letter, so no text can look like one.
_SNAKE = r'"([a-z][a-z0-9]*+(?:_[a-z0-9]++)++)"\s*+:'
#: How such a name ends, which is found faster.
_SNAKE_END = r'_[a-z0-9]++"\s*+:'


def _camel_names(payload: str) -> str:
    """SQL for a JSON text with all field names in camelCase; the encoding allows both spellings."""
    parts = "split(g, '_')"
    name = f"concat('\"', {parts}[0], array_join(transform(slice({parts}, 2, 99), p -> initcap(p)), ''), '\":')"
    return f"CASE WHEN {payload} RLIKE r'{_SNAKE_END}' THEN {replaced(payload, _SNAKE, name, 'snake')} ELSE {payload} END"


def _one_of(words: list[str]) -> str:
    """A pattern for any of some words that tries no beginning twice."""
    tails: dict[str, list[str]] = {}
    for word in words:
        tails.setdefault(word[:1], []).append(word[1:])
    branches = [head + _one_of(tail) if head else "" for head, tail in sorted(tails.items(), reverse=True)]
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def _known_names(text: str, schema: T.StructType) -> str:
    """SQL for whether a JSON text is made of strings that are no field names, known field names, and the rest."""
    names = _one_of(sorted(field_names(schema)))
    # atomic groups match as possessive ones do, but Java runs them faster
    string = r'"(?>[^"\\]*)(?:\\.(?>[^"\\]*))*+"'
    return rf"""{text} RLIKE r'\A(?>[^"]*)(?:(?:"{names}"\s*+:|{string}(?!\s*+:))(?>[^"]*))*+\z'"""


def parse_packets(raw: DataFrame, signal: str, id_encoding: str = "base64") -> DataFrame:
    """Rows (`payload`, `position`, `batch_timestamp`) -> typed packets.

    Field names may be in camelCase or snake_case, numbers may be texts. `corrupt_record` holds the payload of a packet
    that is not valid JSON of this signal or has a field that no part of it knows, at any level; otherwise it is null.
    (A known field at a level that does not have it is ignored.) Such a packet has no content, so it can go through a
    flatten as it is and gives no rows.
    The packet id hashes source position and payload: the same packet gets the same id when a task runs again.
    """
    schema = packet_schema(signal)
    wire = wire_schema(schema, id_encoding).add(CORRUPT, T.StringType())
    # no known name holds a snake_case part, so only what has other names is looked through for such
    camel_case = bound(_camel_names("p"), "c", f"CASE WHEN {_known_names('c', schema)} THEN c END")
    known = apply(F.col("payload"), f"p -> CASE WHEN {_known_names('p', schema)} THEN p ELSE {camel_case} END")

    def convert(wire_packet: Column) -> Column:
        fits = wire_packet["json"].isNotNull() & wire_packet["packet"][CORRUPT].isNull()
        return F.struct(
            *[F.when(fits, _conform(wire_packet["packet"][f.name], f.dataType, f.name, id_encoding)).alias(f.name)
              for f in schema.fields],
            F.when(~fits, F.col("payload")).alias(CORRUPT),
        )

    # one expression from text to typed packet: parsed once, and converted before it is written to a row
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = let(known, lambda json: F.struct(json.alias("json"), F.from_json(json, wire, options).alias("packet")))
    packet_id = F.md5(F.concat_ws("|", "position", "payload")).alias("batch_UUID")
    return compute_once(raw, ["batch_timestamp", packet_id], let(parsed, convert), "_packet").select(
        "batch_timestamp", "batch_UUID", "_packet.*")


def accepted(packets: DataFrame) -> DataFrame:
    """Packets that could be parsed."""
    return packets.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(packets: DataFrame) -> DataFrame:
    """Packets that could not be parsed, with the payload as received."""
    return packets.filter(F.col(CORRUPT).isNotNull()).select("batch_timestamp", "batch_UUID", CORRUPT)


def _file_rows(lines: DataFrame, arrival: Column) -> DataFrame:
    """Packets with their file as position."""
    return lines.select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("position"),
                        arrival.alias("batch_timestamp"))


def numbered(rows: DataFrame) -> DataFrame:
    """Equal payloads at one position told apart: the second and later ones of a file get their number added to it.

    Equal lines can't be told apart by anything else, so the set of positions is the same however the file is split
    into tasks. Costs one exchange by position and content. A streamed file comes whole in one batch, so its packets get
    the same positions there.
    """
    equal = Window.partitionBy("position", F.md5("payload")).orderBy("batch_timestamp")
    number = F.row_number().over(equal)
    return rows.withColumn("position", F.when(number == 1, F.col("position")).otherwise(F.concat_ws("/", "position", number.cast("string"))))


def read_packets(spark: SparkSession, signal: str, path: str, id_encoding: str = "base64", equal_lines: bool = True) -> DataFrame:
    """Read a directory of JSON packets, one per line, as typed nested rows with `corrupt_record`. Where no file holds a line
    twice, `equal_lines=False` saves the exchange that tells equal ones apart; ids are the same."""
    rows = _file_rows(spark.read.text(path), F.unix_millis("_metadata.file_modification_time"))
    return parse_packets(numbered(rows) if equal_lines else rows, signal, id_encoding)


def stream_payloads(spark: SparkSession, source: str = "text", options: dict[str, str] | None = None) -> DataFrame:
    """Packets as they come (`payload`, `position`, `batch_timestamp`) from the earliest position: files (`text`, option `path`)
    or `kafka`."""
    options = dict(options or {})
    if source == "kafka":
        options.setdefault("startingOffsets", "earliest")
        messages = spark.readStream.format("kafka").options(**options).load()
        return messages.select(
            F.col("value").cast("string").alias("payload"),
            F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
            .alias("position"),
            F.unix_millis("timestamp").alias("batch_timestamp"),
        )
    # a replayed file arrives now, whatever its age
    return _file_rows(spark.readStream.format(source).options(**options).load(), F.unix_millis(F.current_timestamp()))


def stream_packets(
    spark: SparkSession, signal: str, source: str = "text", options: dict[str, str] | None = None,
    id_encoding: str = "base64",
) -> DataFrame:
    """Typed packets as a stream. Equal lines of one file share their id, since a stream can't number them;
    `streaming.ingest` does."""
    return parse_packets(stream_payloads(spark, source, options), signal, id_encoding)
