"""Small expression helpers: ids, times, arrays, defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from otelier.schemas import struct

NANOS_PER_HOUR = 3_600_000_000_000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column whose name may hold dots (`a_http.method`)."""
    return F.col(quoted(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it any number of times, inside lambdas too.

    The optimiser merges a projection into the next one when it is referenced once; a reference inside a lambda
    counts as one although it runs per element. Binding the value to a lambda variable rules that out.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def typed_struct(ddl: str, **fields: Column) -> Column:
    """A struct of the given type; fields that are not named are null.

    Each scalar is cast on its own. A cast of the whole struct would give the same value, but Catalyst cannot see
    through it: every access to one field would build all of them.
    """
    parts = []
    for f in struct(ddl).fields:
        value = fields.pop(f.name, None)
        if value is None:
            value = F.lit(None).cast(f.dataType)
        elif not isinstance(f.dataType, (T.StructType, T.ArrayType)):
            value = value.cast(f.dataType)
        parts.append(value.alias(f.name))
    if fields:
        raise ValueError(f"no such fields: {sorted(fields)}")
    return F.struct(*parts)


def no_items(element_ddl: str) -> Column:
    return F.array().cast(f"array<{element_ddl}>")


def or_empty(array: Column) -> Column:
    """JSON leaves empty lists out, so a missing list is an empty list."""
    return F.coalesce(array, F.array())


def compute_once(df: DataFrame, keep: list, value: Column, name: str) -> DataFrame:
    """Add an expensive struct whose fields are then used one by one, such as a JSON parse.

    As a plain projection Catalyst would turn each used field into an expression of its own and repeat the work. It
    does not look into a generator, so the value goes through one: an array of one element, exploded.
    """
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))


def explode_level(df: DataFrame, keep: list, array: str, position: str, element: str) -> DataFrame:
    """One row per element of `array` with its position; rows without elements go.

    The outer form with a filter on the position gives the same rows as `posexplode`, but Catalyst then does not
    add a filter on the size of the array below it, which would evaluate the array (a JSON parse, say) twice.
    """
    exploded = df.select(*keep, F.posexplode_outer(array).alias(position, element))
    return exploded.filter(F.col(position).isNotNull())


def running_totals(counts: Column) -> Column:
    """[3, 0, 2] -> [0, 3, 3]: for each element the sum of those before it."""
    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
    return F.aggregate(
        counts,
        start,
        lambda acc, n: F.struct(
            (acc["total"] + n).alias("total"),
            F.concat(acc["before"], F.array(acc["total"])).alias("before"),
        ),
        lambda acc: acc["before"],
    )


def search_steps(entries: Column) -> Column:
    """The steps of `place_in` for tables of up to so many entries: [4, 2, 1] for 7 of them."""
    powers = F.sequence(F.floor(F.log2(F.greatest(entries, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))
    return F.when(entries.isNotNull(), F.transform(powers, lambda k: F.pow(F.lit(2), k).cast("int")))


def place_in(table: Column, steps: Column, x: Column) -> Column:
    """The number of an entry in a sorted table that holds it, by binary search; nulls of the table come last. `steps` should be
    a column, or a variable of a lambda, that holds `search_steps`."""
    upto = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(table, n + step - 1) <= x, n + step).otherwise(n))
    return F.when(x.isNotNull(), upto - 1)


def sorted_table(items: Column) -> Column:
    """The distinct items that are not null, sorted. (`array_distinct` compares each struct with all others.)"""
    return let(F.sort_array(F.filter(items, lambda x: x.isNotNull())), lambda table: F.filter(
        table, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(table, i - 1))))


def default_for(dtype: T.DataType) -> Column | None:
    """The value an unset field of this type has; None for structs, which stay null."""
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.DoubleType):
        return F.lit(0.0)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    if isinstance(dtype, T.ArrayType):
        return F.array().cast(dtype)
    return None


def hex_id(col: Column | str) -> Column:
    """A binary id as lower-case hex text; the empty id is the empty text."""
    return F.lower(F.hex(col))


def nanos_to_timestamp(name: str) -> Column:
    """Timestamp (microseconds) of a nanosecond column."""
    return F.expr(f"timestamp_micros({quoted(name)} div 1000)")


def nanos_to_millis_timestamp(name: str) -> Column:
    """Timestamp cut to milliseconds by integer division."""
    return F.expr(f"timestamp_millis({quoted(name)} div 1000000)")


def number_text(x: Column) -> Column:
    """A double as the shortest decimal text with a point: 5.0, 0.25, 10000000.0, 1e+16, 1e-05.

    Spark's own cast switches to 1.0E7 from ten million on and to 1.0E-4 below a thousandth.
    """
    text = x.cast("string")
    size = F.abs(x)
    plain = F.regexp_replace(x.cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(-?[\d.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.lpad(F.abs(exponent).cast("string"), 2, "0")
    digits = F.when(F.abs(exponent) > 99, F.abs(exponent).cast("string")).otherwise(digits)
    scientific = F.concat(mantissa, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), digits)
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0) | ~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
