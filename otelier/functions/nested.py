"""Nested lists and dicts of attribute values: JSON text in wire form, of any depth, by built-in functions alone.

The wire form wraps every value in an object that names its type: `{"values":[{"intValue":"5"},{"arrayValue":{...}}]}`.
No expression can recurse, but a text can be rewritten from the inside: once the scalars are bare, the innermost lists
and dicts hold no bracket but their own. A round replaces all of those by plain JSON whose brackets, commas and quotes
are masked, which makes their parents the innermost ones; a text nested n levels deep takes n rounds. Masks are control
characters, which JSON never holds bare.

The expressions are written as SQL: one text is parsed at once, where thousands of single calls would cross to the JVM.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

#: A JSON string in a Java pattern; possessive, so long ones need no stack.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SPECIAL, _MASKS = '[]{},"', "\x01\x02\x03\x04\x05\x06"
_OPEN, _CLOSE, _BEGIN, _END = _MASKS[:4]

_LIST = r'\{"arrayValue":\{"values":\[([^\[\]{}]*+)\]\}\}'
_DICT = r'\{"kvlistValue":\{"values":\[((?:\{[^\[\]{}]*+\}|null|,)*+)\]\}\}'


def apply(value: Column, function: str) -> Column:
    """A SQL lambda function applied to a column, also within another lambda; `value` is evaluated once."""
    return F.get(F.call_function("transform", F.array(value), F.expr(function)), F.lit(0))


def bound(value: str, name: str, body: str) -> str:
    """SQL in which `name` stands for `value`, evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def replaced(text: str, pattern: str, build: str, name: str = "t") -> str:
    """SQL for `text` with every match of `pattern` replaced by `build`, in which `g` is the first group of the match."""
    return bound(text, name, f"""CASE WHEN {name} RLIKE r'{pattern}' THEN array_join(zip_with(
        split({name}, r'{pattern}', -1), concat(transform(regexp_extract_all({name}, r'{pattern}', 1), g -> {build}), array('')),
        (x, y) -> concat(x, y)), '') ELSE {name} END""")


def scalar_sql(x: str) -> str:
    """SQL for one value as JSON, quoted and escaped where JSON wants it; null stays null."""
    # the text of a one-element list without its brackets; a JSON scalar never ends in a bracket itself
    return f"CASE WHEN {x} IS NOT NULL THEN rtrim(']', substr(to_json(array({x})), 2)) END"


def json_scalar(x: Column) -> Column:
    """One value as JSON, quoted and escaped where JSON wants it; null stays null."""
    return F.when(x.isNotNull(), F.rtrim(F.substr(F.to_json(F.array(x)), F.lit(2)), F.lit("]")))


def _masked_strings(text: str) -> str:
    """Brackets and commas within strings masked."""
    return f"""array_join(transform(regexp_extract_all({text}, r'({STRING}|[^"]++)', 1),
        s -> CASE WHEN startswith(s, '"') THEN translate(s, '{_SPECIAL[:5]}', '{_MASKS[:5]}') ELSE s END), '')"""


def _bare_scalars(text: str, exponents: bool) -> str:
    """Scalar, unset and empty values without their wrappers."""
    number = f"""coalesce({scalar_sql("try_cast(translate(g, '\"', '') AS DOUBLE)")}, 'null')"""
    if exponents:
        number = bound(number, "d", r"CASE WHEN d RLIKE r'^[-\d.]+$' THEN concat(d, 'E0') ELSE d END")
    text = replaced(text, r'\{"doubleValue":("?[^"{}\[\],]++"?)\}', number)
    for pattern, plain in (
        (r'\{"intValue":"?(-?\d++)"?\}', "$1"),
        (r'\{"boolValue":(true|false)\}', "$1"),
        (rf'\{{"(?:stringValue|bytesValue)":({STRING})\}}', "$1"),
        (r'\{"arrayValue":\{(?:"values":(?:\[\]|null))?\}\}', _OPEN + _CLOSE),
        (r'\{"kvlistValue":\{(?:"values":(?:\[\]|null))?\}\}', _BEGIN + _END),
        (r'\{(?:"(?:\w+Value":null|stringValueStrindex":"?-?\d++"?))?\}', "null"),
    ):
        text = f"regexp_replace({text}, r'{pattern}', '{plain}')"
    return text


def _members(text: str) -> str:
    """`{"key":k,"value":v},...` -> `k:v,...`; the last duplicate of a key wins, a missing key is empty."""
    return f"""array_join(transform(map_entries(map_from_entries(transform(
        regexp_extract_all({text}, r'(\\{{[^{{}}]*+\\}}|null)', 1), m -> struct(
            coalesce(nullif(regexp_extract(m, r'"key":(?!"")({STRING})', 1), ''), '""') AS key,
            coalesce(nullif(regexp_extract(m, r'"value":({STRING}|[^,}}]++)', 1), ''), 'null') AS value)))),
        e -> concat(e.key, ':', e.value)), ',')"""


def _round(text: str) -> str:
    """All innermost lists and dicts as masked plain JSON."""

    def hidden(x: str) -> str:
        return f"translate({x}, '{_SPECIAL[4:]}', '{_MASKS[4:]}')"

    lists = replaced(text, _LIST, f"concat('{_OPEN}', {hidden('g')}, '{_CLOSE}')", "u")
    return replaced(lists, _DICT, f"concat('{_BEGIN}', {hidden(_members('g'))}, '{_END}')", "v")


#: How deep square brackets nest.
_DEPTH = r"""aggregate(split(regexp_replace(n, r'[^\[\]]++', ''), ''), struct(0 AS now, 0 AS most), (acc, c) -> struct(
    acc.now + CASE c WHEN '[' THEN 1 WHEN ']' THEN -1 ELSE 0 END AS now,
    greatest(acc.most, acc.now + CASE c WHEN '[' THEN 1 WHEN ']' THEN -1 ELSE 0 END) AS most), acc -> acc.most)"""


@lru_cache
def _plain(kind: str, exponents: bool) -> str:
    """SQL function from wire text to plain JSON."""
    # the outermost level is not wrapped itself, so a round less than there are levels
    bare = bound(_bare_scalars(_masked_strings("w"), exponents), "n", f"""CASE WHEN contains(n, 'Value":{{"values"')
        THEN aggregate(sequence(2, greatest(2, {_DEPTH})), n, (r, i) -> {_round('r')}) ELSE n END""")
    content = f"regexp_extract({bare}, r'(?s)^\\{{\"values\":\\[(.*)\\]\\}}$', 1)"
    whole = f"concat('[', {content}, ']')" if kind == "list" else f"concat('{{', {_members(content)}, '}}')"
    return f"w -> CASE WHEN w IS NOT NULL THEN translate({whole}, '{_MASKS}', '{_SPECIAL}') END"


def plain_list(text: Column, exponents: bool = False) -> Column:
    """Wire text of a list, as a plain JSON list; with `exponents` all doubles have one, which keeps them doubles in a VARIANT."""
    return apply(text, _plain("list", exponents))


def plain_dict(text: Column, exponents: bool = False) -> Column:
    """Wire text of a dict, as a plain JSON object."""
    return apply(text, _plain("dict", exponents))


@lru_cache
def _resolved() -> str:
    text = "p.text"
    for index, name, var in (("stringValueStrindex", "stringValue", "a"), ("keyStrindex", "key", "b")):
        found = scalar_sql("get(p.strings, try_cast(g AS INT))")
        text = replaced(text, rf'"{index}":"?(\d++)"?', f"""concat('"{name}":', coalesce({found}, 'null'))""", var)
    return f"p -> {text}"


def resolve_nested(text: Column, strings: Column) -> Column:
    """Wire text with indices into `strings`, with the texts themselves; everything else stays as it was written."""
    return apply(F.struct(text.alias("text"), strings.alias("strings")), _resolved())
