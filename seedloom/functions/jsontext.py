"""Strict JSON reading of model output with built-in functions only.

Spark's JSON functions stop at the end of the first value and so accept trailing
text. Parsing ``[[`` + text + ``],[]]`` and asking for one element in the first inner
array and none in the second restores the strictness of a whole-document parser in a
single parse: trailing prose, a second value or a stray bracket breaks that shape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedloom.functions.text import as_column, strip

_STRICT = {"allowSingleQuotes": "false"}


def _framed(text: Column) -> Column:
    return F.concat(F.lit("[["), text, F.lit("],[]]"))


def _holds_one(frame: Column) -> Column:
    first, rest = F.get(frame, F.lit(0)), F.get(frame, F.lit(1))
    shape = (F.size(frame) == 2) & (F.size(first) == 1) & (F.size(rest) == 0)
    return F.coalesce(shape, F.lit(False))


def _enclosed(text: Column, opening: str, closing: str) -> Column:
    return text.startswith(opening) & text.endswith(closing)


def _maybe_json(text: Column) -> Column:
    """Cheap test that spares prose the parser, whose failures cost an exception each."""
    body = strip(text)
    scalar = body.rlike(r"^(-?[0-9][0-9.eE+-]*|true|false|null|NaN|-?Infinity)$")
    return _enclosed(body, "{", "}") | _enclosed(body, "[", "]") | _enclosed(body, '"', '"') | scalar


def is_json(text: Column | str) -> Column:
    """True when the whole text is one JSON value."""
    text = as_column(text)
    frame = F.from_json(_framed(text), "array<array<string>>", _STRICT)
    return F.when(_maybe_json(text), _holds_one(frame)).otherwise(False)


def parse_objects(text: Column | str) -> Column:
    """Framed text as arrays of maps; ``sole_object`` reads the result."""
    text = as_column(text)
    frame = F.from_json(_framed(text), "array<array<map<string,string>>>", _STRICT)
    return F.when(_enclosed(strip(text), "{", "}"), frame)


def sole_object(parsed: Column | str) -> Column:
    """``map<string,string>`` of a text holding one JSON object, else NULL."""
    parsed = as_column(parsed)
    return F.when(_holds_one(parsed), F.get(F.get(parsed, F.lit(0)), F.lit(0)))


def entries_for(obj: Column, key: str) -> Column:
    """All entries of ``obj`` under ``key``; empty array when absent or ``obj`` is NULL."""
    found = F.filter(F.map_entries(obj), lambda entry: entry["key"] == key)
    return F.coalesce(found, F.array().cast("array<struct<key:string,value:string>>"))


def last_value(obj: Column, key: str) -> Column:
    """Value under ``key``; the last one wins when a document repeats a key."""
    return F.try_element_at(entries_for(obj, key), F.lit(-1))["value"]


def parse_variants(text: Column | str) -> Column:
    """Framed text as a variant; ``sole_variant`` reads the result."""
    text = as_column(text)
    return F.when(_maybe_json(text), F.try_parse_json(_framed(text)))


def sole_variant(parsed: Column | str) -> Column:
    """Variant of the text when it is exactly one JSON value, else NULL."""
    other = [F.try_variant_get(parsed, path, "variant") for path in ("$[0][1]", "$[1][0]", "$[2]")]
    single = other[0].isNull() & other[1].isNull() & other[2].isNull()
    return F.when(single, F.try_variant_get(parsed, "$[0][0]", "variant"))


def variant_type(value: Column, path: str) -> Column:
    """Schema text of the value at ``path`` (``STRING``, ``ARRAY<STRING>`` …) or NULL."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def json_string(value: Column) -> Column:
    """Quote a string as a JSON literal without escaping non-ASCII characters."""
    wrapped = F.to_json(F.struct(value.alias("v")))
    # to_json gives {"v":"..."}; drop the leading {"v": and the closing brace.
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - F.lit(6))
