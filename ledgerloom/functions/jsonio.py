"""JSON text in and out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.hexnum import as_col


def encode(value: Column | str) -> Column:
    """A struct as JSON text, absent fields written as null."""
    return F.to_json(as_col(value), {"ignoreNullFields": "false"})


def encode_compact(value: Column | str) -> Column:
    """A struct or map as JSON text without its null entries."""
    c = as_col(value)
    return F.to_json(c, {"ignoreNullFields": "true"})


def encode_map(value: Column | str) -> Column:
    """A map as JSON text, null values dropped."""
    return F.to_json(F.map_filter(as_col(value), lambda k, v: v.isNotNull()))


def decode(text: Column | str, schema: str) -> Column:
    """Typed decoding; null where the text is no such JSON."""
    return F.from_json(as_col(text), schema, {"mode": "PERMISSIVE"})


def decode_any(text: Column | str) -> Column:
    """Untyped decoding to VARIANT; null for bad JSON."""
    return F.try_parse_json(as_col(text))


def decode_map(text: Column | str) -> Column:
    """A JSON object as map of raw values, null values dropped; null if it is no object."""
    parsed = F.from_json(as_col(text), "map<string,string>")
    return F.map_filter(parsed, lambda k, v: v.isNotNull())
