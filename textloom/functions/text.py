"""Scalar text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space at the edges of a text.
EDGE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# One JSON separator with all that stands before it since the last one, strings skipped.
_JSON_SEPARATOR = r'\G((?:[^",:]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+[,:])'


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once. Inside lambdas and conditionals Spark
    shares no subexpressions."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Drop Unicode white space and control separators at both ends."""
    return F.btrim(text, F.lit(EDGE_SPACE))


def non_blank(text: Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def capitalise(word: Column) -> Column:
    """First character upper, all others lower."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 2**31 - 1)))


def spaced_json(json_text: Column) -> Column:
    """Put a blank after each comma and colon that stands outside a string."""
    return F.regexp_replace(json_text, _JSON_SEPARATOR, "$1 ")


def content_id(text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the text."""
    return F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 16)


def document_id(given: Column | None, text: Column) -> Column:
    """The record's own id, else one made from its text."""
    if given is None:
        return content_id(text)
    return F.coalesce(F.nullif(given.cast("string"), F.lit("")), content_id(text))
