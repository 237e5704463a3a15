"""Records of any schema to canonical rows ``text, id, source, metadata_json``."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.strategies import STRATEGIES
from textloom.functions.text import document_id, non_blank, spaced_json
from textloom.functions.turns import Typed, as_text

log = logging.getLogger(__name__)

# Column names tried as the text column, in this order.
TEXT_COLUMNS = (
    "text", "content", "document", "passage", "body", "sentence", "paragraph", "raw_text", "article",
)
MIN_TEXT_LENGTH = 20

FILE_COLUMN = "file_name"
CANONICAL = ("text", "id", "source", "metadata_json")


def detect_text_column(df: DataFrame, given: str | None = None) -> str | None:
    """The given column, else a known name, else the first string column with a value of
    more than 20 characters. Only the last rule reads data, in one aggregation."""
    if given and given in df.columns:
        return given
    for name in TEXT_COLUMNS:
        if name in df.columns:
            return name
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != FILE_COLUMN]
    if not strings:
        return None
    longest = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).alias(c) for c in strings]).first()
    return next((c for c in strings if (longest[c] or 0) > MIN_TEXT_LENGTH), None)


def _printable(f: T.StructField) -> Column:
    """Date-times as ``yyyy-mm-dd hh:mm:ss[.ffffff]``; everything else as it is."""
    col = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        micros = F.date_format(col, "SSSSSS")
        col = F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
    return col.alias(f.name)


def metadata_json(schema: T.StructType, exclude: Iterable[str]) -> Column:
    """All other columns as one JSON object, nulls kept."""
    left_out = set(exclude)
    kept = [_printable(f) for f in schema if f.name not in left_out]
    if not kept:
        return F.lit("{}")
    return spaced_json(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}))


def normalize(df: DataFrame, source: str | Column, strategy: str = "auto", text_column: str | None = None,
              carry: Iterable[str] = ()) -> DataFrame:
    """Canonical rows of ``df``; rows without text are dropped.

    ``carry`` names further columns to keep beside the canonical ones (they stay out of
    the metadata), such as partition columns or a row position.
    """
    kept = [c for c in (FILE_COLUMN, *carry) if c in df.columns]
    exclude = {"id", *kept}
    build = STRATEGIES.get(strategy)
    if build is None and strategy != "auto":
        log.warning("unknown text strategy %r, using auto", strategy)
    if build is not None:
        text = non_blank(build(df.schema))
    else:
        name = detect_text_column(df, text_column)
        if name is None:
            text = F.lit(None).cast("string")
        else:
            exclude.add(name)
            text = non_blank(as_text(Typed(F.col(f"`{name}`"), df.schema[name].dataType)))
    given = F.col("id") if "id" in df.columns else None
    tag = F.lit(source) if isinstance(source, str) else source
    # The one-element explode is a boundary the null filter is not pushed through, so the
    # text of a row is built once, not once more for the filter.
    rows = df.select(
        F.explode(F.array(text)).alias("text"),
        *([given.cast("string").alias("_given")] if given is not None else []),
        tag.alias("source"),
        metadata_json(df.schema, exclude).alias("metadata_json"),
        *[F.col(c) for c in kept],
    )
    return rows.where(F.col("text").isNotNull()).select(
        "text",
        document_id(F.col("_given") if given is not None else None, F.col("text")).alias("id"),
        "source",
        "metadata_json",
        *kept,
    )


def apply_steps(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Run user steps between extraction and the sink, in order."""
    for step in steps:
        df = df.transform(step)
    return df


def route_strategies(df: DataFrame, strategy: Column, names: Iterable[str]) -> Column:
    """Text by a per-row strategy name; unknown names use the auto rule."""
    auto = detect_text_column(df)
    fallback = F.lit(None).cast("string") if auto is None else non_blank(
        as_text(Typed(F.col(f"`{auto}`"), df.schema[auto].dataType)))
    routed = fallback
    for name in names:
        if name in STRATEGIES:
            routed = F.when(strategy == name, non_blank(STRATEGIES[name](df.schema))).otherwise(routed)
    return routed
