"""Chat turns and tool definitions as text.

Each function takes a column with its Spark type and builds one JVM-side expression for
it. Declared structs and Variant values (for fields that hold a string in one record and
a list in the next) are both understood.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import capitalise, let, spaced_json


class Typed(NamedTuple):
    """A column and its type."""

    col: Column
    type: T.DataType


def field(value: Typed, name: str) -> Typed | None:
    """A member of a struct or Variant object; None when the schema has no such member."""
    if isinstance(value.type, T.StructType):
        if name in value.type.names:
            return Typed(value.col[name], value.type[name].dataType)
    elif isinstance(value.type, T.VariantType):
        return Typed(F.try_variant_get(value.col, f"$.{name}", "variant"), value.type)
    return None


def items(value: Typed) -> tuple[Column, T.DataType] | None:
    """An array column and its element type; null rows where the value is not a list."""
    if isinstance(value.type, T.ArrayType):
        return value.col, value.type.elementType
    if isinstance(value.type, T.VariantType):
        return F.try_variant_get(value.col, "$", "array<variant>"), value.type
    return None


def is_filled_list(value: Typed | None) -> Column:
    found = None if value is None else items(value)
    return F.lit(False) if found is None else F.coalesce(F.size(found[0]) > 0, F.lit(False))


def is_list(value: Typed) -> Column:
    found = items(value)
    return F.lit(False) if found is None else found[0].isNotNull()


def is_object(value: Typed) -> Column:
    if isinstance(value.type, (T.StructType, T.MapType)):
        return value.col.isNotNull()
    if isinstance(value.type, T.VariantType):
        return F.try_variant_get(value.col, "$", "map<string,variant>").isNotNull()
    return F.lit(False)


def as_text(value: Typed | None) -> Column:
    """A string as it is, anything nested as JSON, other scalars by cast."""
    if value is None:
        return F.lit(None).cast("string")
    if isinstance(value.type, T.VariantType):
        plain = F.try_variant_get(value.col, "$", "string")
        return F.when(is_list(value) | is_object(value), spaced_json(plain)).otherwise(plain)
    if isinstance(value.type, (T.StructType, T.ArrayType, T.MapType)):
        return spaced_json(F.to_json(value.col, {"ignoreNullFields": "false"}))
    return value.col.cast("string")


def _content_text(content: Typed | None) -> Column:
    if content is None:
        return F.lit("")
    plain = as_text(content)
    parts = items(content)
    if parts is not None:
        array, element = parts

        def part_text(part: Column) -> Column:
            whole = Typed(part, element)
            inner = field(whole, "text")
            return as_text(whole) if inner is None else F.coalesce(as_text(inner), as_text(whole))

        plain = F.coalesce(F.array_join(F.transform(array, part_text), " "), plain)
    return F.coalesce(plain, F.lit(""))


def _one_call(call: Typed) -> Column:
    inner = field(call, "function")
    if inner is None:
        return _call_body(call)
    return F.when(inner.col.isNotNull() & ~as_text(inner).isNull(), _call_body(inner)).otherwise(_call_body(call))


def _call_body(function: Typed) -> Column:
    name = as_text(field(function, "name"))
    arguments = F.coalesce(as_text(field(function, "arguments")), F.lit(""))
    return F.when(name != "", F.concat(name, F.lit("("), arguments, F.lit(")"))).otherwise(as_text(function))


def _calls_text(calls: Typed | None) -> Column:
    """``[tool_calls: name(args), ...]``, null without calls."""
    found = None if calls is None else items(calls)
    if found is None:
        return F.lit(None).cast("string")
    array, element = found
    rendered = F.array_join(F.transform(array, lambda c: _one_call(Typed(c, element))), ", ")
    return F.when(F.size(array) > 0, F.concat(F.lit("[tool_calls: "), rendered, F.lit("]")))


def _turn_text(turn: Typed) -> Column:
    role = F.coalesce(as_text(field(turn, "role")), F.lit("unknown"))
    content = field(turn, "content")
    calls = _calls_text(field(turn, "tool_calls"))

    def joined(text: Column) -> Column:
        return F.concat_ws("\n", F.nullif(text, F.lit("")), calls)

    if content is None or isinstance(content.type, T.StringType):
        body = joined(_content_text(content))
    else:
        body = let(_content_text(content), joined)
    return F.concat(capitalise(role), F.lit(": "), body)


def flatten_turns(turns: Typed) -> Column:
    """``Role: content`` lines of a turn list; null when it is empty or no list. The test
    is on the size, so that the text is not built once more to be compared."""
    found = items(turns)
    if found is None:
        return F.lit(None).cast("string")
    array, element = found
    lines = F.transform(array, lambda t: F.when(is_object(Typed(t, element)), _turn_text(Typed(t, element))))
    return F.when(F.size(array) > 0, F.array_join(F.filter(lines, lambda line: line.isNotNull()), "\n"))


def first_turn(turns: Typed) -> tuple[Column, Column]:
    """Role and content of the first turn, null without one."""
    array, element = items(turns)
    head = Typed(F.get(array, F.lit(0)), element)
    return as_text(field(head, "role")), as_text(field(head, "content"))


def flatten_tools(tools: Typed) -> Column:
    """``Tool: name - description`` lines; null without a non-empty list."""
    found = items(tools)
    if found is None:
        return F.lit(None).cast("string")
    array, element = found

    def body(function: Typed) -> Column:
        name = F.coalesce(as_text(field(function, "name")), F.lit("unknown"))
        description = F.nullif(as_text(field(function, "description")), F.lit(""))
        return F.concat(F.lit("Tool: "), F.concat_ws(" - ", name, description))

    def line(tool: Column) -> Column:
        outer = Typed(tool, element)
        inner = field(outer, "function")
        if inner is None:
            return F.when(is_object(outer), body(outer))
        unwrapped = F.when(is_object(inner), body(inner)).otherwise(F.concat(F.lit("Tool: "), as_text(inner)))
        return F.when(as_text(inner).isNotNull(), unwrapped).otherwise(F.when(is_object(outer), body(outer)))

    lines = F.filter(F.transform(array, line), lambda text: text.isNotNull())
    return F.when(F.size(array) > 0, F.array_join(lines, "\n"))


def turn_pages(df: DataFrame, key: str, turn: str, role: str = "role", content: str = "text",
               page_turns: int = 1000) -> DataFrame:
    """Turn-per-row input as ``key, _page, _turns``: the turns of ``page_turns`` turn numbers in order, so that the rows
    of one long conversation come together in many tasks."""
    one = F.struct(F.col(turn).alias("_at"), F.col(role).alias("role"), F.col(content).alias("content"))
    plain = F.transform(
        F.array_sort(F.collect_list(one)), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return df.groupBy(F.col(key), F.floor(F.col(turn) / page_turns).alias("_page")).agg(plain.alias("_turns"))


def turns_by_group(df: DataFrame, key: str, turn: str, role: str = "role", content: str = "text",
                   page_turns: int = 1000) -> DataFrame:
    """Turn-per-row input as records ``key, messages``, one for each conversation, in the
    order of ``turn``. Turns are gathered in pages first; only finished pages, in order, meet in one task."""
    pages = turn_pages(df, key, turn, role, content, page_turns)
    ordered = F.array_sort(F.collect_list(F.struct("_page", "_turns")))
    return pages.groupBy(key).agg(F.flatten(F.transform(ordered, lambda p: p["_turns"])).alias("messages"))


def text_by_group(df: DataFrame, key: str, turn: str, role: str = "role", content: str = "text",
                  page_turns: int = 1000) -> DataFrame:
    """``key, turns, text``: how many turns ``turns_by_group`` gives a conversation, and what ``flatten_turns`` makes of
    them, without a list of them all. Each page becomes text in its own task; one task holds a conversation's
    text, no more. A text of more than 2 GB is no value that Spark can hold."""
    pages = turn_pages(df, key, turn, role, content, page_turns)
    flat = flatten_turns(Typed(F.col("_turns"), pages.schema["_turns"].dataType))
    texts = pages.select(key, "_page", F.size("_turns").cast("long").alias("_n"), flat.alias("_text"))
    ordered = F.array_sort(F.collect_list(F.struct("_page", "_text")))
    return texts.groupBy(key).agg(
        F.sum("_n").alias("turns"), F.concat_ws("\n", F.transform(ordered, lambda p: p["_text"])).alias("text"))
