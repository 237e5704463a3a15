"""Named text strategies: how the columns of a record become one text.

A strategy is a function ``schema -> Column``. Which columns exist is settled when the
plan is made; what a row holds in them is settled per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import non_blank, strip
from textloom.functions.turns import (
    Typed, as_text, field, first_turn, flatten_tools, flatten_turns, is_filled_list, is_list, items,
)

Strategy = Callable[[T.StructType], Column]

# Columns tried in turn when a chat record has no turn list.
PLAIN_TEXT_COLUMNS = ("text", "content", "document", "body")


def _null() -> Column:
    return F.lit(None).cast("string")


def column(schema: T.StructType, name: str) -> Typed | None:
    return Typed(F.col(f"`{name}`"), schema[name].dataType) if name in schema.names else None


def _filled(schema: T.StructType, name: str) -> Column:
    """Stripped text of a column, null when blank or absent."""
    found = column(schema, name)
    return _null() if found is None else non_blank(as_text(found))


def _turns(schema: T.StructType, name: str) -> Column:
    found = column(schema, name)
    return _null() if found is None else flatten_turns(found)


def messages_list(schema: T.StructType) -> Column:
    return _turns(schema, "messages")


def messages_concat(schema: T.StructType) -> Column:
    strings = [c for c in PLAIN_TEXT_COLUMNS
               if c in schema.names and isinstance(schema[c].dataType, T.StringType)]
    without_input = F.coalesce(*[_filled(schema, c) for c in strings], _null())
    listed = column(schema, "messages")
    if listed is not None:
        without_input = F.when(is_list(listed), flatten_turns(listed)).otherwise(without_input)
    given = column(schema, "input")
    if given is None or items(given) is None:
        return without_input
    prompt = F.nullif(as_text(column(schema, "system_prompt")), F.lit(""))
    role, content = first_turn(given)
    repeated = F.coalesce((role == "system") & (strip(F.coalesce(content, F.lit(""))) == strip(prompt)), F.lit(False))
    joined = F.concat_ws(
        "\n",
        F.when(~repeated, F.concat(F.lit("System: "), prompt)),
        flatten_turns(given),
        F.concat(F.lit("Assistant: "), F.nullif(as_text(column(schema, "output")), F.lit(""))),
    )
    return F.when(is_list(given), joined).otherwise(without_input)


def rl_blend(schema: T.StructType) -> Column:
    params = column(schema, "responses_create_params")
    if params is None:
        return messages_list(schema)
    if isinstance(params.type, T.StringType):
        params = Typed(F.try_parse_json(params.col), T.VariantType())
    turns = field(params, "input")
    if turns is None:
        return messages_list(schema)
    truth = column(schema, "ground_truth")
    truth_text = F.nullif(as_text(truth), F.lit(""))
    listed = None if truth is None else items(truth)
    if listed is not None:
        truth_text = F.when(~F.coalesce(F.size(listed[0]) == 0, F.lit(False)), truth_text)
    text = F.concat_ws("\n", flatten_turns(turns), F.concat(F.lit("Ground truth: "), truth_text))
    return F.when(is_list(turns), text).otherwise(messages_list(schema))


def agentic(schema: T.StructType) -> Column:
    tools = column(schema, "tools")
    tool_text = _null() if tools is None else flatten_tools(tools)
    filled = is_filled_list(tools) | is_filled_list(column(schema, "messages"))
    return F.when(filled, F.concat_ws("\n\n", tool_text, messages_list(schema)))


def math_proof(schema: T.StructType) -> Column:
    problem = _filled(schema, "problem")
    header = _filled(schema, "lean_header")
    formal = _filled(schema, "formal_statement")
    title = F.when(header.isNotNull() | formal.isNotNull(), F.lit("Formal Statement (Lean 4):"))
    text = F.concat_ws("\n\n", F.concat(F.lit("Problem: "), problem), title, header, formal)
    return F.when(problem.isNull() & formal.isNull(), messages_list(schema)).otherwise(text)


def math_v2(schema: T.StructType) -> Column:
    return F.coalesce(messages_list(schema), _filled(schema, "problem"))


def raw_text(schema: T.StructType) -> Column:
    return _filled(schema, "text")


def smart(schema: T.StructType) -> Column:
    """Pick a strategy by what a row holds, the most specific first. Columns that only other
    rows fill do not count."""
    def given(name: str) -> Column:
        found = column(schema, name)
        return F.lit(False) if found is None else found.col.isNotNull()

    def listed(name: str) -> Column:
        found = column(schema, name)
        return F.lit(False) if found is None else is_list(found)

    names = set(schema.names)
    chain = [
        ({"responses_create_params"}, given("responses_create_params"), rl_blend),
        ({"tools", "messages"}, given("tools") & given("messages"), agentic),
        ({"formal_statement"}, given("formal_statement"), math_proof),
        ({"lean_header"}, given("lean_header"), math_proof),
        ({"input"}, listed("input"), messages_concat),
        ({"messages"}, listed("messages"), messages_list),
        ({"problem"}, given("problem"), math_v2),
        ({"text"}, given("text"), raw_text),
    ]
    chosen = _null()
    for needs, test, strategy in reversed(chain):
        if needs <= names:
            chosen = F.when(test, strategy(schema)).otherwise(chosen)
    return chosen


STRATEGIES: dict[str, Strategy] = {
    "smart": smart,
    "messages_list": messages_list,
    "messages_concat": messages_concat,
    "rl_blend": rl_blend,
    "agentic": agentic,
    "math_proof": math_proof,
    "math_v2": math_v2,
    "raw_text": raw_text,
}


def register_strategy(name: str, strategy: Strategy) -> None:
    """Add a strategy: any ``schema -> Column``, a pandas UDF call included."""
    STRATEGIES[name] = strategy
