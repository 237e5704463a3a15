"""Chats of typed content parts as training text.

A turn is ``### role: text</turn>`` and a line feed. Its text comes from its parts in order: text as
it is, escaped; an image, audio or document part as the placeholder ``<|type|>``, with its reference
and token count recorded in the same order. Inside texts and roles the control strings are written
with a backslash, so that they can be read back: see ``ESCAPES``. Neighbouring text parts are one text
before they are escaped, so a control string cut in two by them is escaped like any other. The loss mask
marks each text of an assistant.

A placeholder expands to the tokens that its part says, or else to those that follow from its size: an
image's patches of ``PATCH`` pixels, ``A_SECOND`` of audio, ``A_PAGE`` of a document. Where no size is given
either, ``TOKENS`` holds.

Turns are put together in pages first, so that one very long chat is many groups; the page texts of a
chat are then joined in order.

Rows: a null text or role is empty; null or empty parts give an empty text; a part of no known type
counts as text. Turns of one chat go by ``turn`` (null first), equal ones by role and content, repeated
rows stay. A null chat id is one chat. An empty table gives an empty one. Other columns are not kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, quoted

ESCAPES = (("\\", "\\b"), ("</turn>", "\\t"), ("###", "\\h"), ("<|", "\\p"))
"""In this order when written; the backslash first, so each backslash of the result starts an escape."""
TOKENS = {"image": 576, "audio": 750, "document": 1024}
"""What a placeholder of each type expands to where its part does not say."""
PATCH, A_SECOND, A_PAGE = 28, 25, 1024
PAGE = 64
SIZES = ("width", "height", "seconds", "pages")
"""Further fields that a part may have."""
PART = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
                                 T.StructField("ref", T.StringType()), T.StructField("tokens", T.LongType())]))
MARK = "\x01"
"""Stands for the edge of a placeholder while texts are escaped; its own occurrences are out of the way by then."""


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: str) -> str:
    for plain, code in reversed(ESCAPES):
        text = text.replace(code, plain)
    return text


def text_part(text: Column) -> Column:
    """The parts of a turn that is one text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens")))


def visit(parts: Column, sizes: Sequence[str] = ()) -> tuple[Column, Column]:
    """The text of the parts, with placeholders, and the attachments ``(type, ref, tokens)`` in order. ``sizes`` names
    the fields of ``SIZES`` that the parts have."""
    attachment = lambda p: F.coalesce(p["type"], F.lit("text")).isin(list(TOKENS))
    # Backslashes first, then the mark: no control string has either, so texts can be joined before the rest is escaped.
    plain = lambda p: F.replace(F.replace(F.coalesce(p["text"], F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit(MARK), F.lit("\\1"))
    body = F.array_join(F.transform(parts, lambda p: F.when(attachment(p), F.concat(F.lit(MARK), p["type"], F.lit(MARK + "\x02"))).otherwise(plain(p))), "")
    for control, code in ESCAPES[1:]:
        body = F.replace(body, F.lit(control), F.lit(code))
    body = F.replace(F.replace(F.replace(body, F.lit(MARK + "\x02"), F.lit("|>")), F.lit(MARK), F.lit("<|")), F.lit("\\1"), F.lit(MARK))
    attached = F.transform(F.filter(parts, attachment), lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded(p, sizes).alias("tokens")))
    return F.coalesce(body, F.lit("")), F.coalesce(attached, F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>"))


def expanded(part: Column, sizes: Sequence[str]) -> Column:
    """The tokens of an attachment."""
    known = F.create_map(*[F.lit(x) for pair in TOKENS.items() for x in pair]).cast("map<string,bigint>")
    ways = [part["tokens"]]
    if {"width", "height"} <= set(sizes):
        patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
        ways.append(F.when((part["type"] == "image") & (part["width"] > 0) & (part["height"] > 0), patches))
    for kind, name, each in (("audio", "seconds", A_SECOND), ("document", "pages", A_PAGE)):
        if name in sizes:
            ways.append(F.when((part["type"] == kind) & (part[name] > 0), F.ceil(part[name] * each)))
    return F.coalesce(*[w.cast("bigint") for w in ways], known[part["type"]])


def format_chats(turns: DataFrame, chat: str = "conv_id", turn: str = "turn", role: str = "role", parts: Column | None = None, text: str = "text", sizes: Sequence[str] = ()) -> DataFrame:
    """One row per chat: ``formatted``; ``loss_spans``, the code points of ``formatted`` under the loss
    mask, end exclusive, one span for each assistant turn; ``attachments`` in order and the
    ``attachment_tokens`` they expand to. ``parts`` is a column of type ``PART``, or with
    the fields of ``SIZES`` that ``sizes`` names; without it each row is one text."""
    body, attached = visit(text_part(quoted(text)) if parts is None else parts, sizes)
    name = F.coalesce(quoted(role).cast("string"), F.lit(""))
    rows = turns.select(quoted(chat).alias("chat"), quoted(turn).cast("long").alias("turn"), name.alias("role"), body.alias("body"), attached.alias("attached"))
    rows = rows.withColumns({"page": F.floor(F.col("turn") / PAGE), "head": F.concat(F.lit("### "), F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\c")), F.lit(": "))})
    loss = F.col("role") == "assistant"
    item = F.struct("turn", "role", "body", "attached", F.concat("head", "body", F.lit("</turn>\n")).alias("whole"), F.length("head").alias("lead"), F.length("body").alias("size"), loss.alias("loss"))
    pages = rows.groupBy("chat", "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    pages = pages.select("chat", "page", F.array_join(F.col("items.whole"), "").alias("whole"), F.flatten("items.attached").alias("attached"), F.col("items.role").alias("roles"),
                         F.transform("items", lambda x: F.struct(F.length(x["whole"]).alias("all"), x["lead"].alias("lead"), x["size"].alias("size"), x["loss"].alias("loss"))).alias("sizes"))
    whole = pages.groupBy("chat").agg(F.array_sort(F.collect_list(F.struct("page", "whole", "attached", "roles", "sizes"))).alias("pages"))
    sizes = F.flatten("pages.sizes")
    state = T.StructType([T.StructField("at", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(state["spans"].dataType).alias("spans"))
    spans = F.aggregate(sizes, start, lambda s, x: F.struct((s["at"] + x["all"]).alias("at"), F.when(x["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + x["lead"]).alias("start"), (s["at"] + x["lead"] + x["size"]).alias("end"))))).otherwise(s["spans"]).alias("spans")), lambda s: s["spans"])
    attachments = F.flatten("pages.attached")
    return whole.select(F.col("chat").alias(chat), F.array_join("pages.whole", "").alias("formatted"), spans.alias("loss_spans"), F.flatten("pages.roles").alias("roles"), attachments.alias("attachments"),
                        F.aggregate(attachments, F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("attachment_tokens"))


def read_back(df: DataFrame) -> DataFrame:
    """Adds what ``formatted`` and ``loss_spans`` say: ``turns``, the role and text of each turn, and ``loss_text``, all text under the mask, unescaped."""

    def function(batches):
        import pyarrow as pa

        for batch in batches:
            formatted, spans = (batch.column(batch.schema.get_field_index(c)) for c in ("formatted", "loss_spans"))
            turns, losses = [], []
            for i in range(batch.num_rows):
                value = formatted[i].as_py()
                turns.append([])
                for piece in value.split("</turn>\n")[:-1]:
                    role, _, body = piece.removeprefix("### ").partition(": ")
                    turns[-1].append({"role": unescape(role.replace("\\c", ":")), "text": unescape(body)})
                losses.append("".join(unescape(value[s["start"]:s["end"]]) for s in spans[i].as_py()))
            made = [pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(losses, pa.string())]
            yield pa.record_batch([*batch.columns, *made], names=[*batch.schema.names, "turns", "loss_text"])

    turn = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    return appended(df, function, ("turns", turn), ("loss_text", T.StringType()))
