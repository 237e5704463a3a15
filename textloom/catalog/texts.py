"""Chat flattening, text strategies and normalisation over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.base import query, table
from textloom.functions.strategies import STRATEGIES
from textloom.functions.text import EDGE_SPACE, capitalise, content_id, document_id, strip
from textloom.functions.turns import Typed, flatten_tools, flatten_turns, text_by_group, turns_by_group
from textloom.operators.normalize import apply_steps, detect_text_column, metadata_json, normalize, route_strategies

# -- records ------------------------------------------------------------------------


def conversation_records(spark: SparkSession, folder: str) -> DataFrame:
    return turns_by_group(table(spark, folder, "conversations"), "conv_id", "turn")


def line_turns(text: str = "text", first_role: str = "user", second_role: str = "assistant"):
    """The lines of a text as turns of two alternating roles."""
    return F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(F.when(i % 2 == 0, first_role).otherwise(second_role).alias("role"), line.alias("content")),
    )


def flat(df: DataFrame, column: str):
    return flatten_turns(Typed(F.col(column), df.schema[column].dataType))


# The same in SQL.
CHATS_SQL = """
chats AS (
  SELECT conv_id,
         string_agg(upper(substr(role, 1, 1)) || lower(substr(role, 2)) || ': ' || text, chr(10) ORDER BY turn) AS flat,
         list(struct_pack(role := role, content := text) ORDER BY turn) AS messages
  FROM conversations GROUP BY 1)
"""
LINES_SQL = """
lined AS (
  SELECT *, string_split(text, chr(10)) AS ls FROM documents),
turned AS (
  SELECT *, array_to_string([CASE WHEN i % 2 = 1 THEN 'User: ' ELSE 'Assistant: ' END || ls[i]
                             FOR i IN range(1, len(ls) + 1)], chr(10)) AS flat
  FROM lined)
"""


def _chars(text: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in text)


SPACE_SQL = _chars(EDGE_SPACE)


@query("flatten_messages", f"WITH {CHATS_SQL} SELECT conv_id, flat AS text FROM chats")
def flatten_messages(spark, folder):
    df = conversation_records(spark, folder)
    return df.select("conv_id", flat(df, "messages").alias("text"))


# Very long conversations: the lines of all documents of a language are the turns of one.
@query("flatten_long", """
WITH l AS (SELECT lang, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT lang, count(*) AS turns, string_agg(CASE WHEN i % 2 = 1 THEN 'User: ' ELSE 'Assistant: ' END || line, chr(10) ORDER BY doc_id, i) AS text
FROM l GROUP BY 1""")
def flatten_long(spark, folder):
    lines = table(spark, folder, "documents").select("lang", "doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    turns = lines.withColumns({
        "turn": F.col("doc_id") * 100_000 + F.col("i"), "role": F.when(F.col("i") % 2 == 0, "user").otherwise("assistant")})
    return text_by_group(turns, "lang", "turn")


@query("flatten_lines", f"WITH {LINES_SQL} SELECT doc_id, flat AS text FROM turned")
def flatten_lines(spark, folder):
    df = table(spark, folder, "documents").select("doc_id", line_turns().alias("messages"))
    return df.select("doc_id", flat(df, "messages").alias("text"))


@query("canonical_conversations", f"""
WITH {CHATS_SQL}
SELECT trim(flat, {SPACE_SQL}) AS text, conv_id || '' AS id, 'conversations' AS source,
       '{{"turns": ' || len(messages) || ', "first_role": "' || messages[1].role || '"}}' AS metadata_json
FROM chats""")
def canonical_conversations(spark, folder):
    df = conversation_records(spark, folder).select(F.col("conv_id").alias("id"), "messages")
    records = df.withColumns({"turns": F.size("messages"), "first_role": F.col("messages")[0]["role"]})
    return normalize(records, "conversations", "messages_list", carry=["messages"]).drop("messages")


@query("capitalise_roles", """
SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS role, count(*) AS n
FROM (SELECT upper(event_type) || ' ' || event_type AS event_type FROM events) GROUP BY 1""")
def capitalise_roles(spark, folder):
    raw = F.concat_ws(" ", F.upper("event_type"), "event_type")
    return table(spark, folder, "events").groupBy(capitalise(raw).alias("role")).agg(F.count("*").alias("n"))


@query("content_union", f"""
WITH {LINES_SQL}
SELECT doc_id, 'User: ' || CASE lang WHEN 'en' THEN text WHEN 'de' THEN array_to_string(ls, ' ')
       WHEN 'fr' THEN array_to_string(ls, ' ') ELSE '' END AS text
FROM turned""")
def content_union(spark, folder):
    docs = table(spark, folder, "documents")
    lines = F.split("text", "\n")
    typed_parts = F.transform(lines, lambda line: F.struct(F.lit("text").alias("type"), line.alias("text")))
    content = (
        F.when(F.col("lang") == "en", F.col("text").cast("variant"))
        .when(F.col("lang") == "de", F.to_variant_object(typed_parts))
        .when(F.col("lang") == "fr", F.to_variant_object(lines))
    )
    df = docs.select("doc_id", F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("messages"))
    return df.select("doc_id", flat(df, "messages").alias("text"))


@query("tool_calls", """
SELECT event_id, 'Assistant: ' || CASE WHEN event_type = 'error' THEN 'Seen.' || chr(10) ELSE '' END
       || '[tool_calls: ' || event_type || '(' || props || '), note()]' AS text
FROM events""")
def tool_calls(spark, folder):
    def call(name, arguments):
        return F.struct(F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))

    calls = F.array(call(F.col("event_type"), F.col("props")), call(F.lit("note"), F.lit("")))
    turn = F.struct(
        F.lit("assistant").alias("role"), F.when(F.col("event_type") == "error", "Seen.").alias("content"),
        calls.alias("tool_calls"))
    df = table(spark, folder, "events").select("event_id", F.array(turn).alias("messages"))
    return df.select("event_id", flat(df, "messages").alias("text"))


@query("tool_calls_struct", """
SELECT event_id, 'Assistant: [tool_calls: ' || CASE WHEN event_type = 'error'
       THEN '{"name": null, "arguments": {"user": ' || user_id || ', "type": "error"}}'
       ELSE event_type || '({"user": ' || user_id || ', "type": "' || event_type || '"})' END || ']' AS text
FROM events""")
def tool_calls_struct(spark, folder):
    arguments = F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))
    call = F.struct(F.when(F.col("event_type") != "error", F.col("event_type")).alias("name"), arguments.alias("arguments"))
    turn = F.struct(F.lit("ASSISTANT").alias("role"), F.lit("").alias("content"), F.array(call).alias("tool_calls"))
    df = table(spark, folder, "events").select("event_id", F.array(turn).alias("messages"))
    return df.select("event_id", flat(df, "messages").alias("text"))


@query("tool_definitions", """
SELECT p_partkey, 'Tool: ' || p_name || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE ' - ' || p_type END
       || chr(10) || 'Tool: unknown - ' || p_brand AS text
FROM part""")
def tool_definitions(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", part_tools().alias("tools"))
    return df.select("p_partkey", flatten_tools(Typed(F.col("tools"), df.schema["tools"].dataType)).alias("text"))


def part_tools():
    def tool(name, description):
        return F.struct(F.struct(name.alias("name"), description.alias("description")).alias("function"))

    return F.array(
        tool(F.col("p_name"), F.when(F.col("p_type") != "ECONOMY", F.col("p_type"))),
        tool(F.lit(None).cast("string"), F.col("p_brand")))


# -- strategies ---------------------------------------------------------------------


def by_strategy(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return df.select(*keys, STRATEGIES[name](df.drop(*keys).schema).alias("text"))


@query("strategy_messages_list", f"WITH {CHATS_SQL} SELECT conv_id, flat AS text FROM chats")
def strategy_messages_list(spark, folder):
    return by_strategy(conversation_records(spark, folder), "messages_list", "conv_id")


@query("strategy_messages_concat", f"""
WITH {CHATS_SQL}
SELECT conv_id,
       CASE WHEN messages[1].role = 'system' THEN '' ELSE 'System: Be brief.' || chr(10) END
       || flat || chr(10) || 'Assistant: ' || messages[len(messages)].content AS text
FROM chats""")
def strategy_messages_concat(spark, folder):
    first = F.col("messages")[0]
    df = conversation_records(spark, folder).select(
        "conv_id", F.col("messages").alias("input"),
        F.when(first["role"] == "system", F.concat(F.lit("\n "), first["content"])).otherwise("Be brief.").alias("system_prompt"),
        F.element_at("messages", -1)["content"].alias("output"))
    return by_strategy(df, "messages_concat", "conv_id")


@query("strategy_plain_fallback", f"SELECT doc_id, trim(text, {SPACE_SQL}) AS text FROM documents")
def strategy_plain_fallback(spark, folder):
    df = table(spark, folder, "documents").select("doc_id", F.lit(" ").alias("text"), F.col("text").alias("document"))
    return by_strategy(df, "messages_concat", "doc_id")


TRUTH_SQL = """'{"name": "' || lang || '", "chars": ' || n_chars || '}'"""


def rl_records(spark: SparkSession, folder: str) -> DataFrame:
    truth = F.array(F.struct(F.col("lang").alias("name"), F.col("n_chars").alias("chars")))
    return table(spark, folder, "documents").select(
        "doc_id", F.struct(line_turns().alias("input")).alias("responses_create_params"),
        F.when(F.col("lang") != "en", truth).alias("ground_truth"))


RL_SQL = f"""
WITH {LINES_SQL}
SELECT doc_id, flat || CASE WHEN lang = 'en' THEN '' ELSE chr(10) || 'Ground truth: [' || {TRUTH_SQL} || ']' END AS text
FROM turned"""


@query("strategy_rl_blend", RL_SQL)
def strategy_rl_blend(spark, folder):
    return by_strategy(rl_records(spark, folder), "rl_blend", "doc_id")


@query("strategy_rl_blend_json", RL_SQL)
def strategy_rl_blend_json(spark, folder):
    df = rl_records(spark, folder)
    return by_strategy(df.withColumn("responses_create_params", F.to_json("responses_create_params")), "rl_blend", "doc_id")


@query("strategy_agentic", f"""
WITH {LINES_SQL}
SELECT doc_id, CASE lang WHEN 'en' THEN 'Tool: ' || source || ' - ' || lang || chr(10) || chr(10) ELSE '' END || flat AS text
FROM turned""")
def strategy_agentic(spark, folder):
    tool = F.struct(F.col("source").alias("name"), F.col("lang").alias("description"))
    df = table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", F.array(tool)).alias("tools"), line_turns().alias("messages"))
    return by_strategy(df, "agentic", "doc_id")


@query("strategy_math_proof", f"""
WITH {LINES_SQL}
SELECT doc_id, CASE lang
  WHEN 'en' THEN 'Problem: ' || trim(text, {SPACE_SQL})
  WHEN 'de' THEN 'Formal Statement (Lean 4):' || chr(10) || chr(10) || source || chr(10) || chr(10) || trim(text, {SPACE_SQL})
  WHEN 'fr' THEN 'Problem: ' || trim(text, {SPACE_SQL}) || chr(10) || chr(10) || 'Formal Statement (Lean 4):' || chr(10) || chr(10) || source
  ELSE flat END AS text
FROM turned""")
def strategy_math_proof(spark, folder):
    lang = F.col("lang")
    df = table(spark, folder, "documents").select(
        "doc_id",
        F.when(lang.isin("en", "fr"), F.col("text")).otherwise(F.lit("  ")).alias("problem"),
        F.when(lang.isin("de", "fr"), F.col("source")).alias("lean_header"),
        F.when(lang == "de", F.col("text")).alias("formal_statement"),
        line_turns().alias("messages"))
    return by_strategy(df, "math_proof", "doc_id")


@query("strategy_math_v2", f"""
WITH {LINES_SQL}
SELECT doc_id, CASE WHEN lang = 'en' THEN flat ELSE trim(text, {SPACE_SQL}) END AS text FROM turned""")
def strategy_math_v2(spark, folder):
    df = table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", line_turns()).alias("messages"), F.col("text").alias("problem"))
    return by_strategy(df, "math_v2", "doc_id")


@query("strategy_raw_text", f"SELECT doc_id, nullif(trim(line, {SPACE_SQL}), '') AS text, n FROM "
       f"(SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1, 2)")
def strategy_raw_text(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    df = lines.groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    return by_strategy(df, "raw_text", "doc_id", "n")


@query("strategy_smart", f"""
WITH {LINES_SQL}
SELECT doc_id, CASE lang WHEN 'en' THEN flat WHEN 'de' THEN flat || chr(10) || 'Assistant: ' || source
       ELSE trim(text, {SPACE_SQL}) END AS text FROM turned""")
def strategy_smart(spark, folder):
    lang = F.col("lang")
    df = table(spark, folder, "documents").select(
        "doc_id", F.when(lang == "en", line_turns()).alias("messages"),
        F.when(lang == "de", line_turns()).alias("input"), F.when(lang == "de", F.col("source")).alias("output"), "text")
    return by_strategy(df, "smart", "doc_id")


@query("strategy_routing", f"""
WITH {LINES_SQL}
SELECT doc_id, lang AS slice, trim(CASE lang WHEN 'en' THEN flat ELSE text END, {SPACE_SQL}) AS text FROM turned""")
def strategy_routing(spark, folder):
    settings = spark.createDataFrame(
        [("en", "messages_list"), ("de", "math_v2"), ("fr", "raw_text"), ("es", "no such strategy")],
        "lang string, text_strategy string")
    df = table(spark, folder, "documents").select(
        "doc_id", "lang", "text", F.col("text").alias("problem"), F.when(F.col("lang") == "en", line_turns()).alias("messages"))
    routed = df.join(F.broadcast(settings), "lang", "left")
    text = route_strategies(routed, F.col("text_strategy"), ["messages_list", "math_v2", "raw_text"])
    return routed.select("doc_id", F.col("lang").alias("slice"), text.alias("text"))


# -- normalisation ------------------------------------------------------------------


@query("normalize_documents", f"""
SELECT trim(text, {SPACE_SQL}) AS text, substr(sha256(trim(text, {SPACE_SQL})), 1, 16) AS id, 'documents' AS source,
       '{{"doc_id": ' || doc_id || ', "lang": ' || to_json(lang) || ', "source": ' || to_json(source)
       || ', "n_chars": ' || n_chars || '}}' AS metadata_json
FROM documents WHERE trim(text, {SPACE_SQL}) <> ''""")
def normalize_documents(spark, folder):
    return normalize(table(spark, folder, "documents"), "documents")


@query("normalize_lines", f"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))
SELECT trim(line, {SPACE_SQL}) AS text,
       CASE WHEN i = 1 THEN doc_id || '' ELSE substr(sha256(trim(line, {SPACE_SQL})), 1, 16) END AS id, 'lines' AS source,
       '{{"position": ' || (i - 1) || ', "note": null}}' AS metadata_json
FROM l WHERE trim(line, {SPACE_SQL}) <> ''""")
def normalize_lines(spark, folder):
    docs = table(spark, folder, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    padded = F.concat(F.lit("\t\xa0\x1c "), F.col("line"), F.lit("　\r"))
    records = lines.select(
        F.when(F.col("position") == 0, F.col("doc_id")).alias("id"), padded.alias("body"), "position",
        F.lit(None).cast("string").alias("note"))
    return normalize(records, "lines")


@query("strip_text", f"SELECT doc_id, trim(text, {SPACE_SQL}) AS text FROM documents")
def strip_text(spark, folder):
    padded = F.concat(F.lit(EDGE_SPACE), F.col("text"), F.lit(EDGE_SPACE))
    return table(spark, folder, "documents").select("doc_id", strip(padded).alias("text"))


@query("blank_filter", f"""
SELECT count(*) AS lines_in, count(*) FILTER (WHERE trim(line, {SPACE_SQL}) <> '') AS kept,
       count(*) FILTER (WHERE trim(line, {SPACE_SQL}) = '') AS dropped
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def blank_filter(spark, folder):
    lines = table(spark, folder, "documents").select(F.explode(F.split("text", "\n")).alias("text"))
    kept = strip(F.col("text")) != ""
    return lines.agg(F.count("*").alias("lines_in"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


@query("doc_id_hash", """
SELECT doc_id, substr(sha256(text), 1, 16) AS hash_id, CASE WHEN lang = 'en' THEN doc_id || '' ELSE substr(sha256(text), 1, 16) END AS id
FROM documents""")
def doc_id_hash(spark, folder):
    given = F.when(F.col("lang") == "en", F.col("doc_id").cast("string")).when(F.col("lang") == "de", "")
    return table(spark, folder, "documents").select(
        "doc_id", content_id(F.col("text")).alias("hash_id"), document_id(given, F.col("text")).alias("id"))


@query("metadata_json", """
SELECT event_id, '{"ts": "' || strftime(ts, '%Y-%m-%d %H:%M:%S')
       || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
       || '", "user_id": ' || user_id || ', "event_type": ' || to_json(event_type) || ', "value": ' || value || ', "props": ' || to_json(props) || '}' AS metadata_json
FROM events""")
def metadata_of_events(spark, folder):
    df = table(spark, folder, "events")
    return df.select("event_id", metadata_json(df.schema, ["event_id"]).alias("metadata_json"))


@query("text_field_detect", """
SELECT 'documents' AS table_name, 'text' AS text_column, count(*) AS filled FROM documents WHERE text IS NOT NULL
UNION ALL SELECT 'benchmark', 'text', count(*) FROM benchmark WHERE text IS NOT NULL
UNION ALL SELECT 'pages', CASE WHEN (SELECT max(length(url)) FROM pages) > 20 THEN 'url' ELSE 'html' END, count(*) FROM pages
UNION ALL SELECT 'customer', CASE WHEN (SELECT max(length(c_name)) FROM customer) > 20 THEN 'c_name'
  WHEN (SELECT max(length(c_mktsegment)) FROM customer) > 20 THEN 'c_mktsegment' END, 0 FROM (SELECT 1)""")
def text_field_detect(spark, folder):
    out = None
    for name in ("documents", "benchmark", "pages", "customer"):
        df = table(spark, folder, name)
        found = detect_text_column(df)
        filled = F.lit(0).cast("long") if found is None else F.count(found)
        row = df.agg(filled.alias("filled")).select(
            F.lit(name).alias("table_name"), F.lit(found).cast("string").alias("text_column"), "filled")
        out = row if out is None else out.unionByName(row)
    return out


@query("source_counts", """
SELECT source, count(*) AS rows_in FROM (
  SELECT 'documents' AS source FROM documents UNION ALL SELECT 'benchmark' FROM benchmark) GROUP BY 1""")
def source_counts(spark, folder):
    tagged = normalize(table(spark, folder, "documents"), "documents").unionByName(
        normalize(table(spark, folder, "benchmark"), "benchmark"))
    return tagged.groupBy("source").agg(F.count("*").alias("rows_in"))


@query("smart_mixed", f"""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Formal Statement (Lean 4):' || chr(10) || chr(10) ELSE '' END || trim(text, {SPACE_SQL}) AS text
FROM documents""")
def smart_mixed(spark, folder):
    """Proofs, plain texts and problems in one table: each row by its own columns."""
    kind = F.col("doc_id") % 3
    df = table(spark, folder, "documents").select(
        "doc_id", F.when(kind == 0, F.col("text")).alias("formal_statement"), F.when(kind == 1, F.col("text")).alias("text"),
        F.when(kind == 2, F.col("text")).alias("problem"))
    return by_strategy(df, "smart", "doc_id")


@query("step_hook", f"""
SELECT trim(text, {SPACE_SQL}) AS text, upper(lang) AS source FROM documents WHERE length(trim(text, {SPACE_SQL})) > 500""")
def step_hook(spark, folder):
    rows = normalize(table(spark, folder, "documents"), F.col("lang"))
    steps = [lambda df: df.where(F.length("text") > 500), lambda df: df.withColumn("source", F.upper("source"))]
    return apply_steps(rows, steps).select("text", "source")
