"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import let
from textloom.llm import bpe, chat, decontaminate, language, passages, prefix_trie, private, runs, simhash, suffixes, toxicity, url_filter, vectors
from textloom.llm.common import documents, held_out, text_hex
from textloom.llm.sql import ORACLES as SQL
from textloom.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(SQL)


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    ranks = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokens = bpe.encode(documents(spark, folder).select("doc_id", "text"), "text", ranks, public_tokenizers.PATTERN, blanks_part=True)
    return bpe.decode(tokens.select("doc_id", "token_ids"), "token_ids", ranks).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        text_hex(F.array_join(F.col("token_ids").cast("array<string>"), " ")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against every benchmark item."""
    marked = decontaminate.mark(documents(spark, folder).select("doc_id", "text"), documents(spark, folder, "benchmark"))
    return marked.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        text_hex(F.array_join("hit_items", ",")).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    mixture = language.learned_from(docs, ~out)
    return language.identify(docs.select("doc_id", "text"), mixture).select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of four fifths of those that have one."""
    docs = documents(spark, folder).select("doc_id", "text")
    out = held_out("doc_id", 5, 0)
    scorer = toxicity.learned_from(docs, documents(spark, folder, "labels"), ~out)
    return toxicity.score(docs, scorer).select(
        "doc_id", out.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


@query
def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one whose texts look like the template, formatted and read back."""
    rows = documents(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    back = chat.read_back(chat.format_chats(rows.unionAll(extra)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), text_hex(turns).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), text_hex(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and the group of near copies it belongs to."""
    marked = simhash.fingerprints(documents(spark, folder).select("doc_id", "text"))
    marked = materialize(marked.select("doc_id", "fingerprint"), "fingerprints")
    return simhash.with_components(marked).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The links and groups of all embeddings."""
    return vectors.near_duplicates(documents(spark, folder, "embeddings"))


@query
def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document less the passages of 20 words or more that occur earlier."""
    return passages.remove_repeats(documents(spark, folder)).select("doc_id", "n_words", "n_removed", text_hex(F.col("kept")).alias("kept_sha256"))


@query
def op5_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document less the strings of 50 bytes or more that a document with a smaller id has."""
    return suffixes.remove_repeats(documents(spark, folder)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_private(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data of every document."""
    found = private.find(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        F.col("doc").alias("doc_id"), *[private.count_of(k).alias(f"n_{k}") for k in private.KINDS],
        text_hex(private.written(F.col("base"))).alias("base_sha256"),
        private.written(F.array_sort(F.concat("base", "found"))).alias("spans"), F.size("found").cast("long").alias("n_found"))


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all conversations, each of which first takes the beginning of another."""
    own = materialize(prefix_trie.sequences(documents(spark, folder, "conversations")), "sequences")
    of = F.col("conv") - F.col("conv") % 5
    heads = own.where("conv % 5 = 0").select(F.col("conv").alias("base"), F.slice("turns", 1, 8).alias("head"))
    shared = (F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % 9).cast("int")
    rebuilt = own.withColumns({"base": of, "h": shared}).join(heads, "base", "left")
    begun = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<string>"))
    rebuilt = rebuilt.select("conv", F.concat(begun, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))
    return prefix_trie.nodes(rebuilt).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


@query
def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document, some of which are first made periodic from a word on."""
    mark = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    draw = F.floor(mark / 10)

    def periodic(words: Column) -> Column:
        size = F.size(words)
        first = (draw % size).cast("int")
        span = (F.lit(1) + F.floor((size - first) / (F.lit(3) + draw % 8))).cast("int")
        turned = F.transform(words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, first + (i - first) % span)))
        return F.when(size > 0, F.array_join(turned, " ")).otherwise("")

    text = F.when(mark % 10 == 0, let(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), periodic)).otherwise(F.col("text"))
    found = runs.find_runs(documents(spark, folder).select("doc_id", text.alias("text")))
    best = F.col("best")
    return found.select("doc_id", "runs", "collapsed", runs.greatest().alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        text_hex(runs.written()).alias("runs_sha256"), text_hex(F.col("collapsed")).alias("collapsed_sha256"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(documents(spark, folder, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")
