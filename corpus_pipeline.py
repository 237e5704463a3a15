"""Raw documents to a tokenized training corpus: the stages in order, each a Spark job that
reads what the stage before it has written.

Every stage takes ``(spark, docs, sf_dir)`` and keeps the columns of ``documents``, but for the last, which gives
the tokens. Null and empty texts are not toxic, are near copies of each other, hold no benchmark words and
no personal data, and have no tokens. Repeated ids are rows of their own. Columns beside ``doc_id`` and ``text``
pass through whatever their names: while an operator works they go by names of their position, so that its
own columns cannot meet them. ``n_chars``, where there is one, follows a text that was changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, private, simhash, toxicity
from textloom.llm.common import documents, quoted, text_hex
from textloom.session import materialize, scratch_path, scratch_tables

TOXIC = 0.5
TOKENIZER = "byte_bpe_50k.tiktoken"


def apart(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, and all other columns named by their position."""
    return docs.select("doc_id", "text", *[quoted(c).alias(f"input_{k}") for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")])


def restored(df: DataFrame, docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """The columns of ``docs`` in their order, out of a table made from ``apart(docs)``. Where ``changed`` is true,
    or always where it is not given but the text may differ, ``n_chars`` is counted anew."""

    def column(k: int, name: str) -> Column:
        if name in ("doc_id", "text"):
            return F.col(name)
        if name == "n_chars" and changed is not None:
            return F.when(changed, F.length("text").cast(docs.schema[name].dataType)).otherwise(F.col(f"input_{k}")).alias(name)
        return F.col(f"input_{k}").alias(name)

    return df.select(*[column(k, c) for k, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``, by a scorer learned from the labels of these documents."""
    scorer = toxicity.fit(docs.select("doc_id", "text"), documents(spark, sf_dir, "labels"))
    return restored(toxicity.score(apart(docs), scorer).where(F.col("toxicity") < TOXIC), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (the SimHash operator with its own shingles and distance) the document with the
    smallest id; of rows with that id, the one whose text has the smallest hash, and of equal rows one. A null id
    comes last. Rows are told apart by a number that is written, so that it is the same wherever it is read."""
    rows = materialize(apart(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    marked = simhash.fingerprints(rows.select("row", "doc_id", "text"), "text", "mark")
    small = materialize(marked.select("row", "doc_id", "mark", F.xxhash64("text").alias("hash")), "marks")
    first = simhash.with_components(small, "doc_id", "mark").groupBy("component_point").agg(
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "row")).alias("row"))
    return restored(rows.join(first.select("row"), "row", "left_semi"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window, without the spans of
    ``decontaminate.WINDOW`` or more such words, and the length to match."""
    marked = decontaminate.mark(apart(docs), documents(spark, sf_dir, "benchmark"))
    clean = decontaminate.cut(marked.where(~decontaminate.contaminated()), into="clean_text")
    has_span = F.exists("hit_spans", lambda s: s["end"] - s["start"] >= decontaminate.WINDOW)
    return restored(clean.withColumn("text", F.col("clean_text")), docs, has_span)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts written as its kind, and the length to match."""
    return restored(private.redact(apart(docs)), docs, F.lit(True))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, and the digest of the bytes that they decode to."""
    ranks = bpe.vocabulary(public_tokenizers.path(TOKENIZER))
    tokens = bpe.decode(bpe.encode(docs, "text", ranks, public_tokenizers.PATTERN, blanks_part=True), "token_ids", ranks)
    return tokens.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                         text_hex(F.coalesce("text", F.lit(""))).alias("text_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_private),
    ("tokens", tokenize),
]
ORACLE_SQL = None
"""Learned scores, graph components and merges are beyond SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_tables(spark):  # what a stage has written on the way goes when its result stands
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
