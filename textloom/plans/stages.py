"""The stages of a run over every slice: ingest, embed, reduce.

Each slice may have its own schema and settings, so each gets its own plan; the loop runs
over configured slices, never over data. Tables are partitioned by slice, replaced one
slice at a time, and read back by the next stage. What a stage has finished is written to a
table of its own, so a slice without rows counts too, and one that was cut off does not.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.embed import audit, embed
from textloom.operators.normalize import apply_steps, normalize
from textloom.plans.manifest import pending_slices, slice_part
from textloom.session import remove
from textloom.sources.landed import file_sizes, read_records
from textloom.sources.sinks import SLICE, stage_path, write_table

SLICE_DDL = ", ".join(f"{c} string" for c in SLICE)
REPORT_DDL = f"at long, stage string, {SLICE_DDL}, status string, rows long, files long"


def has_table(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def report_path(base: str) -> str:
    return stage_path(base, "report")


def read_report(spark: SparkSession, base: str) -> DataFrame:
    """What all runs did: a row when a slice starts and one with its counts when it ends."""
    path = report_path(base)
    return spark.read.schema(REPORT_DDL).parquet(path) if has_table(spark, path) else spark.createDataFrame([], REPORT_DDL)


def note(spark: SparkSession, base: str, stage: str, key: tuple, status: str, rows: int = 0, files: int = 0) -> None:
    line = (time.time_ns(), stage, *key, status, rows, files)
    spark.createDataFrame([line], REPORT_DDL).coalesce(1).write.mode("append").parquet(report_path(base))


def finished_slices(spark: SparkSession, base: str, stage: str) -> DataFrame:
    """Slices whose last note in the report says that they ran to their end."""
    lines = read_report(spark, base).where((F.col("stage") == stage) & F.col("status").isin("started", "ran"))
    return lines.groupBy(*SLICE).agg(F.max_by("status", "at").alias("last")).where("last = 'ran'").select(*SLICE)


def slice_filter(row) -> Column:
    return (F.col("dataset") == row["dataset"]) & (F.col("config") == row["config"]) & (F.col("split") == row["split"])


def tagged(df: DataFrame, row) -> DataFrame:
    return df.select("*", *[F.lit(row[c]).alias(c) for c in SLICE])


def read_slice(spark: SparkSession, path: str, fmt: str, columns: str, row) -> DataFrame:
    """The rows of one slice of a stage table, by declared columns: nothing is inferred."""
    schema = f"{columns}, {SLICE_DDL}"
    if not has_table(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format("json" if fmt == "jsonl" else fmt).load(path).where(slice_filter(row)).drop(*SLICE)


def replace_slice(df: DataFrame, path: str, fmt: str, row) -> tuple[int, int]:
    """Write a slice in place of what is there, also when ``df`` is empty; its rows and files."""
    spark = df.sparkSession
    if has_table(spark, path):
        old = file_sizes(spark, path).where(F.forall(F.array(*[slice_part(F.col("path"), c) == row[c] for c in SLICE]), lambda x: x))
        for (folder,) in old.select(F.regexp_extract("path", "^(.*/split=[^/]+)/", 1)).distinct().collect():
            remove(spark, folder)
    write_table(tagged(df, row), path, fmt, row["chunk_size"], SLICE)
    made = read_slice(spark, path, fmt, "id string", row).select(F.col("_metadata.file_path").alias("f")).groupBy("f").count() if has_table(spark, path) else None
    return tuple(made.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()) if made is not None else (0, 0)


def run_slices(spark: SparkSession, slices: DataFrame, base: str, stage: str, force: bool, one: Callable[[dict], tuple[int, int]],
               embedding: bool = False) -> list[dict]:
    """Run ``one`` for each slice that is still to do, with notes in the report table."""
    todo = {tuple(r[c] for c in SLICE) for r in pending_slices(slices, finished_slices(spark, base, stage), force).collect()}
    report = []
    for row in slices.collect():
        key = tuple(row[c] for c in SLICE)
        status, counts = "skipped", (0, 0)
        if embedding and row["skip_embedding"]:
            status = "skip"
        elif key in todo:
            note(spark, base, stage, key, "started")
            status, counts = "ran", one(row.asDict())
        note(spark, base, stage, key, status, *counts)
        report.append({**dict(zip(SLICE, key)), "stage": stage, "status": status, "rows": counts[0], "files": counts[1]})
    return report


def ingest(spark: SparkSession, slices: DataFrame, landing: Callable[[str, str, str], str], base: str,
           fmt: str = "jsonl", steps: Iterable[Callable[[DataFrame], DataFrame]] = (), force: bool = False,
           record_limit: int | None = None, schema: str | None = None, text_column: str | None = None) -> list[dict]:
    """Landed files to canonical rows. ``slices`` carries resolved settings; ``landing``
    names the files of a slice. ``schema`` (DDL) spares the inference pass, ``text_column`` names
    the text field of the ``auto`` strategy; a slice's settings of those names come first."""
    steps = list(steps)

    def one(row: dict) -> tuple[int, int]:
        from pyspark.sql import types as T

        declared = row.get("schema") or schema
        records = read_records(spark, landing(*[row[c] for c in SLICE]), fmt, T.StructType.fromDDL(declared) if declared else None, record_limit=record_limit)
        rows = apply_steps(normalize(records, row["dataset"], row["text_strategy"], row.get("text_column") or text_column), steps)
        return replace_slice(rows, preprocessed(base, row["output_format"]), row["output_format"], row)

    return run_slices(spark, slices, base, "ingest", force, one)


def preprocessed(base: str, fmt: str) -> str:
    """The table of canonical rows of one format."""
    return f"{stage_path(base, 'preprocessed')}/{fmt}"


def embed_slices(spark: SparkSession, slices: DataFrame, base: str, model_id: str,
                 vector: Callable[[Column, dict], Column], force: bool = False) -> list[dict]:
    """Canonical rows to vectors for slices that are not marked ``skip_embedding``.
    ``vector(text, settings)`` builds the vector column."""

    def one(row: dict) -> tuple[int, int]:
        docs = read_slice(spark, preprocessed(base, row["output_format"]), row["output_format"], "id string, text string", row)
        return replace_slice(embed(docs, vector(F.col("text"), row)), stage_path(base, "embeddings", model_id), "parquet", row)

    return run_slices(spark, slices, base, f"embed:{model_id}", force, one, embedding=True)


def audit_slices(spark: SparkSession, base: str, model_id: str) -> DataFrame:
    """Bad and total vectors per slice."""
    return audit(spark.read.parquet(stage_path(base, "embeddings", model_id)), "embeddings", SLICE)


def reduce_slices(spark: SparkSession, slices: DataFrame, base: str, model_id: str, force: bool = False,
                  **options) -> list[dict]:
    """Vectors to 2-D points."""
    from textloom.operators.reduce import reduce

    def one(row: dict) -> tuple[int, int]:
        vectors = read_slice(spark, stage_path(base, "embeddings", model_id), "parquet", "id string, embeddings array<float>", row)
        points = reduce(vectors, ["id"], "embeddings", row["reduce_methods"], row["reduce_n_components"], **options)
        return replace_slice(points, stage_path(base, "embreduced", model_id), "parquet", row)

    return run_slices(spark, slices, base, f"reduce:{model_id}", force, one, embedding=True)
