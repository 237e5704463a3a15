"""Writers for stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.landed import file_offsets, join_by_file

SLICE = ("dataset", "config", "split")


def stage_path(base: str, stage: str, model_id: str | None = None) -> str:
    """Table path of a stage: ``raw``, ``preprocessed``, ``embeddings`` or ``embreduced``,
    the latter two once per model."""
    path = f"{base.rstrip('/')}/{stage}"
    return path if model_id is None else f"{path}/{model_id}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", chunk_size: int | None = None,
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a stage table. Files hold at most ``chunk_size`` rows; only the partitions
    present in ``df`` are replaced; the committer makes the result appear at once.
    ``mode="ignore"`` keeps a table that is there already."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if chunk_size:
        writer = writer.option("maxRecordsPerFile", chunk_size)
    if fmt == "jsonl":
        writer = writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.format(fmt).save(path)


def chunk_plan(df: DataFrame, chunk_size: int, file: Column, row: Column) -> DataFrame:
    """``df`` with ``chunk``, the 1-based number of the output chunk of each row.
    ``row`` counts from 0 in each file without gaps (as a Parquet row index does), so no
    sort is needed; chunks never span files."""
    numbered = df.withColumn("_file", file).withColumn("_row", row)
    per_file = numbered.groupBy("_file").agg((F.floor(F.max("_row") / chunk_size) + 1).cast("long").alias("rows"))
    starts = file_offsets(per_file, F.col("_file"))
    return (
        join_by_file(numbered, starts.select("_file", "first_row"), F.col("_row"))
        .withColumn("chunk", (F.col("first_row") + F.floor(F.col("_row") / chunk_size) + 1).cast("long"))
        .drop("_file", "_row", "first_row")
    )


def rechunk(spark: SparkSession, source: str, target: str, chunk_size: int) -> None:
    """Copy a Parquet table so that each chunk of at most ``chunk_size`` rows, of one source file each,
    is one file; empty files vanish. A chunk is written whole by the task its number is dealt to."""
    rows = spark.read.parquet(source)
    plan = chunk_plan(rows, chunk_size, F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    plan.select(*columns, F.col("chunk").alias("part")).repartition("part").sortWithinPartitions("part").write.mode("overwrite").partitionBy("part").parquet(target)
