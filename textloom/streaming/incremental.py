"""Ingest only what has landed since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.normalize import normalize
from textloom.sources.landed import CORRUPT, lenient, with_corrupt


def landed_stream(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """JSON Lines files as a stream; only lines that are no JSON object are dropped."""
    reader = spark.readStream.schema(with_corrupt(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return lenient(reader.json(landing).select("*", F.col("_metadata.file_name").alias("file_name")))


def incremental_ingest(spark: SparkSession, landing: str, schema: T.StructType, source: str, sink: str,
                       checkpoint: str, strategy: str = "auto", text_column: str | None = None) -> StreamingQuery:
    """Append canonical rows of new files and stop. The checkpoint remembers which files
    are in the sink, so a rerun adds only new ones, each exactly once. Without a strategy
    the text column must follow from the schema: a stream cannot be scanned for it."""
    stream = landed_stream(spark, landing, schema)
    if strategy == "auto" and text_column is None:
        from textloom.operators.normalize import TEXT_COLUMNS

        text_column = next((c for c in TEXT_COLUMNS if c in schema.names), None)
        if text_column is None:
            raise ValueError("name the text column of a stream")
    rows = normalize(stream, source, strategy, text_column)
    return (
        rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
