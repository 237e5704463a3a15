"""Readers for landed corpus files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.text import non_blank

# Chat columns, and members that may hold a string or a nested value.
CHAT_COLUMNS = ("messages", "input", "tools", "responses_create_params", "ground_truth")
UNION_MEMBERS = ("content",)


def with_variants(dtype: T.DataType) -> T.DataType:
    """Retype union members of a chat column: a JSON string field read as Variant keeps
    strings, lists and objects apart, where a string type would merge them."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(with_variants(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.StructType):
        return T.StructType([
            T.StructField(f.name, T.VariantType() if f.name in UNION_MEMBERS and isinstance(f.dataType, T.StringType)
                          else with_variants(f.dataType), f.nullable)
            for f in dtype
        ])
    return dtype


def chat_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, with_variants(f.dataType) if f.name in CHAT_COLUMNS else f.dataType, f.nullable)
        for f in schema
    ])


CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
               union_content: bool = True, mismatch: str | None = None) -> DataFrame:
    """JSON Lines; blank lines and lines that are no JSON object are dropped, nothing else: a value
    that does not fit its declared type is null. Pass ``schema`` to spare the inference pass over
    the files, and a column name as ``mismatch`` to keep the whole line where a value did not fit."""
    if schema is None:
        schema = spark.read.json(path, mode="DROPMALFORMED").schema
        if union_content:
            schema = chat_schema(schema)
    return lenient(spark.read.schema(with_corrupt(schema)).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT), mismatch)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def lenient(df: DataFrame, mismatch: str | None = None) -> DataFrame:
    """Rows of a permissive read that stand for JSON objects."""
    is_object = F.try_variant_get(F.try_parse_json(CORRUPT), "$", "map<string,variant>").isNotNull()
    kept = df.where(F.col(CORRUPT).isNull() | is_object)
    return kept.drop(CORRUPT) if mismatch is None else kept.withColumnRenamed(CORRUPT, mismatch)


def parsed_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Non-blank lines with the parsed object as Variant; null ``record`` marks a reject."""
    record = F.try_parse_json(line)
    is_object = F.try_variant_get(record, "$", "map<string,variant>").isNotNull()
    return lines.where(non_blank(F.col(line)).isNotNull()).withColumn("record", F.when(is_object, record))


def line_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines read, blank, malformed and kept."""
    blank = non_blank(F.col(line)).isNull()
    record = F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>")
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & record.isNull()).alias("malformed"),
        F.count_if(~blank & record.isNotNull()).alias("kept"),
    )


def read_records(spark: SparkSession, path: str | list[str], fmt: str = "jsonl", schema: T.StructType | None = None,
                 file_column: str | None = "file_name", record_limit: int | None = None) -> DataFrame:
    """Landed records of one slice with the name of the file each came from."""
    if fmt == "jsonl":
        df = read_jsonl(spark, path, schema)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(fmt).load(path)
    if file_column:
        df = df.select("*", F.col("_metadata.file_name").alias(file_column))
    return df if record_limit is None else df.limit(record_limit)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None) -> DataFrame:
    """A stage table, only the named columns."""
    df = spark.read.format("json" if fmt == "jsonl" else fmt).load(path)
    return df.select(*columns) if columns else df


def concat_tables(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_in_file_order(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet rows with ``row_index``: their position when the files are read one after
    the other by name. The window runs over one row per file."""
    df = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    offset = file_offsets(df.groupBy("_file").agg(F.count(F.lit(1)).alias("rows")), F.col("_file"))
    return (
        join_by_file(df, offset.select("_file", "first_row"), F.col("_row"))
        .withColumn("row_index", F.col("first_row") + F.col("_row"))
        .drop("_file", "_row", "first_row")
    )


SALTS = 64


def join_by_file(rows: DataFrame, per_file: DataFrame, row: Column) -> DataFrame:
    """Rows with the values of their file, ``_file``. The one row per file is repeated ``SALTS`` times,
    so the rows of one large file come together in many tasks."""
    salted = per_file.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(row, F.lit(SALTS)).cast("int")).join(salted, ["_file", "_salt"]).drop("_salt")


def file_offsets(counts: DataFrame, order: Column) -> DataFrame:
    """First position of each file, given rows per file."""
    from pyspark.sql import Window

    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first_row", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def zip_by_position(left: DataFrame, right: DataFrame, index: str = "row_index") -> DataFrame:
    """Pair two tables row by row, cut to the shorter."""
    return left.join(right, index)


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``path, length`` of every file below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path", "length")
    )


def stage_sizes(files: DataFrame, stage: Column) -> DataFrame:
    """Files and megabytes per stage with a ``TOTAL`` line."""
    return (
        files.select(stage.alias("stage"), "length")
        .rollup("stage")
        .agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / 1e6).alias("mb"), F.grouping("stage").alias("_total"))
        .select(F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("stage")).alias("stage"), "files", "mb")
    )
