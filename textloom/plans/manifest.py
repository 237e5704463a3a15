"""Which slices exist, which are done, and what a run did."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.sinks import SLICE


def slices_in_paths(paths: DataFrame, path: Column) -> DataFrame:
    """Distinct ``dataset, config, split`` of landed files at
    ``.../dataset=D/config=C/split=S/...``; a part that is not in the path is null."""
    return paths.select(*[slice_part(path, p).alias(p) for p in SLICE]).distinct()


def slice_part(path: Column, name: str) -> Column:
    """A partition value in a path, as it was before the writer escaped it: ``%2F`` is a slash."""
    raw = F.nullif(F.regexp_extract(path, rf"(?:^|/){name}=([^/]+)/", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def build_manifest(found: DataFrame, forced_configs: DataFrame, split_overrides: DataFrame,
                   url_limit: int | None = None) -> DataFrame:
    """Slices to run.

    ``found(dataset, config, split)``: what has landed. ``forced_configs(dataset, config)``:
    when a dataset is listed there, exactly these configs are used. ``split_overrides
    (dataset, config, split)``: the split of a config, whatever was found. A missing config
    is ``default``, a missing split ``train``.
    """
    named = found.withColumn("config", F.coalesce("config", F.lit("default")))
    kept = named.join(forced_configs.select("dataset").distinct(), "dataset", "left_anti")
    forced = forced_configs.select("dataset", "config").distinct().join(named, ["dataset", "config"], "left")
    over = split_overrides.select("dataset", "config", F.col("split").alias("_split"))
    slices = (
        kept.select(*SLICE).unionByName(forced.select(*SLICE))
        .join(over, ["dataset", "config"], "left")
        .select("dataset", "config", F.coalesce("_split", "split", F.lit("train")).alias("split"))
        .distinct()
    )
    return slices if url_limit is None else slices.orderBy(*SLICE).limit(url_limit)


def manifest_from_landing(spark: SparkSession, root: str, forced_configs: Mapping[str, Sequence[str]] | None = None,
                          split_overrides: Mapping[str, Mapping[str, str]] | None = None,
                          url_limit: int | None = None) -> DataFrame:
    """``build_manifest`` over the files below ``root``."""
    from textloom.sources.landed import file_sizes

    found = slices_in_paths(file_sizes(spark, root), F.col("path")).where(F.col("dataset").isNotNull())
    forced = spark.createDataFrame(
        [(d, c) for d, configs in (forced_configs or {}).items() for c in configs], "dataset string, config string")
    over = spark.createDataFrame(
        [(d, c, s) for d, configs in (split_overrides or {}).items() for c, s in configs.items()],
        "dataset string, config string, split string")
    return build_manifest(found, forced, over, url_limit)


def pending_slices(manifest: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Slices still to run: all of them under ``force``, else those not complete. A
    partial slice is not done; the dynamic overwrite of the sink replaces what it left."""
    if force:
        return manifest
    return manifest.join(done.select(*SLICE).distinct(), list(SLICE), "left_anti")


def pending_rows(rows: DataFrame, sink: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Input rows whose key is not in the sink yet."""
    return rows.join(sink.select(*keys), list(keys), "left_anti")


def stage_status(files: DataFrame, path: Column, keys: Sequence[str]) -> DataFrame:
    """State of each stage directory from its file names: ``partial`` when temporary or
    foreign data files lie there, ``complete`` when only ``part-`` files do."""
    name = F.element_at(F.split(path, "/"), -1)
    data = name.rlike(r"\.(parquet|jsonl|json)$")
    temporary = name.rlike(r"\.tmp$") | name.startswith("_tmp_") | name.startswith("_temporary")
    canonical = data & name.startswith("part-")
    foreign = data & ~name.startswith("part-") & ~name.startswith("_tmp_")
    return (
        files.groupBy(*keys)
        .agg(F.count_if(temporary).alias("_tmp"), F.count_if(canonical).alias("_part"), F.count_if(foreign).alias("_other"))
        .select(
            *keys,
            F.when((F.col("_tmp") > 0) | (F.col("_other") > 0), "partial")
            .when(F.col("_part") > 0, "complete").otherwise("missing").alias("status"),
            (F.col("_part") + F.col("_other")).alias("files"),
        )
    )


def run_report(manifest: DataFrame, rows: DataFrame, keys: Sequence[str] = SLICE, file: str = "file_name") -> DataFrame:
    """One line per slice with its status, rows and files, and a grand total."""
    counts = rows.groupBy(*keys, file).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(*keys).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"))
    lines = manifest.join(counts, list(keys), "left").select(
        *keys,
        F.when(F.col("rows").isNull(), "no_input").otherwise("ran").alias("status"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("files", F.lit(0)).alias("files"),
    )
    total = lines.agg(F.sum("rows").alias("rows"), F.sum("files").alias("files")).select(
        *[F.lit("TOTAL").alias(k) for k in keys], F.lit("all").alias("status"), "rows", "files")
    return lines.unionByName(total)
