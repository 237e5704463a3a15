"""Run settings: base values overridden per dataset and per config."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys a slice may override, with their SQL types.
SETTING_TYPES = {
    "text_strategy": "string",
    "text_column": "string",
    "schema": "string",
    "skip_embedding": "boolean",
    "output_format": "string",
    "chunk_size": "int",
    "batch_size": "int",
    "max_seq_length": "int",
    "model_id": "string",
    "embedding_pooling": "string",
    "reduce_methods": "array<string>",
    "reduce_n_components": "int",
}

# What holds when nothing is set. There is no default model.
BASE = {
    "text_strategy": "auto",
    "text_column": None,
    "schema": None,
    "skip_embedding": False,
    "output_format": "parquet",
    "chunk_size": 50_000,
    "batch_size": 1,
    "max_seq_length": 8192,
    "model_id": None,
    "embedding_pooling": "mean_pooling",
    "reduce_methods": ["pca"],
    "reduce_n_components": 2,
}


def overrides_frame(spark: SparkSession, overrides: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """``key`` and one nullable column per setting; unknown settings are ignored."""
    schema = "key string, " + ", ".join(f"{k} {t}" for k, t in SETTING_TYPES.items())
    rows = [(key, *[values.get(k) for k in SETTING_TYPES]) for key, values in overrides.items()]
    return spark.createDataFrame(rows, schema)


def resolve(slices: DataFrame, base: Mapping[str, Any | Column], by_dataset: DataFrame, by_config: DataFrame,
            dataset: str = "dataset", config: str = "config") -> DataFrame:
    """Each slice with its settings: config over dataset over base. The override tables
    hold one row per configured name."""
    d, c = by_dataset.alias("d"), by_config.alias("c")
    keys = [k for k in base if k in by_dataset.columns]
    joined = (
        slices.alias("s")
        .join(d, F.col(f"s.{dataset}") == F.col("d.key"), "left")
        .join(c, F.col(f"s.{config}") == F.col("c.key"), "left")
    )

    def chosen(key: str) -> Column:
        value = base[key]
        default = value if isinstance(value, Column) else F.lit(value)
        return F.coalesce(F.col(f"c.{key}"), F.col(f"d.{key}"), default.cast(SETTING_TYPES[key])).alias(key)

    return joined.select("s.*", *[chosen(k) for k in keys])


def embeddable(slices: DataFrame) -> DataFrame:
    """Slices that go on to the embedding stage."""
    return slices.where(~F.col("skip_embedding"))


def rows_of(df: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that belong to one of the slices."""
    return df.join(slices.select(*keys).distinct(), keys, "left_semi")
