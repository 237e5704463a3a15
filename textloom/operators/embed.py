"""Text to vectors."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words whose vectors a Python worker keeps at hand.
MEMO_WORDS = 500_000


def tokens(text: Column, max_tokens: int | None = None) -> Column:
    """White-space tokens, cut to ``max_tokens`` when given."""
    found = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    return found if max_tokens is None else F.slice(found, 1, max_tokens)


def word_vector(word: str, width: int) -> np.ndarray:
    """Entries in [-0.5, 0.5) from the 32-bit parts of MD5 digests of ``block:word``."""
    digests = b"".join(hashlib.md5(f"{block}:{word}".encode()).digest() for block in range(-(-width // 4)))
    return np.frombuffer(digests, ">u4")[:width] / 2.0**32 - 0.5


def hash_embed(text: Column, width: int, pooling: str = "mean_pooling", max_tokens: int | None = None) -> Column:
    """Model-free baseline: hashed word vectors, pooled; null without words. Like a model it
    runs on Arrow batches inside the task, so a text is never blown up into word rows and
    nothing is shuffled."""
    if pooling not in ("mean_pooling", "last_token"):
        raise ValueError(f"unknown pooling {pooling!r}")

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, np.ndarray] = {}
        for batch in batches:
            out = []
            for value in batch:
                words = [w for w in re.split(r"\s+", value or "", flags=re.ASCII) if w][:max_tokens]
                if pooling == "last_token":
                    words = words[-1:]
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for word in words:
                    if word not in memo:
                        memo[word] = word_vector(word, width)
                out.append(np.mean([memo[w] for w in words], axis=0).astype(np.float32) if words else None)
            yield pd.Series(out, dtype=object)

    return vectors(text)


def model_embed(text: Column, make_predict_fn: Callable, batch_size: int) -> Column:
    """Vectors of a user model: ``make_predict_fn()`` runs once per Python worker, loads
    the model and returns ``batch of texts -> 2-D array``."""
    return predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)(text)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the files give fewer splits than there are cores; a large
    input has more and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def embed(docs: DataFrame, vector: Column, keys: Sequence[str] = ("id",), name: str = "embeddings") -> DataFrame:
    """Keys and vector only; the text is not copied on."""
    return spread(docs).select(*keys, vector.alias(name))


def is_bad(vector: Column) -> Column:
    """True for a null vector or one with a null or NaN entry."""
    return vector.isNull() | F.exists(vector, lambda x: x.isNull() | F.isnan(x))


def audit(df: DataFrame, vector: str = "embeddings", keys: Sequence[str] = ()) -> DataFrame:
    """Bad and total vectors, per key when keys are given."""
    return df.groupBy(*keys).agg(
        F.count_if(is_bad(F.col(vector))).alias("bad"), F.count(F.lit(1)).alias("total"))
