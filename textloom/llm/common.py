"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTPUT_BYTES = 8 << 20
"""A task hands rows back to Spark in batches of about this size."""


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less any columns whose names an operator is about to write."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def appended(df: DataFrame, function: Callable[[Iterator], Iterator], *fields: tuple[str, T.DataType], store: str | None = None) -> DataFrame:
    """``df`` and the columns ``function`` makes of its Arrow batches. Columns of those names
    are replaced, as ``withColumn`` would. ``store`` names the worker store it uses, if any."""
    kept = without(df, *[n for n, _ in fields])
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in kept.schema.fields],
                           *[T.StructField(n, t, True) for n, t in fields]])

    def whole(batches):
        drop_stores(store)
        yield from function(batches)
        give_back()

    return kept.mapInArrow(whole, schema)


def give_back() -> None:
    """Returns freed memory to the system: a worker outlives its task, beside those of later stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def per_text(text: str, compute: Callable, weigh: Callable[[object], int], *kinds):
    """A batch function: ``compute(text or '')`` gives the values of the new columns, one for each
    Arrow type in ``kinds``; ``weigh`` their size in bytes. Rows go out in bounded batches."""

    def function(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            start, size, rows = 0, 0, []

            def cut(end):
                part = batch.slice(start, end - start)
                made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                return pa.record_batch([*part.columns, *made], names=[*part.schema.names, *[f"_{k}" for k in range(len(kinds))]])

            for i in range(batch.num_rows):
                rows.append(compute(column[i].as_py() or ""))
                size += weigh(rows[-1])
                if size > OUTPUT_BYTES:
                    yield cut(i + 1)
                    start, size, rows = i + 1, 0, []
            if rows:
                yield cut(batch.num_rows)

    return function


def _stores() -> dict:
    return sys.modules.setdefault("textloom_worker_store", types.ModuleType("textloom_worker_store")).__dict__.setdefault("stores", {})


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, or until a task of another operator drops it. Functions
    travel by value, so their own module's globals are new in each task."""
    return _stores().setdefault(name, {})


def drop_stores(kept: str | None = None) -> None:
    """Forgets what tasks of other operators left in this worker, which would stay beside what this one needs."""
    left = [name for name in _stores() if name != kept]
    for name in left:
        _stores().pop(name).clear()
    if left:
        give_back()


def text_hex(column: Column) -> Column:
    """SHA-256 of a string's UTF-8 bytes, in lower-case hex."""
    return F.sha2(F.encode(column, "utf-8"), 256)


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether the CRC-32 of the id, as decimal text, leaves ``remainder``."""
    return F.crc32(F.encode(F.col(column).cast("string"), "utf-8")) % modulus == remainder
