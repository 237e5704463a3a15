"""Principal axes of tables too tall for one task and too wide for a matrix of their width squared.

A few more directions than are wanted are turned towards the largest axes by products with the centred rows, each
summed in the tasks that hold the rows; then the rows, seen along those directions only, are factored: every task
gives the triangle of its own QR, triangles are stacked and factored again, and the singular values of the last one are
those of all rows. Nothing is squared on the way. What a task sends and the driver holds is as wide as the rows
and as deep as the number of directions. Where there are as many directions as dimensions nothing is left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPARE = 30
LEAST = 64
"""Directions: as many as are wanted and SPARE more, LEAST at least, or all there are."""
ROUNDS = 60
SETTLED = 1e-9
TASKS = 16


def _stack(batch: pd.Series) -> np.ndarray:
    return np.stack(batch.to_numpy()).astype(np.float64)


def gathered(rows: DataFrame, of_rows: Callable[[np.ndarray | None, np.ndarray], np.ndarray],
             of_two: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """A matrix out of ``rows`` (one array column ``v``): each task adds its batches by ``of_rows``, ``TASKS`` tasks put those
    together by ``of_two``, and the driver the last few. The order is that of the tasks, so runs repeat."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made = None
        for batch in batches:
            if len(batch):
                made = of_rows(made, _stack(batch["v"]))
        if made is not None:
            yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "blob": [pickle.dumps(made)]})

    def folded(parts) -> np.ndarray:
        made = None
        for _, blob in sorted(parts):
            part = pickle.loads(blob)
            made = part if made is None else of_two(made, part)
        return made

    def joined(key, table):
        parts = list(zip(table.column("task").to_pylist(), table.column("blob").to_pylist()))
        return pa.table({"task": pa.array([min(t for t, _ in parts)], pa.int32()), "blob": pa.array([pickle.dumps(folded(parts))], pa.binary())})

    found = rows.mapInPandas(own, "task int, blob binary")
    found = found.groupBy((F.col("task") % TASKS).alias("group")).applyInArrow(joined, "task int, blob binary").collect()
    return folded([(r["task"], bytes(r["blob"])) for r in found]) if found else None


def column_means(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The mean of each dimension, and the number of rows."""

    def add(made, x):
        part = np.append(x.sum(axis=0), len(x))
        return part if made is None else made + part

    total = gathered(rows, add, np.add)
    return total[:-1] / total[-1], int(total[-1])


def triangle(rows: DataFrame, mean: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """The triangle of the QR of the centred rows, seen along ``directions``."""
    shared = rows.sparkSession.sparkContext.broadcast((mean, directions))

    def stacked(made, x):
        mean, directions = shared.value
        x = x - mean
        x = x if directions is None else x @ directions
        return np.linalg.qr(x if made is None else np.vstack([made, x]), mode="r")

    found = gathered(rows, stacked, lambda a, b: np.linalg.qr(np.vstack([a, b]), mode="r"))
    shared.unpersist()
    return found


def leading_directions(rows: DataFrame, mean: np.ndarray, count: int, wanted: int) -> np.ndarray:
    """``count`` orthonormal directions that hold the ``wanted`` largest axes: a hashed start, multiplied by the centred
    rows and their transpose until those axes are still."""
    basis = np.linalg.qr(np.random.default_rng(0).normal(size=(len(mean), count)))[0]
    before = None
    for _ in range(ROUNDS):
        shared = rows.sparkSession.sparkContext.broadcast((mean, basis))

        def product(made, x, shared=shared):
            mean, basis = shared.value
            x = x - mean
            part = x.T @ (x @ basis)
            return part if made is None else made + part

        left, _, _ = np.linalg.svd(gathered(rows, product, np.add), full_matrices=False)
        shared.unpersist()
        basis, axes = left, left[:, :wanted]
        if before is not None:
            away = axes - before @ (before.T @ axes)
            if np.sqrt((away * away).sum()) < SETTLED:
                break
        before = axes
    return basis


def principal_axes(df: DataFrame, vector: str, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, the ``k`` principal axes as columns, and the rows' standard deviations along them. ``df`` should be a written
    table: it is read several times where it is wide. The largest loading of an axis is positive."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v"))
    mean, n = column_means(rows)
    count = min(width, max(k + SPARE, LEAST))
    directions = None if count == width else leading_directions(rows, mean, count, k)
    _, sizes, right = np.linalg.svd(triangle(rows, mean, directions), full_matrices=False)
    axes = right[:k].T if directions is None else directions @ right[:k].T
    axes = np.hstack([axes, np.zeros((width, k - axes.shape[1]))])  # fewer rows than axes
    sizes = np.append(sizes, np.zeros(k))[:k]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    return mean, axes * np.where(signs == 0, 1, signs), sizes / np.sqrt(max(n - 1, 1))
