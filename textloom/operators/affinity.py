"""Neighbour distances to edge weights, the t-SNE way and the UMAP way."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 64
POINTS = 1024
"""Halvings, and how many points are solved together."""

# Fixed value: smallest kernel width, as a share of the mean neighbour distance.
MIN_SCALE = 1e-3


def _bisect(target: float, value, points: int, rising: bool) -> np.ndarray:
    """For each point a positive number at which ``value`` meets ``target``, by doubling and halving from one."""
    low, high, mid = np.zeros(points), np.full(points, np.nan), np.ones(points)
    for _ in range(STEPS):
        reached = value(mid)
        more = reached < target if rising else reached > target
        low, high = np.where(more, mid, low), np.where(more, high, mid)
        mid = np.where(np.isnan(high), mid * 2, (low + high) / 2)
    return mid


def neighbour_lists(knn: DataFrame) -> DataFrame:
    """``src, near``: the ``k`` neighbours of each point as an ordered array."""
    return knn.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "dist"))).alias("near"))


def _weighted(lists: DataFrame, weights: Callable[[np.ndarray, np.ndarray], np.ndarray], name: str) -> DataFrame:
    """``src, dst`` and ``name``, the weights of each list. ``weights`` has the distances of some points, a column for each,
    nearest first, and which of them there are, lists being of different lengths. It adds up along columns, one after the
    other, so that a point's weights are the same in whatever company it comes."""
    narrow = lists.select("src", F.col("near.dst").alias("dst"), F.col("near.dist").alias("dist"))

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, POINTS):
                src, dst, dist = batch.slice(start, POINTS).columns
                held = dist.value_lengths().to_numpy()
                point = np.repeat(np.arange(len(held)), held)
                place = np.arange(len(point)) - np.repeat(np.cumsum(held) - held, held)
                shape = (int(held.max()), max(len(held), 2))  # a single column would be added up in another order
                far, there = np.zeros(shape), np.zeros(shape, dtype=bool)
                far[place, point], there[place, point] = dist.flatten().to_numpy(), True
                made = weights(far, there)[place, point]
                yield pa.record_batch([src.take(pa.array(point)), dst.flatten(), pa.array(made)], names=["src", "dst", name])

    kinds = dict(lists.select("src", F.col("near.dst")[0].alias("dst")).dtypes)
    return narrow.mapInArrow(function, f"src {kinds['src']}, dst {kinds['dst']}, {name} double")


def conditional_affinities(knn: DataFrame, perplexity: float) -> DataFrame:
    """``src, dst, p`` with p(dst | src): a Gaussian per point, its precision set so that
    the perplexity of the neighbours is met."""
    target = math.log(perplexity)

    def weights(far: np.ndarray, there: np.ndarray) -> np.ndarray:
        d2 = far * far
        d2 = np.where(there, d2 - np.where(there, d2, np.inf).min(axis=0), 0.0)

        def kernel(beta: np.ndarray) -> np.ndarray:
            return np.exp(-d2 * beta) * there

        def entropy(beta: np.ndarray) -> np.ndarray:
            w = kernel(beta)
            total = w.sum(axis=0)
            return np.log(total) + beta * (d2 * w).sum(axis=0) / total

        with np.errstate(all="ignore"):  # of columns without a point
            w = kernel(_bisect(target, entropy, far.shape[1], rising=False))
            return w / w.sum(axis=0)

    return _weighted(neighbour_lists(knn), weights, "p")


def _both_ways(edges: DataFrame, weight: str) -> DataFrame:
    return edges.select("src", "dst", weight).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), weight))


def perplexity_affinities(knn: DataFrame, perplexity: float) -> DataFrame:
    """Symmetric ``src, dst, p`` over both directions, summing to one."""
    points = knn.agg(F.count_if(F.col("rank") == 1)).first()[0]
    return _both_ways(conditional_affinities(knn, perplexity), "p").groupBy("src", "dst").agg(
        (F.sum("p") / F.lit(2.0 * max(points, 1))).alias("p"))


def membership(knn: DataFrame, k: int) -> DataFrame:
    """``src, dst, w``: fuzzy membership; the nearest neighbour counts fully, the width of
    the rest makes the memberships of a point sum to log2(k)."""
    target = math.log2(k)

    def weights(far: np.ndarray, there: np.ndarray) -> np.ndarray:
        nearest = np.where(there & (far > 0), far, np.inf).min(axis=0)
        gap = np.maximum(far - np.where(np.isinf(nearest), 0.0, nearest), 0.0)

        def total(sigma: np.ndarray) -> np.ndarray:
            return (np.exp(-gap / sigma) * there).sum(axis=0)

        with np.errstate(all="ignore"):  # of columns without a point
            floor = MIN_SCALE * far.sum(axis=0) / there.sum(axis=0)
            sigma = np.fmax(np.fmax(_bisect(target, total, far.shape[1], rising=True), floor), 1e-300)
            return np.exp(-gap / sigma)

    return _weighted(neighbour_lists(knn), weights, "w")


def fuzzy_graph(knn: DataFrame, k: int) -> DataFrame:
    """Symmetric ``src, dst, w``: a + b - ab of the two directions."""
    one_way = F.when(F.count(F.lit(1)) == 2, F.max("w") * F.min("w")).otherwise(0.0)
    return _both_ways(membership(knn, k), "w").groupBy("src", "dst").agg((F.sum("w") - one_way).alias("w"))
