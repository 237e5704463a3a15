"""Where a layout begins, and how its points are dealt to blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize, remove

LANDMARKS = 2000
"""At most so many points are landmarks, by hashed row: an eighth of all where those are fewer."""
NEAREST = 5
JITTER = 1e-3


def choose_landmarks(points: DataFrame) -> pd.DataFrame:
    """A hashed sample of ``points`` (``row, v``), of bounded size."""
    n = points.count()
    wanted = min(LANDMARKS, max(n // 8, min(n, 64)))
    picked = points.orderBy(F.xxhash64("row", F.lit(11)), "row").limit(wanted).toPandas()
    return picked.sort_values("row", ignore_index=True)


def near_landmarks(points: DataFrame, marks: pd.DataFrame) -> DataFrame:
    """``row, near, share``: the nearest landmarks of each point by their places in ``marks``, nearest first, and weights
    that fall with distance and sum to one."""
    vectors = points.sparkSession.sparkContext.broadcast(np.stack(marks["v"].to_numpy()).astype(np.float64))
    k = min(NEAREST, len(marks))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vectors.value
        norm = (known**2).sum(1)
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.iloc[start:start + 2048]
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                d2 = np.maximum((x**2).sum(1)[:, None] + norm[None, :] - 2 * x @ known.T, 0)
                near = np.argsort(d2, axis=1, kind="stable")[:, :k]
                d2 = np.take_along_axis(d2, near, axis=1)
                share = np.exp(-3 * d2 / np.maximum(d2[:, -1:], 1e-300))
                yield pd.DataFrame({"row": part["row"].to_numpy(), "near": list(near.astype(np.int32)), "share": list(share / share.sum(1, keepdims=True))})

    return points.select("row", "v").mapInPandas(found, "row long, near array<int>, share array<double>")


def first_axes(vectors: np.ndarray) -> np.ndarray:
    """Two principal components of a bounded sample; the largest loading of each is positive."""
    centred = vectors - vectors.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:2] * np.sign(axes[:2][np.arange(len(axes[:2])), np.abs(axes[:2]).argmax(1)])[:, None]
    spot = centred @ axes.T
    return np.column_stack([spot, np.zeros((len(spot), 2 - spot.shape[1]))])


def curve_order(spot: np.ndarray) -> np.ndarray:
    """The order of places along a Z-shaped curve, in which neighbours mostly stay near."""
    low, high = spot.min(0), spot.max(0)
    cells = ((spot - low) / np.maximum(high - low, 1e-300) * 1023).astype("i8")
    code = np.zeros(len(spot), "i8")
    for bit in range(10):
        code |= (cells[:, 0] >> bit & 1) << 2 * bit | (cells[:, 1] >> bit & 1) << 2 * bit + 1
    return np.argsort(code, kind="stable")


def stretches(counts: np.ndarray, spot: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last block of each cell: stretches along a curve through the cells' places, of about equal counts."""
    order = curve_order(spot)
    before = np.concatenate([[0], np.cumsum(counts[order])])
    target = max(1, -(-int(before[-1]) // blocks))
    first, last = np.empty(len(spot), "i8"), np.empty(len(spot), "i8")
    first[order], last[order] = before[:-1] // target, np.maximum(before[1:] - 1, before[:-1]) // target
    return np.minimum(first, blocks - 1), np.minimum(last, blocks - 1)


def dealt(near: DataFrame, spot: np.ndarray, blocks: int) -> DataFrame:
    """``near`` and ``block``: stretches of landmarks along a curve, of about equal numbers of points; a crowded landmark
    is dealt to several blocks by hashed row. Nothing but a count for each landmark comes to the driver."""
    counts = np.zeros(len(spot), "i8")
    for cell, n in near.groupBy(F.col("near")[0].alias("cell")).count().collect():
        counts[cell] = n
    first, last = stretches(counts, spot, blocks)
    ranges = F.broadcast(near.sparkSession.createDataFrame(
        pd.DataFrame({"cell": np.arange(len(spot), dtype=np.int32), "first": first, "last": last})))
    return near.withColumn("cell", F.col("near")[0]).join(ranges, "cell").withColumn(
        "block", (F.col("first") + F.pmod(F.xxhash64("row", F.lit(3)), F.col("last") - F.col("first") + 1)).cast("int")).drop("cell", "first", "last")


def jittered(name: str, salt: int):
    """A coordinate moved a little by hashed row, so that equal points part."""
    return F.col(name) + (F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(1 << 20)) / (1 << 19) - 1) * F.lit(JITTER)


def scaled(places: DataFrame, reach: float) -> DataFrame:
    """``places`` moved and scaled so that the largest coordinate is ``reach``. Least and greatest values only are used:
    they are the same in whatever order rows come."""
    s = places.agg(*[f(c).alias(f"{n}{c}") for n, f in (("low", F.min), ("high", F.max)) for c in "xy"]).first()
    far = max(s[f"high{c}"] - s[f"low{c}"] for c in "xy") / 2
    factor = reach / far if far > 1e-12 else 0.0
    return places.withColumns({c: (F.col(c) - F.lit((s[f"low{c}"] + s[f"high{c}"]) / 2)) * F.lit(factor) for c in "xy"})


def landmark_start(near: DataFrame, spot: np.ndarray) -> DataFrame:
    """``near`` and ``x, y``: each point at the weighted place of its nearest landmarks."""
    axes = [F.array(*[F.lit(float(v)) for v in spot[:, c]]) for c in (0, 1)]

    def along(axis):
        parts = F.zip_with("near", "share", lambda i, w: F.get(axis, i) * w)
        return F.aggregate(parts, F.lit(0.0), lambda total, v: total + v)

    return near.withColumns({"x": along(axes[0]), "y": along(axes[1])})


COLUMNS = 4
"""Vectors of the power iteration: two more than are wanted, which makes it faster."""
EVERY = 3
FINE = 1 << 44


def whole_sum(value) -> Column:
    """A sum of whole numbers of 2**-44: the same in whatever order rows come, so that runs repeat."""
    return F.sum(F.round(value * F.lit(FINE)).cast("long")) / F.lit(float(FINE))


def spectral(edges: DataFrame, rounds: int = 12, columns: int = COLUMNS) -> DataFrame:
    """``row, x, y``: the second and third eigenvector of ``D^-1/2 W D^-1/2`` by power iteration, each round a join of
    the edges (``src, dst, w``, both ways) with the vectors. The first is known and taken out. Every few rounds the
    vectors are made orthogonal: sums of products, a handful of numbers, come to the driver. Signs are such that the
    point with the smallest row is not negative."""
    degree = materialize(edges.groupBy(F.col("src").alias("row")).agg(whole_sum(F.col("w")).alias("d")), "degree")
    total = degree.agg(F.sum(F.col("d").cast("decimal(38,14)"))).first()[0]
    flow = edges.join(degree.toDF("src", "ds"), "src").join(degree.toDF("dst", "dd"), "dst")
    flow = materialize(flow.select("src", "dst", (F.col("w") / F.sqrt(F.col("ds") * F.col("dd"))).alias("a")), "flow")
    names = [f"v{c}" for c in range(columns)]
    # About as large as the first vector, whose squares add up to one: whole sums of products stay small.
    start = [(F.pmod(F.xxhash64("row", F.lit(100 + c)), F.lit(1 << 30)) / (1 << 29) - 1) * F.col("first") for c in range(columns)]
    now = degree.select("row", F.sqrt(F.col("d") / F.lit(float(total))).alias("first")).select("row", "first", *[v.alias(n) for v, n in zip(start, names)])

    def products(df: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
        sums = df.agg(*[whole_sum(F.col(a) * F.col(b)) for a in left for b in right]).first()
        return np.array(list(sums), dtype=float).reshape(len(left), len(right))

    def mixed(df: DataFrame, weights: np.ndarray, kept: list[str]) -> DataFrame:
        """The vectors ``first, v0, ...`` times a matrix."""
        given = ["first", *names]
        made = [sum((F.col(g) * F.lit(float(weights[i, c])) for i, g in enumerate(given)), F.lit(0.0)).alias(kept[c]) for c in range(len(kept))]
        return df.select("row", "first", *made)

    def orthogonal(df: DataFrame) -> DataFrame:
        """Without the first vector, and orthonormal, by the products of all pairs."""
        gram = products(df, ["first", *names], ["first", *names])
        out = np.eye(columns + 1)
        out[0, 1:] = -gram[0, 1:] / gram[0, 0]
        inner = (out.T @ gram @ out)[1:, 1:]
        values, vectors = np.linalg.eigh(inner)
        good = np.where(values > 1e-14 * max(values.max(), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
        return mixed(df, out[:, 1:] @ (vectors * good), names)

    def applied(df: DataFrame) -> DataFrame:
        """``df`` and the matrix times each vector, as ``m0, m1, ...``."""
        pulled = flow.join(df.select(F.col("row").alias("dst"), *names), "dst").groupBy(F.col("src").alias("row")).agg(
            *[whole_sum(F.col("a") * F.col(n)).alias(f"m{c}") for c, n in enumerate(names)])
        return df.join(pulled, "row")

    now = materialize(orthogonal(materialize(now, "vectors")), "vectors")
    for k in range(1, rounds + 1):
        # Half of the vector stays: eigenvalues from -1 to 1 go to 0 to 1, so the largest win, not the farthest from 0.
        after = applied(now).select("row", "first", *[(F.col(n) / 2 + F.col(f"m{c}") / 2).alias(n) for c, n in enumerate(names)])
        after = materialize(after, "vectors")
        if k % EVERY == 0 or k == rounds:
            after = materialize(orthogonal(after), "vectors")
        now = after
    both = materialize(applied(now), "vectors")
    # Within the span of the vectors, those that the matrix only stretches.
    values, vectors = np.linalg.eigh((lambda h: (h + h.T) / 2)(products(both, names, [f"m{c}" for c in range(columns)])))
    top = np.zeros((columns + 1, 2))
    top[1:] = vectors[:, np.argsort(-values, kind="stable")[:2]]
    found = mixed(both, top, ["x", "y"]).select("row", "x", "y")
    head = found.agg(F.min_by("x", "row").alias("x"), F.min_by("y", "row").alias("y")).first()
    return found.select("row", *[(F.col(c) * F.lit(-1.0 if head[c] < 0 else 1.0)).alias(c) for c in ("x", "y")])
