"""Vectors to two dimensions."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.affinity import conditional_affinities, membership
from textloom.operators.axes import principal_axes
from textloom.operators.embed import is_bad
from textloom.operators.layout import BLOCK_POINTS, LEAST_POINTS, Tsne, Umap, layout
from textloom.operators.neighbors import knn_graph
from textloom.operators.starts import choose_landmarks, dealt, first_axes, jittered, landmark_start, near_landmarks, scaled, spectral
from textloom.session import materialize, settled

log = logging.getLogger(__name__)

# The width neighbour graphs work on, and the axis names per target width.
PRE_WIDTH = 50
AXES = {2: ("x", "y")}
ROW = "_row"

# The perplexity of t-SNE, the neighbours of UMAP, and how wide each starts.
PERPLEXITY = 30.0
NEIGHBOURS = 15
START = 0.03
REACH = 10.0

LANDMARK_ROUNDS = {"early": 5, "late": 10}


def valid_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is complete."""
    return df.where(~is_bad(F.col(vector)))


def covariance(df: DataFrame, vector: str) -> DataFrame:
    """Sample covariance of every pair of dimensions as ``i, j, cov`` rows, ``i <= j``.
    Each task adds up the products of its centred rows and passes on one array per dimension."""
    dense = df.select(F.col(vector).cast("array<double>").alias("v"))
    stats = dense.select(array_to_vector("v").alias("v")).select(
        Summarizer.metrics("mean", "count").summary(F.col("v")).alias("s")).first()["s"]
    mean, n = stats["mean"].toArray(), stats["count"]

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(mean), len(mean)))
        for batch in batches:
            centred = np.stack(batch["v"].to_numpy()) - mean
            total += centred.T @ centred
        yield pd.DataFrame({"i": np.arange(len(mean), dtype=np.int32), "p": [total[i, i:] for i in range(len(mean))]})

    # One row for each dimension and task; the sums are combined before the shuffle.
    partial = dense.mapInPandas(products, "i int, p array<double>").select("i", array_to_vector("p").alias("p"))
    rows = partial.groupBy("i").agg(vector_to_array(Summarizer.sum(F.col("p"))).alias("p"))
    return rows.select("i", F.posexplode("p").alias("_k", "p")).select(
        "i", (F.col("i") + F.col("_k")).cast("int").alias("j"), (F.col("p") / F.lit(n - 1)).alias("cov"))


def pca(df: DataFrame, vector: str, k: int, output: str) -> DataFrame:
    """Add ``output``: the ``k`` principal components as ``array<double>``.

    No matrix of the width squared is made anywhere, see ``axes``. Rows must be complete. The sign of a component is
    fixed by making its largest loading positive.
    """
    width = df.agg(F.max(F.size(vector))).first()[0] or k
    mean, axes, _ = principal_axes(df, vector, k, width)

    @F.pandas_udf("array<double>")
    def scores(vectors: pd.Series) -> pd.Series:
        return pd.Series(list((np.stack(vectors.to_numpy()) - mean) @ axes))

    return df.withColumn(output, scores(F.col(vector).cast("array<double>")))


def pre_reduce(df: DataFrame, vector: str, width: int, output: str) -> DataFrame:
    """At most ``PRE_WIDTH`` dimensions, by PCA when there are more."""
    if width <= PRE_WIDTH:
        return df.withColumn(output, F.col(vector).cast("array<double>"))
    return pca(df, vector, PRE_WIDTH, output)


def _pca_points(vectors: DataFrame, width: int, options: dict) -> DataFrame:
    k = min(2, width)
    return pca(vectors, "_vec", k, "_p").select(
        ROW, F.get("_p", F.lit(0)).alias("x"), F.coalesce(F.get("_p", F.lit(1)), F.lit(0.0)).alias("y"))


def _graph(vectors: DataFrame, width: int, shared: dict, k: int) -> tuple[DataFrame, DataFrame, int, int]:
    """``row, v`` at most ``PRE_WIDTH`` wide and each point's ``k`` nearest others, or all; made once for all methods."""
    if shared.get("graph_k", 0) < k:
        if "points" not in shared:
            shared["points"] = materialize(pre_reduce(vectors, "_vec", width, "v").select(F.col(ROW).alias("row"), "v"), "points")
            shared["count"] = shared["points"].count()
        found = min(k, shared["count"] - 1)
        shared["graph"] = settled(vectors.sparkSession, "graph", lambda: shared.get("search", knn_graph)(shared["points"], "row", "v", found))
        shared["graph_k"] = k
    found = min(k, shared["count"] - 1)
    return shared["points"], shared["graph"].where(F.col("rank") <= found), found, shared["count"]


def _blocks(spark, points: int) -> int:
    """Enough for tasks of bounded size, and for a small cluster's cores where there is work for them: a block of few
    points costs a task in every round and little else."""
    return max(1, -(-points // BLOCK_POINTS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), points // LEAST_POINTS))


def _tsne(graph: DataFrame, start: DataFrame, perplexity: float, k: int, n: int, **settings) -> DataFrame:
    """``start`` (``row, x, y, block``) laid out by the affinities of a neighbour graph."""
    met = min(perplexity, max(1.01, k / 3))
    edges = conditional_affinities(graph, met).select("src", "dst", F.col("p").alias("w"))
    return layout(start.withColumns({c: jittered(c, s) for s, c in enumerate(("x", "y"))}), edges, Tsne(n, **settings))


def _tsne_points(vectors: DataFrame, width: int, options: dict) -> DataFrame:
    """t-SNE. Landmarks, a hashed sample, are laid out first from their principal components; all points start at the
    weighted place of their nearest landmarks, close together, and are laid out along their own neighbours."""
    spark, perplexity = vectors.sparkSession, options.get("perplexity", PERPLEXITY)
    points, graph, k, n = _graph(vectors, width, options, math.ceil(3 * perplexity))
    marks, own = choose_landmarks(points), options.get("tsne", {})

    def made() -> DataFrame:
        spot = first_axes(np.stack(marks["v"].to_numpy()).astype(float))
        few = len(marks)
        frame = pd.DataFrame({"row": marks["row"], "x": spot[:, 0], "y": spot[:, 1]})
        small = scaled(spark.createDataFrame(frame), START)
        blocks = _blocks(spark, few)
        near_k = min(math.ceil(3 * perplexity), few - 1)
        sample = materialize(spark.createDataFrame(marks.assign(v=[list(map(float, v)) for v in marks["v"]]), "row long, v array<double>"), "landmarks")
        laid = _tsne(materialize(knn_graph(sample, "row", "v", near_k), "graph"), small.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")),
                     perplexity, near_k, few, **{**LANDMARK_ROUNDS, **own}).toPandas().sort_values("row", ignore_index=True)
        spot = laid[["x", "y"]].to_numpy()
        near = materialize(near_landmarks(points, marks), "near")
        begun = materialize(landmark_start(dealt(near, spot, _blocks(spark, n)), spot).select("row", "x", "y", "block"), "start")
        return _tsne(graph, scaled(begun, START), perplexity, k, n, **own)

    return settled(spark, "tsne", made).withColumnRenamed("row", ROW)


def _umap_points(vectors: DataFrame, width: int, options: dict) -> DataFrame:
    """UMAP, from a spectral start on the fuzzy graph."""
    spark, neighbours = vectors.sparkSession, options.get("neighbours", NEIGHBOURS)
    points, graph, k, n = _graph(vectors, width, options, neighbours)

    def made() -> DataFrame:
        weights = materialize(membership(graph, max(k, 2)), "membership")
        both = F.when(F.count(F.lit(1)) == 2, F.max("w") * F.min("w")).otherwise(0.0)
        # Each pair once, with a point that has the other among its neighbours: no point owns more than those.
        pairs = weights.groupBy(F.least("src", "dst").alias("one"), F.greatest("src", "dst").alias("two")).agg(F.min("src").alias("src"), (F.sum("w") - both).alias("w"))
        pairs = materialize(pairs.select("src", F.when(F.col("src") == F.col("one"), F.col("two")).otherwise(F.col("one")).alias("dst"), "w"), "pairs")
        begun = spectral(pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
        marks = choose_landmarks(points)
        near = materialize(near_landmarks(points, marks), "near")
        blocks = dealt(near, first_axes(np.stack(marks["v"].to_numpy()).astype(float)), _blocks(spark, n)).select("row", "block")
        start = materialize(scaled(begun, REACH).join(blocks, "row"), "start")
        heaviest = pairs.agg(F.max("w")).first()[0]
        return layout(start.withColumns({c: jittered(c, s) for s, c in enumerate(("x", "y"))}), pairs, Umap(n, heaviest, **options.get("umap", {})))

    return settled(spark, "umap", made).withColumnRenamed("row", ROW)


Reducer = Callable[[DataFrame, int, dict], DataFrame]

REDUCERS: dict[str, Reducer] = {"pca": _pca_points, "tsne": _tsne_points, "umap": _umap_points}
"""By name; add others that take the valid vectors, their width and options, and give ``_row, x, y``."""


def reduce(df: DataFrame, id_columns: Sequence[str], vector: str, methods: Sequence[str] = ("pca",),
           n_components: int = 2, **options) -> DataFrame:
    """Id columns and ``{method}_2d_x``, ``{method}_2d_y`` floats for every input row.

    Rows with a null or NaN in the vector take no part in a fit and come back as NaN; so
    does every row when no more than ``n_components`` are valid. Unknown methods are
    skipped. ``options`` go to the reducers: ``perplexity``, ``neighbours``, ``search`` (how neighbours are found:
    ``knn_graph``, or ``knn_descent`` for many wide rows), and ``tsne`` and ``umap`` with settings of the layouts.
    """
    if n_components not in AXES:
        raise NotImplementedError(f"n_components={n_components} is not supported")
    known = []
    for method in methods:
        if method in REDUCERS:
            known.append(method)
        else:
            log.warning("unknown reduction %r skipped", method)
    rows = materialize(df.select(
        *id_columns, F.col(vector).cast("array<float>").cast("array<double>").alias("_vec"),
        F.monotonically_increasing_id().alias(ROW)), "vectors")
    valid = valid_vectors(rows, "_vec").select(ROW, "_vec")
    usable, width = valid.agg(F.count(F.lit(1)), F.max(F.size("_vec"))).first()
    out = rows.select(*id_columns, ROW)
    shared = dict(options)
    for method in known:
        names = [f"{method}_{n_components}d_{axis}" for axis in AXES[n_components]]
        if usable > n_components:
            points = REDUCERS[method](valid, width, shared).select(
                ROW, F.col("x").cast("float").alias(names[0]), F.col("y").cast("float").alias(names[1]))
            out = out.join(points, ROW, "left")
        else:
            out = out.withColumns({n: F.lit(None).cast("float") for n in names})
        out = out.withColumns({n: F.coalesce(F.col(n), F.lit(float("nan")).cast("float")) for n in names})
    return out.drop(ROW)
