"""Neighbours, affinities and PCA against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import neighbors
from textloom.operators.affinity import conditional_affinities, fuzzy_graph, membership, perplexity_affinities
from textloom.operators.neighbors import knn_graph
from textloom.operators.reduce import covariance, pca, reduce
from textloom.session import materialize


def frame(spark, X):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, v array<double>")


def brute(X, k):
    d2 = ((X[:, None] - X[None]) ** 2).sum(-1)
    out = set()
    for i in range(len(X)):
        order = sorted((d2[i, j], j) for j in range(len(X)) if j != i)[:k]
        out |= {(i, j, r + 1) for r, (_, j) in enumerate(order)}
    return out


def edges_of(graph):
    return {(r["src"], r["dst"], r["rank"]) for r in graph.collect()}


def cloud(seed=0):
    """Two clusters, and one vector that a third of all points share."""
    rng = np.random.default_rng(seed)
    near, far = rng.normal(size=(70, 5)), rng.normal(size=(70, 5)) * 0.1 + 9
    return np.vstack([near, far, np.tile(far[0], (70, 1))])


@pytest.mark.parametrize("cell_rows, block", [(1000, 2_000_000), (10, 2_000_000), (25, 5 * 256)])
def test_knn_is_exact(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(neighbors, "BLOCK_VALUES", block)
    X = cloud()
    assert edges_of(knn_graph(frame(spark, X), "id", "v", 6, cell_rows)) == brute(X, 6)


def test_knn_blocks_split(monkeypatch, spark):
    X = np.random.default_rng(5).normal(size=(700, 3))
    monkeypatch.setattr(neighbors, "BLOCK_VALUES", 3)
    assert edges_of(knn_graph(frame(spark, X), "id", "v", 3, 1000)) == brute(X, 3)


def test_knn_fewer_points_than_k(spark):
    X = np.eye(4)
    assert edges_of(knn_graph(frame(spark, X), "id", "v", 9)) == brute(X, 9)


def test_knn_of_many_pages_and_ties(spark):
    """Whole numbers: many distances are equal and many vectors too; ids are strings."""
    X = np.random.default_rng(6).integers(0, 3, size=(1500, 4)).astype(float)
    df = frame(spark, X).withColumn("id", F.format_string("%05d", "id"))
    for cell_rows in (20, 1000):
        got = {(int(s), int(d), r) for s, d, r in edges_of(knn_graph(df, "id", "v", 7, cell_rows))}
        assert got == brute(X, 7)


def test_visits_are_of_pages_not_of_points(spark, monkeypatch):
    """Where nothing can be ruled out, each page lists each cell once; no row for each point and cell is ever made."""
    X = np.random.default_rng(7).normal(size=(1200, 24))
    made = []
    plans = {name: getattr(neighbors, name) for name in ("visits", "further_visits")}
    for name, plan in plans.items():
        monkeypatch.setattr(neighbors, name, lambda *a, plan=plan: made.append(plan(*a)) or made[-1])
    assert edges_of(knn_graph(frame(spark, X), "id", "v", 5, 30)) == brute(X, 5)
    pages = -(-1200 // neighbors.LEAST_PAGE)
    assert len(made) == 2 and all(p.columns == ["page", "cell"] and p.count() <= pages * 40 for p in made)


def test_pca_matches_svd(spark):
    X = np.random.default_rng(1).normal(size=(60, 6)) * [5, 3, 1, 1, 1, 1] + 7
    got = np.array([r["p"] for r in pca(frame(spark, X), "v", 2, "p").orderBy("id").collect()])
    centred = X - X.mean(0)
    want = centred @ np.linalg.svd(centred)[2][:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-9)
    cov = {(r["i"], r["j"]): r["cov"] for r in covariance(frame(spark, X), "v").collect()}
    assert np.allclose([cov[i, j] for i in range(6) for j in range(i, 6)], np.cov(X.T)[np.triu_indices(6)])


def test_reduce_leaves_bad_rows_out(spark):
    X = np.random.default_rng(2).normal(size=(20, 4))
    rows = [(str(i), [float(v) for v in x]) for i, x in enumerate(X)]
    rows += [("nan", [1.0, float("nan"), 0.0, 0.0]), ("null", None), ("gap", [1.0, None, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, e array<float>")
    out = {r["id"]: r for r in reduce(df, ["id"], "e", ["pca", "nonsense"]).collect()}
    assert len(out) == 23 and list(out["1"].asDict()) == ["id", "pca_2d_x", "pca_2d_y"]
    assert all(np.isnan(out[i]["pca_2d_x"]) == (i in ("nan", "null", "gap")) for i in out)
    few = reduce(df.where("id in ('1', '2', 'nan')"), ["id"], "e", ["pca"]).collect()
    assert len(few) == 3 and all(np.isnan(r[f"{m}_2d_{a}"]) for r in few for m in ("pca",) for a in "xy")
    with pytest.raises(NotImplementedError):
        reduce(df, ["id"], "e", ["pca"], 3)


def test_affinities(spark):
    X = np.random.default_rng(3).normal(size=(80, 4))
    knn = materialize(knn_graph(frame(spark, X), "id", "v", 15), "knn")
    p = conditional_affinities(knn, 5.0).groupBy("src").agg(
        F.sum("p").alias("total"), F.exp(-F.sum(F.col("p") * F.log("p"))).alias("perplexity")).collect()
    assert all(abs(r["total"] - 1) < 1e-9 and abs(r["perplexity"] - 5) < 1e-6 for r in p)
    both = {(r["src"], r["dst"]): r["p"] for r in perplexity_affinities(knn, 5.0).collect()}
    assert abs(sum(both.values()) - 1) < 1e-9 and all(abs(both[j, i] - v) < 1e-12 for (i, j), v in both.items())
    w = membership(knn, 15).groupBy("src").agg(F.sum("w").alias("w")).collect()
    assert all(abs(r["w"] - np.log2(15)) < 1e-6 for r in w)
    fuzzy = {(r["src"], r["dst"]): r["w"] for r in fuzzy_graph(knn, 15).collect()}
    assert all(abs(fuzzy[j, i] - v) < 1e-12 and 0 <= v <= 1 + 1e-12 for (i, j), v in fuzzy.items())


def bisected(reached, target, rising):
    low, high, mid = 0.0, None, 1.0
    for _ in range(64):
        if (reached(mid) < target) if rising else (reached(mid) > target):
            low = mid
        else:
            high = mid
        mid = mid * 2 if high is None else (low + high) / 2
    return mid


def test_lists_of_any_length_are_solved_in_arrays(spark):
    rng = np.random.default_rng(4)
    lists = {f"p{i}": sorted(rng.uniform(0, 2, 1 + i % 9)) for i in range(60)} | {"same": [0.0, 0.0, 0.0]}
    knn = spark.createDataFrame([(s, f"n{r}", r + 1, float(d)) for s, near in lists.items() for r, d in enumerate(near)], "src string, dst string, rank int, dist double")
    p, w = conditional_affinities(knn, 2.0), membership(knn, 3)
    for df in (p, w):  # not as a loop over the elements of a column
        assert "MapInArrow" in df._jdf.queryExecution().toString() and "lambda x_" not in df._jdf.queryExecution().toString()
    p, w = ({(r["src"], r["dst"]): r[2] for r in df.collect()} for df in (p, w))
    assert len(p) == len(w) == sum(map(len, lists.values()))
    for s, near in lists.items():
        near = np.array(near)
        d2 = near**2 - (near**2).min()

        def entropy(beta):
            e = np.exp(-d2 * beta)
            return np.log(e.sum()) + beta * (d2 * e).sum() / e.sum()

        e = np.exp(-d2 * bisected(entropy, np.log(2.0), False))
        rho = min((x for x in near if x > 0), default=0.0)
        gap = np.maximum(near - rho, 0)
        sigma = max(bisected(lambda x: np.exp(-gap / x).sum(), np.log2(3), True), 1e-3 * near.mean(), 1e-300)
        for r in range(len(near)):
            assert abs(p[s, f"n{r}"] - (e / e.sum())[r]) < 1e-9
            assert abs(w[s, f"n{r}"] - np.exp(-gap / sigma)[r]) < 1e-9


def test_blocks_have_work_for_their_tasks(spark):
    from textloom.operators import reduce

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert reduce._blocks(spark, 500) == 1
        assert reduce._blocks(spark, 10_256) <= 10  # 200 tasks of 51 points before
        assert reduce._blocks(spark, 600_000) >= 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
