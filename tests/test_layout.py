import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import layout as L
from textloom.operators import starts as S
from textloom.operators.reduce import reduce

SMALL = "/root/testdata/sf0.01"


def near_sets(x, k):
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    return [set(r) for r in np.argsort(d, axis=1, kind="stable")[:, :k].tolist()]


def preserved(x, y, k=15):
    return np.mean([len(a & b) / k for a, b in zip(near_sets(x, k), near_sets(y, k))])


def brute_push(spot):
    apart = spot[:, None] - spot[None]
    near = 1 / (1 + (apart**2).sum(-1))
    return (near[..., None] ** 2 * apart).sum(1), near.sum()


@pytest.mark.parametrize("spread", [0.01, 1.0, 12.0])
def test_field_is_that_of_all_pairs(spread):
    spot = np.random.default_rng(1).normal(size=(400, 2)) * spread
    grid = L.Grid.around(np.abs(spot).max())
    node, part = grid.shares(spot)
    field, total = grid.field(np.bincount(node.ravel(), part.ravel(), grid.nodes**2))
    push, all_pairs = brute_push(spot)
    got = (field[node] * part[:, :, None]).sum(1)
    assert abs(total / all_pairs - 1) < 1e-3
    assert np.abs(got - push).max() < 1e-2 * np.abs(push).max()  # of cubic interpolation at steps of 0.3


def test_grid_is_bounded():
    assert [L.Grid.around(r).nodes for r in (0, 10, 100, 1e6)] == [64, 128, 1024, 1024]


def split(rows, spot, state, edges, block_of):
    """Blocks of a graph as the wiring makes them, in plain Python."""
    out = {}
    pos = {}
    for b in sorted(set(block_of)):
        own = [i for i in range(len(rows)) if block_of[i] == b]
        pos |= {i: (b, k) for k, i in enumerate(own)}
        out[b] = own
    blocks = {}
    for b, own in out.items():
        mine = [(s, d, w) for s, d, w in edges if block_of[s] == b]
        ghosts = sorted({pos[d] for _, d, _ in mine if block_of[d] != b})
        at = {g: len(own) + k for k, g in enumerate(ghosts)}
        where = {v: k for k, v in pos.items()}
        dst = np.array([pos[d][1] if block_of[d] == b else at[pos[d]] for _, d, _ in mine], "i8")
        blocks[b] = L.Block(rows[own], spot[own], state[own], np.array([pos[s][1] for s, _, _ in mine], "i8"), dst, np.array([w for *_, w in mine]),
                            spot[[where[g] for g in ghosts]].reshape(-1, 2), np.zeros((len(own), 3)))
    return out, blocks, pos


def test_springs_of_blocks_add_up_to_those_of_the_whole():
    rng = np.random.default_rng(2)
    n = 60
    spot, rows = rng.normal(size=(n, 2)), np.arange(n)
    edges = [(s, int(d), rng.random()) for s in range(n) for d in rng.choice(n, 5, replace=False) if d != s]
    whole = np.zeros((n, 3))
    for s, d, w in edges:
        whole[s] += w * np.array([1, *spot[d]])
        whole[d] += w * np.array([1, *spot[s]])
    owned, blocks, pos = split(rows, spot, np.zeros((n, 4)), edges, rng.integers(0, 4, n).tolist())
    got = np.zeros((n, 3))
    where = {v: k for k, v in pos.items()}
    for b, block in blocks.items():
        own, far = block.pulled(block.weight, np.concatenate([block.spot, block.ghosts]))
        got[owned[b]] += own
        for k, place in enumerate(far):
            i = next(j for j in range(n) if np.array_equal(spot[j], block.ghosts[k]))
            got[i] += place
    assert where and np.allclose(got, whole)


def test_wiring_and_mail(spark):
    """A round without moves brings every ghost its place and every point its springs."""
    rng = np.random.default_rng(3)
    n = 90
    spot = rng.normal(size=(n, 2))
    points = spark.createDataFrame(pd.DataFrame({"row": np.arange(n) * 7, "block": (np.arange(n) % 5).astype("i4"), "x": spot[:, 0], "y": spot[:, 1]}))
    pairs = [(s, int(d), float(rng.random())) for s in range(n) for d in rng.choice(n, 4, replace=False) if d != s] + [(s, 0, 0.5) for s in range(1, n)]
    edges = spark.createDataFrame([(s * 7, d * 7, w) for s, d, w in pairs], "src long, dst long, w double")

    class Still(L.Tsne):
        rounds = 2

        def move(self, b, at):
            places = np.concatenate([b.spot, b.ghosts])
            own, far = b.pulled(b.weight, places)
            if at == 1:
                b.spot = (own + b.springs)[:, 1:]  # so that the result shows them
            return far

    still = Still(n)
    got = L.layout(points, edges, still).toPandas().sort_values("row")[["x", "y"]].to_numpy()
    whole = np.zeros((n, 2))
    for s, d, w in pairs:
        whole[s] += w * spot[d]
        whole[d] += w * spot[s]
    assert np.allclose(got, whole)


def vectors(spark):
    return spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id")


@pytest.fixture(scope="module")
def laid(spark):
    df = vectors(spark)
    out = reduce(df, ["vec_id"], "embedding", ["pca", "tsne", "umap"]).toPandas().sort_values("vec_id")
    return np.stack(df.toPandas()["embedding"].to_numpy()).astype(float), out


def test_layouts_keep_more_neighbours_than_pca(laid):
    x, out = laid
    kept = {m: preserved(x, out[[f"{m}_2d_x", f"{m}_2d_y"]].to_numpy().astype(float)) for m in ("pca", "tsne", "umap")}
    print(kept)
    assert np.isfinite(out.drop(columns="vec_id").to_numpy()).all()
    assert kept["tsne"] > 2.5 * kept["pca"] and kept["umap"] > 2 * kept["pca"]


def test_layouts_repeat(spark, laid):
    _, first = laid
    again = reduce(vectors(spark), ["vec_id"], "embedding", ["tsne", "umap"]).toPandas().sort_values("vec_id")
    for name in ("tsne_2d_x", "tsne_2d_y", "umap_2d_x", "umap_2d_y"):
        assert np.array_equal(first[name].to_numpy(), again[name].to_numpy())


def test_clusters_part(spark):
    """Three far clusters and a crowd of copies: no cluster is torn, no two are mixed, all rows are placed."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(60, 8)) + 40 * c for c in range(3)] + [np.tile(rng.normal(size=(1, 8)) - 60, (90, 1))])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "v": [list(map(float, r)) for r in x]}))
    out = reduce(df, ["id"], "v", ["tsne", "umap"], perplexity=10).toPandas().sort_values("id")
    kind = np.repeat([0, 1, 2, 3], [60, 60, 60, 90])
    for m in ("tsne", "umap"):
        y = out[[f"{m}_2d_x", f"{m}_2d_y"]].to_numpy().astype(float)
        assert np.isfinite(y).all()
        same = np.mean([np.mean(kind[list(s)] == kind[i]) for i, s in enumerate(near_sets(y, 10))])
        assert same > 0.97, m


@pytest.mark.parametrize("n", [3, 9])
def test_few_points(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 5))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(100, None), (101, [float("nan")] * 5)]
    out = reduce(spark.createDataFrame(rows, "id long, v array<double>"), ["id"], "v", ["tsne", "umap"]).toPandas().set_index("id").sort_index()
    assert np.isfinite(out.loc[:50].to_numpy()).all() and np.isnan(out.loc[100:].to_numpy()).all()


def test_spectral_start_is_that_of_numpy(spark):
    rng = np.random.default_rng(6)
    n = 40
    w = np.zeros((n, n))
    for i in range(n):  # a ring with chords: its second and third vectors stand out
        for j in (i + 1, i + 2, i + 3):
            w[i, j % n] = w[j % n, i] = 0.5 + rng.random()
    d = w.sum(1)
    values, vectors = np.linalg.eigh(w / np.sqrt(d[:, None] * d[None]))
    want = vectors[:, [-2, -3]]
    edges = spark.createDataFrame([(int(i), int(j), float(w[i, j])) for i, j in zip(*np.nonzero(w))], "src long, dst long, w double")
    got = S.spectral(edges, rounds=60).toPandas().sort_values("row")[["x", "y"]].to_numpy()
    assert got[0, 0] >= 0 and got[0, 1] >= 0
    for c in (0, 1):
        assert abs(abs(got[:, c] @ want[:, c]) - 1) < 1e-6


def test_points_start_among_their_landmarks(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(100, 6)), rng.normal(size=(100, 6)) + 30])
    points = spark.createDataFrame(pd.DataFrame({"row": np.arange(200), "v": [list(map(float, r)) for r in x]}))
    marks = S.choose_landmarks(points)
    assert len(marks) == 64 and marks["row"].is_monotonic_increasing
    near = S.near_landmarks(points, marks)
    rows = near.toPandas().sort_values("row")
    known = np.stack(marks["v"].to_numpy())
    want = np.argsort(((x[:, None] - known[None]) ** 2).sum(-1), axis=1)[:, :S.NEAREST]
    assert np.array_equal(np.stack(rows["near"].to_numpy()), want)
    assert np.allclose(np.stack(rows["share"].to_numpy()).sum(1), 1)
    spot = rng.normal(size=(64, 2))
    got = S.landmark_start(near, spot).toPandas().sort_values("row")
    assert np.allclose(got[["x", "y"]], (np.stack(rows["share"].to_numpy())[:, :, None] * spot[want]).sum(1))


def test_blocks_are_even_though_a_third_share_a_landmark(spark):
    rows = [(i, [0], [1.0]) for i in range(400)] + [(1000 + i, [1 + i % 63], [1.0]) for i in range(800)]
    near = spark.createDataFrame(rows, "row long, near array<int>, share array<double>")
    sizes = [r["count"] for r in S.dealt(near, np.random.default_rng(0).normal(size=(64, 2)), 12).groupBy("block").count().collect()]
    assert len(sizes) == 12 and sum(sizes) == 1200 and max(sizes) < 200


def peak(work):
    """Bytes of the arrays that ``work`` makes, at most at a time."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def crowded(width, columns, n=500, edges=1_500_000, ghosts=2000):
    rng = np.random.default_rng(9)
    return L.Block(np.arange(n), rng.normal(size=(n, 2)), np.tile([0.0, 0.0, 1.0, 1.0], (n, 1))[:, :columns], np.sort(rng.integers(0, n, edges)).astype("i4"),
                   rng.integers(0, n + ghosts, edges).astype("i4"), rng.random(edges), rng.normal(size=(ghosts, 2)), np.zeros((n, width)))


def test_springs_take_room_for_some_edges_only():
    b = crowded(3, 4)
    places = np.concatenate([b.spot, b.ghosts])
    own, far = np.zeros((len(b.rows), 3)), np.zeros((len(places), 3))
    for end, other, to in ((b.src, b.dst, own), (b.dst, b.src, far)):
        to += np.stack([np.bincount(end, b.weight * c, len(to)) for c in (1, *places[other].T)], axis=1)
    got = b.pulled(b.weight, places)
    assert np.allclose(got[0], own + far[:500]) and np.allclose(got[1], far[500:])
    near, none = b.pulled(b.weight, places, far=False)
    assert np.allclose(near, got[0]) and not len(none)
    assert peak(lambda: L.Tsne(500, field=np.zeros((64 * 64, 2), "f4")).move(b, 0)) < 50e6


def test_wires_name_ghosts_by_owner(spark):
    """Ghosts come in order of their owners, each once, and each owner is told the same places."""
    points = spark.createDataFrame([(r, r % 3, 0.0, 0.0) for r in range(12)], "row long, block int, x double, y double")
    edges = spark.createDataFrame([(0, d, 1.0) for d in (11, 4, 2, 3, 8, 1)] + [(3, 11, 1.0)], "src long, dst long, w double")
    wires = {(r["block"], r["frm"]): L.unpack(bytes(r["blob"])) for r in L.wire(points, edges)[1].collect()}
    src, dst, _, owners, cuts = wires[0, 0]
    assert src.tolist() == [0, 0, 0, 0, 0, 0, 1] and dst.tolist() == [1, -1, -2, -3, -4, -5, -5] and dst.dtype == np.int32
    assert owners.tolist() == [1, 2] and cuts.tolist() == [0, 2, 5]
    assert wires[1, 0][0].tolist() == [0, 1] and wires[2, 0][0].tolist() == [0, 2, 3]


def test_negatives_take_room_for_some_points_only():
    b = crowded(4, 0, n=20_000, edges=1000)
    few = crowded(4, 0, n=20_000, edges=1000)
    few = L.Block(few.rows[:3000], few.spot[:3000], few.state[:3000], few.src[:0], few.dst[:0], few.weight[:0], few.ghosts[:0], few.springs[:3000])
    umap = L.Umap(20_000, steps=2, sample=np.random.default_rng(1).normal(size=(4000, 2)))
    assert np.array_equal(umap._push(b.rows, b.spot, 3)[:3000], umap._push(few.rows, few.spot, 3))
    assert peak(lambda: umap.move(b, 0)) < 40e6


def test_springs_are_sums_of_edges(monkeypatch):
    """Column by column and in parts, springs are what a loop over the edges adds up."""
    rng = np.random.default_rng(11)
    n, ghosts, edges = 6, 4, 40
    src, dst, weight = rng.integers(0, n, edges), rng.integers(0, n + ghosts, edges), rng.random(edges)
    places = rng.normal(size=(n + ghosts, 2))
    block = L.Block(np.arange(n), places[:n], np.zeros((n, 4)), src, dst, weight, places[n:], np.zeros((n, 3)))
    monkeypatch.setattr(L, "EDGES", 7)
    want = np.zeros((n + ghosts, 4))
    for s, d, w in zip(src, dst, weight):
        square = ((places[s] - places[d]) ** 2).sum()
        want[s] += [w * square, *(w * square * places[d]), w]
        want[d] += [w * square, *(w * square * places[s]), w]
    own, far = block.pulled(lambda part, square: (weight[part] * square, weight[part]), places, width=4)
    assert np.allclose(own, want[:n]) and np.allclose(far, want[n:])
    near, none = block.pulled(lambda part, square: (weight[part] * square, weight[part]), places, width=4, far=False)
    assert np.allclose(near, want[:n]) and not len(none)
