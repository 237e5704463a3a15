import math

import numpy as np
import pytest
from textloom.llm import queries, vectors


def brute(rows, cosine=0.95):
    """Links and components of ``(id, vector)`` rows, all pairs."""
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(e is not None and math.isfinite(e) for e in v) and any(v)
        unit.append(np.array(v, "f8") / np.linalg.norm(np.array(v, "f8")) if ok else None)
    low, count = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                count[i] += 1
                count[j] += 1
                low[root(i)] = root(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), key), key)
    return sorted((key, count[i], best[root(i)], best[root(i)] == key) for i, (key, _) in enumerate(rows))


def check(spark, folder, rows):
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, label int")
    rounded = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in queries.op9_embedding_dedup(spark, folder(embeddings=df)).collect())
    assert got == brute(rounded)


def clusters(seed, n, width):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        v = rng.normal(size=width)
        for _ in range(rng.choice([1, 2, 40])):
            out.append((v + rng.normal(size=width) * rng.choice([0, 0.05, 0.15, 0.22]) * np.linalg.norm(v) / width**0.5).tolist())
    return list(enumerate(out[:n]))


@pytest.mark.parametrize("width", [64, 13, 3, 1])
def test_brute_force(spark, folder, width):
    check(spark, folder, clusters(width, 400, width))


def test_crowded_cells(spark, folder, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 20)
    check(spark, folder, clusters(9, 200, 16))


def test_odd_vectors(spark, folder):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, math.nan]), (6, [math.inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (7, [1.0, 2.0]), (10, [3e38, 3e38]), (11, [1e-38, 1e-38])]
    check(spark, folder, rows)
    check(spark, folder, [])


def test_given_table(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op9_embedding_dedup(spark, data).collect()) == brute(rows)


def test_pairs_at_exactly_the_bound(spark, folder):
    """Whole numbers whose cosine is 0.95 to the last digit, or what doubles make of it: the plain formula on the given
    vectors decides."""
    # Two entries change places: the squared distance is twice the square of their difference, a tenth of a squared length.
    bases = [(2, 1, 3, 2, 1, 1), (3, 2, 2, 1, 1, 1), (1, 0, 4, 1, 1, 1), (1, 0, 3, 3, 1, 0), (3, 1, 6, 5, 3, 0), (3, 1, 8, 2, 1, 1)]
    assert all(sum(e * e for e in v) == 20 * (v[0] - v[1]) ** 2 for v in bases)
    pairs = [([c * e for e in v], [d * e for e in (v[1], v[0], *v[2:])]) for v, (c, d) in zip(bases * 3, [(k % 7 + 1, k % 5 + 2) for k in range(16)])]
    # Each pair lies in dimensions of its own, so it meets no other.
    rows, want = [], {}
    for k, pair in enumerate(pairs):
        for side, v in enumerate(pair):
            rows.append((2 * k + side, [0.0] * (6 * k) + [float(e) for e in v] + [0.0] * (6 * (len(pairs) - k - 1)), 1))
        x, y = (np.array(v, "f8") for v in pair)
        want[k] = int((x @ y) / np.sqrt((x @ x) * (y @ y)) >= 0.95)
    assert sum(want.values()) > 0
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    assert {k: (got[2 * k], got[2 * k + 1]) for k in want} == {k: (n, n) for k, n in want.items()}


def test_many_copies_are_one_vector(spark, folder):
    rng = np.random.default_rng(6)
    v = rng.normal(size=16)
    near = [(v + rng.normal(size=16) * 0.03).tolist() for _ in range(5)]
    far = rng.normal(size=(4, 16)).tolist()
    check(spark, folder, list(enumerate([v.tolist()] * 400 + near + near[:2] + far + [(-0.0 * np.array(far[0])).tolist(), [-x for x in far[0]]])))
    rows = spark.createDataFrame([(i, v.tolist()) for i in range(300)], "vec_id long, embedding array<float>")
    made = vectors.prepared(rows.withColumnRenamed("vec_id", "_id"), "embedding")
    assert made.select("vec").distinct().count() == 1


def test_rounds_hold_a_bounded_volume(spark, folder, monkeypatch):
    assert vectors.rounds({0: 10, 1: 20}) == [([0, 1], 0, 1)]
    monkeypatch.setattr(vectors, "ROUND_BYTES", 100)
    assert vectors.rounds({0: 60, 1: 30, 2: 250, 3: 20}) == [([2], 0, 3), ([2], 1, 3), ([2], 2, 3), ([0, 1], 0, 1), ([3], 0, 1)]
    monkeypatch.setattr(vectors, "ROUND_BYTES", 100_000)
    monkeypatch.setattr(vectors, "CELL_ROWS", 40)
    sent = []
    made = vectors._links
    monkeypatch.setattr(vectors, "_links", lambda *a: sent.append(a[-2:]) or made(*a))
    check(spark, folder, clusters(12, 150, 8))
    assert len(sent) > 2


def test_near_pairs_finds_all(monkeypatch):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(700, 5)).astype("f4")
    monkeypatch.setattr(vectors, "LEAF", 20)
    square = ((x[:, None].astype("f8") - x) ** 2).sum(axis=2)
    every, some = np.arange(700), rng.permutation(700)

    def found(left, right):
        pairs = [(int(a), int(b)) for p, q in vectors.near_pairs(x, left, right, 0.5) for a, b in zip(p, q)]
        assert len(pairs) == len(set(pairs))
        return set(pairs)

    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(square <= 0.4999))}
    loose = {(int(a), int(b)) for a, b in zip(*np.nonzero(square <= 0.5001))}
    same = found(every, every)
    assert {(a, b) for a, b in want if a < b} <= {(min(p), max(p)) for p in same} <= loose
    left, right = some[:300], some[300:]
    across = {(a, b) for a, b in want if a in set(left.tolist()) and b in set(right.tolist())}
    assert across <= found(left, right) <= loose and across
