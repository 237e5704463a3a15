import random
import re

import xxhash
from textloom.llm import queries, simhash
from textloom.llm.components import components


def reference(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, marks, radius=3):
    """Component of each position by comparing all pairs."""
    low = list(range(len(ids)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                low[root(i)] = root(j)
    best = {}
    for i, key in enumerate(ids):
        best[root(i)] = min(best.get(root(i), key), key)
    return [best[root(i)] for i in range(len(ids))]


def check(rows, texts):
    ids = [k for k, _ in texts]
    marks = [reference(t) for _, t in texts]
    want = sorted(zip(ids, [f"{m:016x}" for m in marks], groups(ids, marks)))
    assert sorted(tuple(r) for r in rows) == want


def test_documents(spark, data):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    check(queries.op4_simhash(spark, data).collect(), texts)


def test_odd_texts(spark, table, folder):
    long = " ".join(f"w{i % 700}" for i in range(70_000))
    texts = [None, "", " \n", "A", "a", "a b", "A  B", "a b c", "x y z Q", "a b c", long, long + " end", "É é"]
    check(queries.op4_simhash(spark, folder(documents=table(texts))).collect(), list(enumerate(texts)))
    assert queries.op4_simhash(spark, folder(documents=table([]))).count() == 0


def test_repeated_ids_and_other_columns(spark):
    df = spark.createDataFrame([(5, 1, "x"), (5, 1, "y"), (7, 3, "z"), (None, 3, "w")], "doc_id long, fingerprint long, component_id string")
    rows = simhash.with_components(df).collect()
    assert [r.component_id for r in rows] == [5] * 4


def near_points(rng, n):
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
            if rng.random() < 0.5:
                base = x
    return [x - (1 << 64) if x >> 63 else x for x in out]


def test_links_connect_what_all_pairs_connect(spark, monkeypatch):
    for seed, run in ((1, 32), (2, 2)):
        monkeypatch.setattr(simhash, "RUN", run)
        points = near_points(random.Random(seed), 700)
        found = simhash.links(spark.createDataFrame([(p,) for p in points], "p long"))
        assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in found.collect())
        got = {r.node: r.component for r in components(found).collect()}
        assert [got.get(p, p) for p in points] == groups(points, [p & (1 << 64) - 1 for p in points])


def test_tree_prunes_and_connects():
    import numpy as np

    rng = random.Random(3)
    base = rng.getrandbits(62)
    points = sorted({base ^ sum(1 << rng.randrange(62) for _ in range(rng.randrange(9))) for _ in range(1500)})
    low = {p: p for p in points}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in simhash.tree_links(np.array(points, "i8"), 3):
        low[max(root(points[a]), root(points[b]))] = min(root(points[a]), root(points[b]))
    assert [root(p) for p in points] == groups(points, points)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(3, 3), (50, 41), (41, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 7 for k in range(7, 40)}, 50: 41, 41: 41}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
