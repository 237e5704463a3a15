import random

import numpy as np
import pytest
from textloom.llm import blocks, queries, suffixes


def brute(rows, length=50):
    """Results per row; the smallest id of each string first."""
    least, out = {}, []
    coded = [(k, (t or "").encode()) for k, t in rows]
    for key, text in coded:
        for i in range(len(text) - length + 1):
            s = text[i:i + length]
            least[s] = min(key, least.get(s, key))
    for key, text in coded:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if least[text[i:i + length]] < key:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((key, len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g)))
    return out


def check(result, rows, sha):
    assert sorted(tuple(r) for r in result) == sorted((*r[:4], sha(r[4])) for r in brute(rows))


def random_texts(seed, n):
    rng = random.Random(seed)
    letters = "ab é\0"
    long = "".join(rng.choice(letters) for _ in range(900))
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append("".join(rng.choice(letters) for _ in range(rng.choice([0, 5, 60]))))
            k = rng.randrange(850)
            parts.append(long[k:k + rng.choice([15, 16, 40, 45, 50, 51, 90, 300])])
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("size", [4_000_000, 700])
def test_brute_force(spark, table, folder, sha, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    texts = random_texts(size, 70)
    texts += texts[:5] + [None, "", "a", "x" * 49, "x" * 50, "x" * 300, "ab" * 80, "ab" * 100, "\0" * 120, "\0" * 70, "y" * 5000]
    df = table(texts, first=-3).repartition(3)
    check(queries.op5_repeated_bytes(spark, folder(documents=df)).collect(), list(enumerate(texts, -3)), sha)


def test_empty(spark, table, folder):
    assert queries.op5_repeated_bytes(spark, folder(documents=table([]))).count() == 0
    assert queries.op5_repeated_bytes(spark, folder(documents=table([None, "short"]))).count() == 2


def test_given_table(spark, data, sha):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    result = queries.op5_repeated_bytes(spark, data).collect()
    assert sum(r.n_removed for r in result) > 0
    check(result, rows, sha)


def test_same_and_null_ids(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(70))
    df = spark.createDataFrame([(4, text), (4, text), (None, text)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffixes.remove_repeats(df).collect()) == [(0, 0), (4, 70), (4, 70)]


def test_loser_tree():
    rng = random.Random(5)
    for count in (1, 2, 5, 9):
        runs = []
        for _ in range(count):
            items = sorted({bytes(rng.choice(b"ab") for _ in range(suffixes.WIDE)) if rng.random() < 0.5 else b"a" * rng.randrange(suffixes.WIDE) + b"b" * suffixes.WIDE for _ in range(rng.randrange(30))})
            items = sorted({x[:suffixes.WIDE] for x in items})
            matrix = np.frombuffer(b"".join(items), "u1").reshape(-1, suffixes.WIDE)
            shared, rest = suffixes.front_code(matrix)
            assert suffixes.decode(shared, rest) == items
            runs.append((items, shared.tolist()))
        order, shares = suffixes.merge(runs)
        heads = [iter(items) for items, _ in runs]
        out = [next(heads[r]) for r in order]
        assert out == sorted(x for items, _ in runs for x in items)
        for a, b, s in zip(out, out[1:], shares[1:]):
            assert a[:s] == b[:s] and (s == suffixes.WIDE or a[s] != b[s])


def test_ranges_are_even():
    """Anchors have the least hashes of many, yet no range of them holds much more than another."""
    rng = np.random.default_rng(3)
    keys = np.unique(suffixes.Bytes([(1, rng.integers(97, 123, 1_000_000, "u1").tobytes())]).key)
    part, order = suffixes.dealt(keys, 50)
    assert np.bincount(part, minlength=50).max() < 1.5 * len(keys) / 50
    assert all((keys[order][part[order] == k][1:] > keys[order][part[order] == k][:-1]).all() for k in range(50))


def test_a_range_is_merged_in_portions(monkeypatch):
    """One merge holds a bounded number of suffixes, whatever the range holds, and finds what a merge of all finds."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 100, (4000, suffixes.WIDE), "u1")
    base[:, -2:] = suffixes.LENGTH - 5, 20
    rows = []
    for block in range(6):
        some = np.unique(np.ascontiguousarray(base[rng.integers(0, 4000, 3000)]).view(f"S{suffixes.WIDE}")).view("u1").reshape(-1, suffixes.WIDE)
        rows.append((block, blocks.press(*suffixes.front_code(some), rng.integers(0, 99, len(some)))))
    sizes, marked = [], suffixes.marked
    monkeypatch.setattr(suffixes, "marked", lambda runs, docs: sizes.append(len(docs)) or marked(runs, docs))

    def found():
        return {block: sorted(zip(*map(np.ndarray.tolist, blocks.spread(data)))) for block, data in suffixes.merge_runs(rows)}

    whole = found()
    assert len(sizes) == 1 and len(whole) == 6
    monkeypatch.setattr(suffixes, "MERGED", 1024)
    assert found() == whole and max(sizes[1:]) < 2048 and sum(sizes[1:]) == sizes[0]


def test_places_are_searched_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, rng.integers(97, 100, n, "u1").tobytes()) for k, n in enumerate([0, 49, 50, 51, 3000, 10, 700])]
    whole = suffixes.Bytes(rows)
    assert set(whole.doc.tolist()) == {2, 3, 4, 6}
    for places in (1, 37, 100, 1000):
        monkeypatch.setattr(suffixes, "PLACES", places)
        sliced = suffixes.Bytes(rows)
        for name in ("anchor", "far", "near", "doc", "key", "head"):
            assert (getattr(sliced, name) == getattr(whole, name)).all()
