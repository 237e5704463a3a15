import random
import re

import pytest
from textloom.llm import blocks, passages, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """Results per row; rows in the order of their ids."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def check(result, rows, sha):
    assert sorted(tuple(r) for r in result) == sorted((k, n, m, sha(kept)) for k, n, m, kept in brute(rows))


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "ab", "ba", "é", "c.", "…"]
    long = [rng.choice(words) for _ in range(300)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(words) for _ in range(rng.choice([0, 3, 40]))]
            k = rng.randrange(280)
            parts += long[k:k + rng.choice([8, 19, 20, 21, 33, 90])]
        out.append(rng.choice([" ", "\n", " \t"]).join(parts))
    return out


@pytest.mark.parametrize("size", [4_000_000, 400])
def test_brute_force(spark, table, folder, sha, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    texts = random_texts(size, 60)
    texts += texts[:5] + [None, "", " ", "x " * 100, "x " * 30, "y" * 3000, "a b c", "a\x1cb " * 25]
    df = table(texts, first=-3).repartition(3)
    check(queries.op7_repeated_passages(spark, folder(documents=df)).collect(), list(enumerate(texts, -3)), sha)


def test_empty(spark, table, folder):
    assert queries.op7_repeated_passages(spark, folder(documents=table([]))).count() == 0


def test_given_table(spark, data, sha):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    result = queries.op7_repeated_passages(spark, data).collect()
    assert sum(r.n_removed for r in result) > 0
    check(result, rows, sha)


def test_cover_has_every_difference():
    assert {(a - b) % passages.PERIOD for a in passages.COVER for b in passages.COVER} == set(range(passages.PERIOD))


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(4, text), (4, text), (None, text)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in passages.remove_repeats(df).collect()) == [(0, 0), (4, 25), (4, 25)]


def test_words_that_cheat_plain_hashes(spark):
    """A Thue-Morse word and its complement are alike to any sum of powers modulo 2**64."""
    bits = "a"
    while len(bits) < 4096:
        bits += bits.translate(str.maketrans("ab", "ba"))
    other = bits.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(1, " ".join([bits, *words])), (2, " ".join([other, *words[:19], "x"])), (3, " ".join([bits, *words[:19], "x"]))], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in passages.remove_repeats(df).collect()} == {1: 0, 2: 0, 3: 21}  # of the third its first window is that of 1, its second that of 2
    made = passages.Words([(1, bits.encode()), (2, other.encode())])
    assert len(set(made.hash.tolist())) == len(set(made.other.tolist())) == 2
