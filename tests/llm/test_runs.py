import random
import re
import zlib

import pytest

from textloom.llm import runs as R
from textloom.llm.queries import op12_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, exponent=3):
    """All maximal repetitions by every period in turn; of those of one place the smallest period counts."""
    found = {}
    for p in range(1, len(words) // exponent + 1):
        k = 0
        while k + p < len(words):
            if words[k] != words[k + p]:
                k += 1
                continue
            start = k
            while k + p < len(words) and words[k] == words[k + p]:
                k += 1
            if k + p - start >= max(least, exponent * p):
                found.setdefault((start, k + p), p)
    whole = [(s, e - s, p) for (s, e), p in found.items()]
    # A multiple of a run's period gives the same place, or none; a longer place of a smaller period covers it.
    return sorted(r for r in whole if not any(o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in whole))


def left(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_those_of_brute_force(seed):
    random.seed(seed)
    words = []
    while len(words) < random.randint(10, 400):
        kind = random.random()
        unit = [random.choice("abc"[:random.randint(1, 3)]) for _ in range(random.randint(1, 12))]
        if kind < 0.6:
            words += (unit * random.randint(2, 9))[:random.randint(1, 80)]
        elif kind < 0.8:
            words += [str(random.random()) for _ in range(random.randint(1, 20))]
        else:
            words += words[-random.randint(1, 40):]
    for least, exponent in ((24, 3), (10, 2), (7, 3), (4, 2), (25, 4)):
        want = brute(words, least, exponent)
        assert R.runs_of(words, least, exponent) == want
        assert R.collapsed(words, want) == left(words, want)


def test_runs_need_no_stretches():
    """The automaton over whole texts finds the same as over the stretches it is fed."""
    random.seed(4)
    for _ in range(40):
        words = [random.choice("ab") for _ in range(random.randint(30, 300))] + ["a", "b", "b"] * random.randint(0, 30)
        whole = sorted((s, e - s, p) for (s, p), e in R.repeats(words, 24, 3).items())
        assert whole == R.runs_of(words) == brute(words)


def test_long_runs_in_little_time():
    import time

    start = time.perf_counter()
    assert R.runs_of([b"a"] * 100_000) == [(0, 100_000, 1)]
    unit = [str(k) for k in range(3000)]
    assert R.runs_of(unit * 20) == [(0, 60_000, 3000)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 30_000:
        fib.append(fib[-1] + fib[-2])
    assert len(R.runs_of(list(fib[-1]))) > 1000
    assert time.perf_counter() - start < 60


def altered(doc, words):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_against_brute_force(spark, data, sha):
    from fractions import Fraction

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = op12_runs(spark, data).collect()
    assert len(rows) == len(texts)
    many = 0
    for r in rows:
        words = altered(r.doc_id, WORD.findall(texts[r.doc_id] or ""))
        want = brute(words) if len(words) < 600 else R.runs_of(words)
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in want)) and r.collapsed_sha256 == sha(" ".join(left(words, want)))
        many += len(want)
    assert many > 10


def test_odd_texts(spark, table):
    texts = [None, "", " \t\n", "a " * 23, "a " * 24, "\x1ca\x85 b c " * 30, "é ü " * 5000, "x" * 100_000, "a b c d e f g h " * 3, "a b c d e f g h " * 3]
    rows = R.find_runs(table(texts)).orderBy("doc_id").collect()
    assert [(r.n_words, [tuple(x) for x in r.runs]) for r in rows] == [
        (0, []), (0, []), (0, []), (23, []), (24, [(0, 24, 1)]), (60, [(0, 60, 2)]), (10_000, [(0, 10_000, 2)]), (1, []), (24, [(0, 24, 8)]), (24, [(0, 24, 8)])]
    assert rows[4].collapsed == "a" and rows[5].collapsed == "\x1ca\x85 b c" and rows[0].collapsed == "" and rows[8].collapsed == "a b c d e f g h"
    assert R.find_runs(table([])).count() == 0


def test_clashing_columns(spark, table):
    df = table(["a " * 30, "b"]).selectExpr("doc_id", "text", "'x' AS RUNS", "5 AS n_words", "doc_id AS `collapsed`", "'k' AS run")
    out = R.find_runs(df)
    assert out.columns == ["doc_id", "text", "run", "n_words", "runs", "collapsed"]
    assert [(r.n_words, r.collapsed, r.run) for r in out.orderBy("doc_id").collect()] == [(30, "a", "k"), (1, "b", "k")]


def test_greatest_by_exact_quotient(spark, table):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([(5, 48, 16), (2, 30, 10), (2, 24, 8)],), ([(0, 31, 10), (50, 24, 7)],), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    got = [r.g for r in df.select(R.greatest().alias("g")).collect()]
    assert [g and tuple(g) for g in got] == [(2, 24, 8), (50, 24, 7), None]
    assert [r.w for r in df.select(R.written().alias("w")).collect()] == ["5,48,16\n2,30,10\n2,24,8\n", "0,31,10\n50,24,7\n", ""]
