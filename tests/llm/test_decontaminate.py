import random
import re

import pytest
from textloom.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    seen = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            seen.setdefault(tuple(w[i:i + window]), set()).add(name)
    out = {}
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in seen}:
            for i in range(len(w) - n + 1):
                if names := seen.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        out[key] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def check(spark, docs, items, folder, sha):
    item_df = spark.createDataFrame(items, "item_id long, text string")
    at = folder(documents=docs, benchmark=item_df)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    rows = queries.op8_decontamination(spark, at).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), sha(",".join(found)), hit > 0 and 20 * hit >= n), r.doc_id


@pytest.mark.parametrize("seed", range(4))
def test_brute_force(spark, table, folder, sha, seed):
    rng = random.Random(seed)
    some = [rng.choice(["a", "b", "é", "c1"]) for _ in range(400)]
    items = [(i, " ".join(some[(k := rng.randrange(380)):k + rng.choice([1, 2, 5, 12, 13, 14, 30])])) for i in range(12 if seed else 3)]
    items = [x for x in items if seed > 1 or len(x[1].split()) > 4] + [(50, None), (51, "!?"), (3, "B, a; c1 b")]
    texts = [" ".join(rng.choice(["a", "b", "É", "C1", "zz"]) for _ in range(rng.randrange(80))) for _ in range(20)]
    texts += ["- ".join(some[k:k + 60]) + " zz zz" for k in range(0, 300, 40)] + [None, "", " .. ", "x" * 5000]
    check(spark, table(texts), items, folder, sha)


def test_shards_agree(spark, table, folder, sha, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 30)
    some = [f"w{i % 37}" for i in range(300)]
    items = [(i, " ".join(some[i * 9:i * 9 + 20])) for i in range(12)]
    check(spark, table([" ".join(some), " ".join(some[5:60]), "w1 w2"]), items, folder, sha)


def test_empty_tables(spark, table, folder, sha):
    check(spark, table([]), [(1, "a b")], folder, sha)
    check(spark, table(["a b c"]), [], folder, sha)


def test_real_tables(spark, data, sha):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    want = brute(docs, items)
    rows = queries.op8_decontamination(spark, data).collect()
    assert any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.items_sha256) == (n, hit, sha(",".join(found)))


def test_cut_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "Start. The quick, brown fox! end", "x"), (2, None, "y")], "doc_id long, text string, hit_spans string")
    items = spark.createDataFrame([(7, "the quick brown fox")], "item_id long, text string")
    marked = decontaminate.mark(docs, items)
    rows = {r.doc_id: r.clean_text for r in decontaminate.cut(marked, least_words=3).collect()}
    assert rows == {1: "Start. ! end", 2: None}
    assert {r.doc_id: r.clean_text for r in decontaminate.cut(marked).collect()}[1].startswith("Start. The")


def test_pipeline_cuts_passages_of_long_documents(spark, table, folder):
    import corpus_pipeline

    item = " ".join(f"b{k}" for k in range(200))
    long = [" ".join(f"w{k}" for k in range(10_000)), " ".join(f"v{k}" for k in range(9_800))]
    docs = table([f"{long[0]} {item}. {long[1]}", f"{item} {' '.join(f'w{k}' for k in range(300))}", "untouched,  text", None])
    at = folder(benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    rows = {r.doc_id: r for r in corpus_pipeline.drop_contaminated(spark, docs, at).collect()}
    assert {k: r.text for k, r in rows.items()} == {0: f"{long[0]} . {long[1]}", 2: "untouched,  text", 3: None}
    assert rows[0].n_chars == len(rows[0].text) and rows[2].n_chars == len("untouched,  text")
