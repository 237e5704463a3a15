import zlib

from textloom.llm import language, queries


def test_held_out_accuracy(spark, data):
    rows = {r.doc_id: r for r in queries.op3_language(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    out = [d for d in docs if rows[d.doc_id].held_out]
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_mixtures_and_odd_texts(spark, table):
    english, german = "the thing with the other hand and that " * 20, "der die das und nicht einer schön über " * 20
    docs = table([english, german, None], langs=["en", "de", "fr"])
    mixture = language.model(language.learn(docs))
    texts = [english + german, german * 3 + english, None, "", " 12 +", "é", "the", "x" * 100_000]
    rows = {r.doc_id: r for r in language.identify(table(texts), mixture).collect()}
    assert set(rows[0].languages) == {"en", "de"} and abs(rows[0].languages["en"] - 0.5) < 0.1
    assert rows[1].lang_pred == "de" and 0.65 < rows[1].score < 0.85
    assert [rows[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and rows[2].score == 0
    assert rows[6].lang_pred == "en" and list(rows[6].languages) == ["en"]
    assert rows[5].lang_pred in ("en", "de") and rows[7].lang_pred in ("en", "de")


def test_nothing_learned(spark, table):
    mixture = language.model(language.learn(table([None, "abc"], langs=[None, None])))
    assert [tuple(r)[-3:-1] for r in language.identify(table(["abc"]), mixture).collect()] == [("und", 0.0)]
    assert language.identify(table([]), mixture).count() == 0


def test_numbers_are_no_letters(spark, table):
    mixture = language.model(language.learn(table(["the thing", "der die"], langs=["en", "de"])))
    rows = language.identify(table(["² ½ Ⅷ ٣", "² a", "_", "ª"]), mixture).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in rows] == [True, False, True, False]


def test_mixture_against_plain_em():
    """Shares of languages by expectation and maximisation in plain Python, one step after the other."""
    import numpy as np

    rng = np.random.default_rng(2)
    m = language.Mixture({"a": rng.integers(0, 50, 1 << language.BITS), "b": rng.integers(0, 50, 1 << language.BITS), "c": rng.integers(0, 50, 1 << language.BITS)})
    p, n = m.p[rng.integers(0, 1 << language.BITS, 60)].astype("f8"), rng.integers(1, 5, 60).astype("f8")
    want = [1 / 3] * 3
    for _ in range(2000):
        share = [0.0] * 3
        for row, times in zip(p.tolist(), n.tolist()):
            total = sum(w * x for w, x in zip(want, row))
            for k in range(3):
                share[k] += times * want[k] * row[k] / total
        want = [s / n.sum() for s in share]
    got, likely = m.shares(p, n)
    reach = sum(t * np.log(sum(w * x for w, x in zip(want, row))) for row, t in zip(p.tolist(), n.tolist()))
    assert likely <= reach + 1e-9 and reach - likely < 0.05
