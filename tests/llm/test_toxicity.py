import zlib

from textloom.llm import queries, toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_query(spark, data):
    rows = {r.doc_id: r for r in queries.op10_toxicity(spark, data).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in rows.items())
    known = [k for k in rows if k in labels]
    assert sum(rows[k].predicted == labels[k] for k in known) >= 0.9 * len(known)


def test_finds_the_sentence(spark, table):
    clean = [f"The sun is up {i}. A word of peace {i % 7}. Go home now." for i in range(60)]
    bad = [f"The sun is up {i}. You are grummelig and so on. Go home now." for i in range(20)]
    docs = table(clean + bad)
    labels = spark.createDataFrame([(i, 1, int(i >= 60)) for i in range(80)] + [(99, 1, 1), (3, 1, None)], LABELS)
    scorer = toxicity.fit(docs, labels)
    text = "All is well. Some GRUMMELIG one! Bye."
    rows = {r.doc_id: r for r in toxicity.score(table([text, clean[3], None, "", "é" * 20_000]), scorer).collect()}
    assert rows[0].toxicity > 0.5 and [text[s.start:s.end] for s in rows[0].offending] == [" Some GRUMMELIG one"]
    assert rows[1].toxicity < 0.5 and not rows[1].offending
    assert rows[2].toxicity == rows[3].toxicity == 0


def test_no_labels_and_no_rows(spark, table):
    scorer = toxicity.fit(table(["a b"]), spark.createDataFrame([], LABELS))
    assert toxicity.score(table(["a b"]), scorer).first().toxicity < 1
    assert toxicity.score(table([]), scorer).count() == 0
