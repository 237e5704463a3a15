import base64
import re

import corpus_pipeline
import pytest
import tiktoken
from test_decontaminate import brute as hits
from test_private import FORMS, ok
from test_simhash import groups, reference

import public_tokenizers
from textloom.llm import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, data):
    """What each stage leaves of the given documents, by its name."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, data), name)
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(stages[name].columns == COLUMNS for name, _ in corpus_pipeline.STAGES[:-1])
    assert stages["tokens"].columns[0] == "doc_id"


def test_toxic_documents_go(spark, data, stages):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    docs = stages["documents"]
    scorer = toxicity.fit(docs, labels)
    want = {k for k, t in texts(docs).items() if scorer.score(t)[0] < corpus_pipeline.TOXIC}
    assert set(texts(stages["toxicity"])) == want
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()} & set(texts(docs))
    assert len(toxic - want) >= 0.8 * len(toxic)


def test_one_of_each_group_stays(stages):
    before = texts(stages["toxicity"])
    ids = sorted(before)
    want = {low for low in groups(ids, [reference(before[k]) for k in ids])}
    assert set(texts(stages["near_copies"])) == want


def test_contaminated_documents_go(spark, data, stages):
    before = texts(stages["near_copies"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    want = {k for k, (n, hit, _) in hits(list(before.items()), items).items() if not (hit and 20 * hit >= n)}
    assert set(texts(stages["decontamination"])) == want


def test_personal_data_is_masked(stages):
    before, after = texts(stages["decontamination"]), stages["personal_data"].collect()
    assert len(after) == len(before)
    for r in after:
        text = before[r.doc_id]
        for kind, form in FORMS.items():
            text = re.sub(form, lambda m, kind=kind: f"<{kind.upper()}>" if ok(kind, m.group()) else m.group(), text)
        assert r.text == text and r.n_chars == len(text)


def test_tokens(stages, sha):
    with open(public_tokenizers.path(corpus_pipeline.TOKENIZER), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = texts(stages["personal_data"])
    rows = stages["tokens"].collect()
    assert {r.doc_id: r.token_ids for r in rows} == {k: own.encode_ordinary(t) for k, t in before.items()}
    assert all(r.text_sha256 == r.decoded_sha256 == sha(before[r.doc_id]) for r in rows)


def test_odd_documents(spark, table, folder):
    df = table([None, "", "a b", "A  B", "x" * 3000, None], first=3).unionAll(table(["a b", "zz yy xx"], first=5))
    at = folder(documents=df, labels=spark.createDataFrame([(5, 1, 0), (77, 0, None)], "doc_id long, quality int, toxic int"),
                benchmark=spark.createDataFrame([(1, "zz yy xx")], "item_id long, text string"))
    rows = corpus_pipeline.run(spark, at).collect()
    assert sorted((r.doc_id, r.n_tokens > 0) for r in rows) == [(3, False), (5, True), (7, True)]
    none = folder(documents=table([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, none).count() == 0


CLASHING = ["n_words", "hit_items", "hit_spans", "clean_text", "_clean", "_row", "row", "mark", "_size", "toxicity", "offending", "fingerprint",
            "component_id", "component_point", "_body", "_found", "found", "base", "input_0", "p", "least", "hash"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_pass_through(spark, table, folder, name):
    docs = table(["a b c d", "a b c d", None, "", "write to a@b.example now", "zz yy xx"], first=3)
    docs = docs.unionAll(docs.limit(1)).selectExpr("doc_id", "text", *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASHING], "n_chars", "lang AS `odd``name`")
    at = folder(labels=spark.createDataFrame([(3, 1, 0), (4, 1, 0), (5, 1, 0), (77, 0, None)], "doc_id long, quality int, toxic int"),
                benchmark=spark.createDataFrame([(1, "zz yy xx")], "item_id long, text string"))
    left = dict(corpus_pipeline.STAGES)[name](spark, docs, at)
    assert left.columns == docs.columns
    rows = left.collect()
    assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING)
    assert all(r["odd`name"] == "en" for r in rows)
    want = {"toxicity": [3, 3, 4, 5, 6, 7, 8], "near_copies": [3, 5, 7, 8], "decontamination": [3, 3, 4, 5, 6, 7], "personal_data": [3, 3, 4, 5, 6, 7, 8]}
    assert sorted(r.doc_id for r in rows) == want[name]
