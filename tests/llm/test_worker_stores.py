"""What one operator keeps in a Python worker is not kept beside what the next one needs."""

import numpy as np

from textloom.llm import bpe, common, toxicity


def functions(df, monkeypatch, make):
    """Those that ``make`` gives to Spark as tasks."""
    held, given = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *more: held.append(f) or given(self, f, *more))
    make()
    return held


def test_an_operator_drops_what_others_left(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Some words. Some more.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    scorer = toxicity.Scorer(np.zeros((1 << toxicity.BITS) + 1))
    tasks = functions(df, monkeypatch, lambda: (toxicity.score(df, scorer), toxicity.training_rows(df, labels, "doc_id", "text", "toxic", 9)))
    assert len(tasks) == 2
    for task in tasks:
        common.worker_store("bpe")["encode"] = {"left": 1}
        list(task(iter([])))
        assert not common.worker_store("bpe")


def test_an_operator_keeps_its_own(spark, monkeypatch):
    df = spark.createDataFrame([("a", [1])], "text string, token_ids array<int>")
    ranks = b"YQ== 0\nYg== 1\n"
    for task in functions(df, monkeypatch, lambda: (bpe.encode(df.select("text"), "text", ranks, "."), bpe.decode(df, "token_ids", ranks))):
        common.worker_store("other")["x"] = 1
        common.worker_store("bpe")["mine"] = 1
        list(task(iter([])))
        assert common.worker_store("bpe")["mine"] == 1 and not common.worker_store("other")
    common.drop_stores()
