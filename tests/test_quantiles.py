import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.operators import explore as X

P = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("kind", ["spread", "ties", "skewed", "one", "two"])
def test_quantiles_are_exact(spark, kind, monkeypatch):
    monkeypatch.setattr(X, "LAST_ROWS", 5)  # so that bins are used
    random.seed(1)
    values = {"spread": [random.gauss(0, 5) for _ in range(5000)], "ties": [float(random.randint(0, 4)) for _ in range(3000)],
              "skewed": [random.paretovariate(0.3) for _ in range(4000)] + [0.0] * 3000, "one": [2.5], "two": [1.0, 2.0]}[kind]
    got = {r["probability"]: r["value"] for r in X.quantiles(frame(spark, [*values, None]), "x", P).collect()}
    want = pd.Series(values).quantile(P)
    for p in P:
        assert got[p] == pytest.approx(want[p], rel=1e-12, abs=1e-12)


def test_a_missed_bracket_is_taken_wider(spark, monkeypatch):
    values = [float(i * i) for i in range(2000)]
    calls = []
    inner = X._at_ranks

    def watched(values, brackets, ranks):
        calls.append(brackets)
        return inner(values, [(-5.0, -4.0)] if len(calls) == 1 else brackets, ranks)

    monkeypatch.setattr(X, "_at_ranks", watched)
    assert [r["value"] for r in X.quantiles(frame(spark, values), "x", [0.5]).collect()] == [pytest.approx(999.5**2 + 0.25)]
    assert len(calls) == 2


def test_nothing(spark):
    assert [tuple(r) for r in X.quantiles(frame(spark, [None, None]), "x", [0.5]).collect()] == [(0.5, None)]
    assert X.box_summary(frame(spark, []), "x").first()["median"] is None
    assert {r["stat"]: r["value"] for r in X.describe(frame(spark, []), "x").collect()}["count"] == 0


def test_two_scans(spark, tmp_path):
    """The table is read twice, whatever is described."""
    path = str(tmp_path / "t")
    spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("x")).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    out = X.describe(spark.read.parquet(path).mapInArrow(seen, "x double"), "x")
    assert {r["stat"] for r in out.collect()} == {"count", "mean", "std", "min", "25%", "50%", "75%", "max"}
    assert reads.value == 400_000
