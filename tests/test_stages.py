"""Whole runs over slices, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.operators.embed import hash_embed, model_embed
from textloom.operators.explore import exact_sample, expand_json, quantiles, schema_profile, top_values
from textloom.plans.manifest import manifest_from_landing
from textloom.plans.settings import BASE, overrides_frame, resolve
from textloom.plans.stages import audit_slices, embed_slices, ingest, preprocessed, read_report, reduce_slices
from textloom.sources.sinks import chunk_plan, rechunk, stage_path, write_table


@pytest.fixture
def landing(tmp_path):
    rng = range(12)
    for config, records in {
        "content": [{"id": i, "content": f"text number {i} " * (i + 1)} for i in rng],
        "metadata": [{"id": i, "text": f"title {i}", "kind": "a"} for i in rng],
    }.items():
        folder = tmp_path / "landing" / "dataset=corpus" / f"config={config}" / "split=data"
        folder.mkdir(parents=True)
        (folder / "a.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records))
    return tmp_path


@pytest.mark.parametrize("fmt", ["parquet", "jsonl"])
def test_run_and_resume(spark, landing, fmt):
    root, base = str(landing / "landing"), str(landing / f"out-{fmt}")
    slices = resolve(
        manifest_from_landing(spark, root), {**BASE, "output_format": fmt, "chunk_size": 5},
        overrides_frame(spark, {}), overrides_frame(spark, {"metadata": {"skip_embedding": True}})).cache()

    def where(dataset, config, split):
        return f"{root}/dataset={dataset}/config={config}/split={split}"

    def status(report):
        return {r["config"]: r["status"] for r in report}

    def run(force=False):
        return (
            status(ingest(spark, slices, where, base, force=force)),
            status(embed_slices(spark, slices, base, "hash", lambda text, s: hash_embed(text, 4, max_tokens=s["max_seq_length"]), force)),
            status(reduce_slices(spark, slices, base, "hash", force)),
        )

    ran, after = {"content": "ran", "metadata": "skip"}, {"content": "skipped", "metadata": "skip"}
    assert run() == ({"content": "ran", "metadata": "ran"}, ran, ran)
    assert run() == ({"content": "skipped", "metadata": "skipped"}, after, after)
    assert run(force=True)[1] == ran
    rows = spark.read.format("json" if fmt == "jsonl" else "parquet").load(preprocessed(base, fmt))
    assert rows.count() == 24
    points = spark.read.parquet(stage_path(base, "embreduced", "hash"))
    assert points.count() == 12
    assert {"pca_2d_x", "pca_2d_y", "id", "config"} <= set(points.columns)
    assert audit_slices(spark, base, "hash").first()["bad"] == 0


def test_chunk_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(1000).coalesce(1), path, chunk_size=300)
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    assert sorted(r["count"] for r in sizes) == [100, 300, 300, 300]


def test_chunks_never_span_files(spark):
    df = spark.createDataFrame([(f, i) for f, n in (("a", 5), ("b", 2), ("c", 4)) for i in range(n)], "f string, at long")
    chunks = {(r["f"], r["at"]): r["chunk"] for r in chunk_plan(df, 2, F.col("f"), F.col("at")).collect()}
    assert [chunks["a", i] for i in range(5)] == [1, 1, 2, 2, 3]
    assert [chunks["b", i] for i in range(2)] == [4, 4] and [chunks["c", i] for i in range(4)] == [5, 5, 6, 6]


def test_quantiles_narrow_brackets(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.5)).alias("v"))
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    want = df.agg(F.percentile("v", ps)).first()[0]
    for window in (100_000, 50):
        got = {r["probability"]: r["value"] for r in quantiles(df, "v", ps, window).collect()}
        assert [got[p] for p in ps] == pytest.approx(want)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(3000)
    a, b = (sorted(r[0] for r in exact_sample(df.repartition(p), "id", 100).collect()) for p in (1, 7))
    assert a == b and len(a) == 100
    assert exact_sample(df, "id", 5000).count() == 3000


def test_top_values_ties(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None, None, None]], "v string")
    assert [tuple(r) for r in top_values(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_profile_of_an_empty_table(spark):
    rows = schema_profile(spark.createDataFrame([], "a long, b string")).collect()
    assert [(r["column"], r["non_null"], r["null_pct"]) for r in rows] == [("a", 0, None), ("b", 0, None)]


def test_json_keys_named_like_types(spark):
    df = spark.createDataFrame([('{"VOID": 1, "none": null, "in": {"OBJECT": [null]}}',)], "j string")
    row = expand_json(df, "j").first().asDict()
    assert row == {"VOID": 1, "in.OBJECT": [None], "none": None}


def test_model_embed(spark):
    def make():
        import numpy as np

        return lambda texts: np.array([[float(len(t))] for t in texts], dtype="float32")

    df = spark.createDataFrame([("ab",), ("c",)], "t string").select(model_embed(F.col("t"), make, 2).alias("e"))
    assert sorted(r["e"][0] for r in df.collect()) == [1.0, 2.0]


def test_names_with_signs_and_empty_slices(spark, tmp_path):
    name, base = "org/name=1% of + all", str(tmp_path / "out")
    files = tmp_path / "a.jsonl"
    slices = resolve(spark.createDataFrame([(name, "c d", "train")], "dataset string, config string, split string"), {**BASE, "text_column": "body"},
                     overrides_frame(spark, {}), overrides_frame(spark, {})).cache()

    def run(lines, force=False):
        files.write_text("\n".join(json.dumps(x) for x in lines))
        return ingest(spark, slices, lambda *_: str(files), base, force=force, schema="id long, body string")[0]

    def rows():
        return spark.read.parquet(preprocessed(base, "parquet")).count()

    first = run([{"id": 1, "body": "one"}, {"id": "seven", "body": "two"}])
    assert (first["status"], first["rows"], first["files"]) == ("ran", 2, 1) and rows() == 2
    assert run([])["status"] == "skipped" and rows() == 2
    again = run([{"id": 1, "body": " "}], force=True)
    assert (again["status"], again["rows"]) == ("ran", 0)
    assert spark.read.schema("id string, dataset string, config string, split string").parquet(preprocessed(base, "parquet")).count() == 0
    assert run([])["status"] == "skipped"  # an empty slice is finished too
    assert [r.status for r in read_report(spark, base).orderBy("at").collect()] == ["started", "ran", "skipped", "started", "ran", "skipped"]


def test_rechunk_keeps_source_files_apart(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.range(36).selectExpr("id", "id div 3 as f").repartitionByRange(12, "f").write.parquet(source)
    rechunk(spark, source, target, 2)
    files = spark.read.parquet(target).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.count_distinct("f").alias("sources")).collect()
    assert sorted(r.n for r in files) == [1] * 12 + [2] * 12 and all(r.sources == 1 for r in files)
