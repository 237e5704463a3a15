"""Sources, sinks, slices and settings over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.catalog.base import query, table
from textloom.catalog.texts import SPACE_SQL
from textloom.operators.normalize import normalize
from textloom.plans.manifest import build_manifest, pending_rows, pending_slices, run_report, slices_in_paths, stage_status
from textloom.plans.settings import BASE, embeddable, overrides_frame, resolve, rows_of
from textloom.plans.stages import ingest, read_report
from textloom.session import scratch_path
from textloom.sources.landed import (
    concat_tables, file_sizes, line_counts, parsed_lines, read_in_file_order, read_jsonl, read_records, read_stage, stage_sizes,
)
from textloom.sources.sinks import chunk_plan, rechunk, write_table
from textloom.streaming.incremental import incremental_ingest

# -- JSON Lines ---------------------------------------------------------------------

# Lines made from the documents: the record as JSON, its text cut off as malformed JSON,
# a bare number, and a blank.
MESSY_SQL = "SELECT doc_id, lang FROM documents"


def messy_lines(spark, folder):
    docs = table(spark, folder, "documents")
    record = F.to_json(F.struct("doc_id", "text", "lang"))
    broken = F.concat(F.lit('{"text": '), F.col("text"))
    return docs.select(F.explode(F.array(record, broken, F.col("doc_id").cast("string"), F.lit("   "), F.lit(""))).alias("value"))


@query("jsonl_scan", "SELECT doc_id, lang, text FROM documents")
def jsonl_scan(spark, folder):
    path = scratch_path(spark, "lines")
    messy_lines(spark, folder).write.text(path)
    return read_jsonl(spark, path).select("doc_id", "lang", "text")


@query("jsonl_parsed", "SELECT doc_id, lang, length(text) AS n FROM documents")
def jsonl_parsed(spark, folder):
    parsed = parsed_lines(messy_lines(spark, folder)).where(F.col("record").isNotNull())

    def member(name, kind):
        return F.try_variant_get("record", f"$.{name}", kind)

    return parsed.select(member("doc_id", "bigint").alias("doc_id"), member("lang", "string").alias("lang"),
                         F.length(member("text", "string")).alias("n"))


@query("jsonl_rejects", "SELECT 5 * count(*) AS lines, 2 * count(*) AS blank, 2 * count(*) AS malformed, count(*) AS kept FROM documents")
def jsonl_rejects(spark, folder):
    return line_counts(messy_lines(spark, folder))


@query("jsonl_roundtrip", f"""
SELECT trim(text, {SPACE_SQL}) AS text, doc_id || '' AS id, 'documents' AS source,
       '{{"lang": ' || to_json(lang) || ', "note": null, "n_chars": ' || n_chars || '}}' AS metadata_json FROM documents""")
def jsonl_roundtrip(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "text", "lang", F.lit(None).cast("string").alias("note"), "n_chars")
    path = scratch_path(spark, "canonical")
    write_table(normalize(docs, "documents"), path, "jsonl")
    return read_stage(spark, path, "jsonl", ["text", "id", "source", "metadata_json"])


@query("raw_sink", "SELECT * FROM events")
def raw_sink(spark, folder):
    path = scratch_path(spark, "raw")
    events = table(spark, folder, "events")
    write_table(events, path, "jsonl")
    return read_records(spark, path, "jsonl", schema=events.schema, file_column=None)


@query("jsonl_mismatch", """
SELECT CASE WHEN doc_id % 3 > 0 THEN doc_id END AS doc_id, lang, length(text) AS n, doc_id % 3 = 0 AS misfit FROM documents""")
def jsonl_mismatch(spark, folder):
    """A value that does not fit its declared type costs that value, not the line."""
    path = scratch_path(spark, "lines")
    docs = table(spark, folder, "documents")
    odd = F.col("doc_id") % 3 == 0
    record = F.when(odd, F.to_json(F.struct(F.concat(F.lit("no. "), "doc_id").alias("doc_id"), "lang", "text"))).otherwise(
        F.to_json(F.struct("doc_id", "lang", "text")))
    docs.select(F.explode(F.array(record, F.lit("{bad"), F.lit("17"), F.lit(" "))).alias("value")).write.text(path)
    schema = T.StructType.fromDDL("doc_id long, lang string, text string")
    rows = read_jsonl(spark, path, schema, mismatch="line")
    return rows.select("doc_id", "lang", F.length("text").alias("n"), F.col("line").isNotNull().alias("misfit"))


@query("file_name_column", "SELECT 'documents.parquet' AS file_name, count(*) AS n FROM documents")
def file_name_column(spark, folder):
    records = read_records(spark, f"{folder}/documents.parquet", "parquet")
    return normalize(records, "documents").groupBy("file_name").agg(F.count("*").alias("n"))


@query("parquet_projection", "SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1")
def parquet_projection(spark, folder):
    docs = read_stage(spark, f"{folder}/documents.parquet", columns=["lang", "text"])
    return docs.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("concat_files", """
SELECT doc_id AS id, text, lang FROM documents UNION ALL SELECT item_id, text, NULL FROM benchmark""")
def concat_files(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    return concat_tables([docs, items])


# -- sinks --------------------------------------------------------------------------


@query("chunk_assignment", "SELECT doc_id, doc_id // 300 + 1 AS chunk FROM documents")
def chunk_assignment(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return chunk_plan(docs, 300, F.col("file"), F.col("at")).select("doc_id", "chunk")


@query("rechunk_sizes", "SELECT true AS within_cap, count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents")
def rechunk_sizes(spark, folder):
    path = scratch_path(spark, "chunks")
    rechunk(spark, f"{folder}/documents.parquet", path, 300)
    copied = spark.read.parquet(path).select("doc_id", F.col("_metadata.file_path").alias("file"))
    sizes = copied.groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))
    return sizes.agg(F.every(F.col("n") <= 300).alias("within_cap"), F.sum("n").alias("n"), F.sum("ids").alias("ids"))


@query("atomic_write", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def atomic_write(spark, folder):
    docs, path = table(spark, folder, "documents"), scratch_path(spark, "kept")
    write_table(docs, path)
    write_table(docs.withColumn("lang", F.lit("none")), path, mode="ignore")
    return spark.read.parquet(path).groupBy("lang").agg(F.count("*").alias("n"))


@query("slice_overwrite", """
SELECT lang, count(*) AS n, CAST(sum(CASE WHEN lang = 'en' THEN 2 ELSE 1 END) AS BIGINT) AS runs FROM documents GROUP BY 1""")
def slice_overwrite(spark, folder):
    docs, path = table(spark, folder, "documents"), scratch_path(spark, "slices")
    write_table(docs.select("doc_id", "lang", F.lit(1).alias("run")), path, partition_by=["lang"])
    write_table(docs.where("lang = 'en'").select("doc_id", "lang", F.lit(2).alias("run")), path, partition_by=["lang"])
    return spark.read.parquet(path).groupBy("lang").agg(F.count("*").alias("n"), F.sum("run").alias("runs"))


@query("dir_sizes")
def dir_sizes(spark, folder):
    files = file_sizes(spark, folder)
    return stage_sizes(files, F.regexp_extract("path", r"([^/]+)\.parquet$", 1))


@query("resume_pending", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def resume_pending(spark, folder):
    docs, done = table(spark, folder, "documents"), table(spark, folder, "labels")
    return pending_rows(docs.select("doc_id"), done, ["doc_id"])


@query("resume_slices", """
SELECT DISTINCT source AS dataset, lang AS config, 'train' AS split FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents f JOIN labels l USING (doc_id)
                  WHERE l.quality = 0 AND f.source = d.source AND f.lang = d.lang)""")
def resume_slices(spark, folder):
    slices = document_slices(spark, folder)
    poor = table(spark, folder, "labels").where("quality = 0")
    done = document_rows(spark, folder).join(poor, "doc_id", "left_semi")
    return pending_slices(slices, done)


@query("incremental_ingest", """
SELECT 1 AS run, count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents UNION ALL
SELECT 2, count(*), count(DISTINCT doc_id) FROM documents UNION ALL
SELECT 3, (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark),
          (SELECT count(*) FROM (SELECT doc_id FROM documents UNION SELECT item_id FROM benchmark))""")
def incremental(spark, folder):
    landing, sink, state = (scratch_path(spark, n) for n in ("landing", "sink", "state"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    out = None
    for run, arrived in ((1, docs), (2, None), (3, items)):
        if arrived is not None:
            arrived.write.mode("append").json(landing)
        incremental_ingest(spark, landing, docs.schema, "stream", sink, state).awaitTermination()
        # The sink grows between the runs, so each count is taken at once: one row.
        counted = spark.read.parquet(sink).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).first()
        line = spark.range(1).select(F.lit(run).alias("run"), F.lit(counted["n"]).alias("n"), F.lit(counted["ids"]).alias("ids"))
        out = line if out is None else out.unionByName(line)
    return out


# -- slices and settings ------------------------------------------------------------


def document_rows(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("dataset"), F.col("lang").alias("config"), F.lit("train").alias("split"))


def document_slices(spark, folder):
    return document_rows(spark, folder).select("dataset", "config", "split").distinct()


@query("slice_manifest", """
WITH found AS (SELECT DISTINCT source AS dataset, lang AS config FROM documents),
kept AS (
  SELECT dataset, config FROM found WHERE dataset NOT IN ('src1', 'src2')
  UNION SELECT * FROM (VALUES ('src1', 'en'), ('src1', 'xx'), ('src2', 'de'), ('src99', 'default'))
)
SELECT dataset, config, CASE WHEN config = 'de' AND dataset = 'src3' THEN 'data' WHEN config = 'xx' THEN 'extra'
       WHEN (dataset, config) IN (SELECT dataset, config FROM found) THEN 'train' ELSE 'train' END AS split FROM kept""")
def slice_manifest(spark, folder):
    found = document_slices(spark, folder)
    forced = spark.createDataFrame(
        [("src1", "en"), ("src1", "xx"), ("src2", "de"), ("src99", "default")], "dataset string, config string")
    over = spark.createDataFrame([("src3", "de", "data"), ("src1", "xx", "extra")], "dataset string, config string, split string")
    return build_manifest(found, forced, over)


@query("landed_slices", "SELECT source AS dataset, lang AS config, CAST(NULL AS VARCHAR) AS split, count(*) > 0 AS filled "
       "FROM documents GROUP BY 1, 2")
def landed_slices(spark, folder):
    path = scratch_path(spark, "landed")
    rows = document_rows(spark, folder).drop("split")
    write_table(rows, path, partition_by=["dataset", "config"])
    return slices_in_paths(file_sizes(spark, path), F.col("path")).withColumn("filled", F.lit(True))


@query("resume_named_slices", """
SELECT 'org/' || lang || '=50%' AS dataset, 'a b+c' AS config, 's%2F' AS split, status, CASE WHEN status = 'ran' THEN n ELSE 0 END AS rows
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1), (VALUES ('ran'), ('skipped')) s(status)""")
def resume_named_slices(spark, folder):
    """Slices with signs in their names, run twice: the second run has nothing to do."""
    landed, base = scratch_path(spark, "landed"), scratch_path(spark, "run")
    docs = table(spark, folder, "documents")
    write_table(docs.select(F.col("doc_id").alias("id"), "text", "source", "lang"), landed, partition_by=["lang"])
    names = docs.select(F.concat(F.lit("org/"), "lang", F.lit("=50%")).alias("dataset"), F.lit("a b+c").alias("config"), F.lit("s%2F").alias("split")).distinct()
    slices = resolve(names, BASE, overrides_frame(spark, {}), overrides_frame(spark, {}))
    for _ in range(2):
        ingest(spark, slices, lambda d, c, s: f"{landed}/lang={d[4:-4]}", base, "parquet")
    return read_report(spark, base).where("status <> 'started'").select("dataset", "config", "split", "status", "rows")


@query("stage_status", """
SELECT dataset, CASE WHEN dataset = 'src1' OR dataset = 'src2' THEN 'partial' WHEN dataset = 'src3' THEN 'missing' ELSE 'complete' END AS status,
       CASE WHEN dataset IN ('src1', 'src3') THEN 0 ELSE n END AS files
FROM (SELECT source AS dataset, count(*) AS n FROM documents GROUP BY 1)""")
def stage_statuses(spark, folder):
    dataset = F.col("source")
    name = (
        F.when(dataset == "src1", F.concat(F.lit("_tmp_part_"), "doc_id", F.lit(".parquet")))
        .when(dataset == "src2", F.concat(F.lit("batch"), "doc_id", F.lit(".jsonl")))
        .when(dataset == "src3", F.lit("_SUCCESS"))
        .otherwise(F.concat(F.lit("part-"), "doc_id", F.lit(".parquet")))
    )
    files = table(spark, folder, "documents").select(dataset.alias("dataset"), F.concat(F.lit("/x/"), name).alias("path"))
    return stage_status(files, F.col("path"), ["dataset"])


def resolved(spark, folder):
    by_dataset = overrides_frame(spark, {
        "src1": {"text_strategy": "rl_blend"}, "src2": {"text_strategy": "agentic", "chunk_size": 7, "unknown": 1}})
    by_config = overrides_frame(spark, {"en": {"chunk_size": 99}, "de": {"skip_embedding": True, "text_strategy": "smart"}})
    base = {"text_strategy": "auto", "skip_embedding": False, "chunk_size": 50_000, "batch_size": 1}
    return resolve(document_slices(spark, folder), base, by_dataset, by_config)


SETTINGS_SQL = """
settings AS (
  SELECT source AS dataset, lang AS config, 'train' AS split,
    CASE WHEN lang = 'de' THEN 'smart' WHEN source = 'src1' THEN 'rl_blend' WHEN source = 'src2' THEN 'agentic' ELSE 'auto' END AS text_strategy,
    lang = 'de' AS skip_embedding,
    CASE WHEN lang = 'en' THEN 99 WHEN source = 'src2' THEN 7 ELSE 50000 END AS chunk_size, 1 AS batch_size
  FROM (SELECT DISTINCT source, lang FROM documents))
"""


@query("settings_resolved", f"WITH {SETTINGS_SQL} SELECT * FROM settings")
def settings_resolved(spark, folder):
    return resolved(spark, folder)


@query("skip_filter", "SELECT doc_id FROM documents WHERE lang <> 'de'")
def skip_filter(spark, folder):
    return rows_of(document_rows(spark, folder), embeddable(resolved(spark, folder)), ["dataset", "config", "split"]).select("doc_id")


@query("run_report", """
SELECT source AS dataset, lang AS config, 'train' AS split, CASE WHEN sum(l) = 0 THEN 'no_input' ELSE 'ran' END AS status,
       CAST(sum(l) AS BIGINT) AS rows, count(DISTINCT quality) AS files
FROM (SELECT source, lang, quality, CASE WHEN quality IS NULL THEN 0 ELSE 1 END AS l FROM documents LEFT JOIN labels USING (doc_id))
GROUP BY 1, 2
UNION ALL
SELECT 'TOTAL', 'TOTAL', 'TOTAL', 'all', (SELECT count(*) FROM documents JOIN labels USING (doc_id)),
       (SELECT count(*) FROM (SELECT DISTINCT source, lang, quality FROM documents JOIN labels USING (doc_id)))""")
def report(spark, folder):
    rows = document_rows(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    rows = rows.withColumn("file_name", F.concat(F.lit("part-"), "quality"))
    return run_report(document_slices(spark, folder), rows)


@query("record_limit", "SELECT least(count(*), 100) AS n FROM documents")
def record_limit(spark, folder):
    return read_records(spark, f"{folder}/documents.parquet", "parquet", record_limit=100).agg(F.count("*").alias("n"))


@query("read_in_order", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, doc_id FROM documents")
def read_in_order(spark, folder):
    return read_in_file_order(spark, f"{folder}/documents.parquet").select("row_index", "doc_id")
