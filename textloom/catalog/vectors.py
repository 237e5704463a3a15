"""Embedding, reduction and neighbour graphs over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog.base import query, table
from textloom.operators.affinity import conditional_affinities, fuzzy_graph, membership, perplexity_affinities
from textloom.operators.descent import knn_descent
from textloom.operators.embed import audit, embed, hash_embed, is_bad, model_embed, tokens
from textloom.operators.neighbors import knn_graph
from textloom.operators.reduce import covariance, pca, pre_reduce, reduce
from textloom.session import materialize, scratch_path
from textloom.sources.sinks import write_table

WIDTH = 8


def entry_sql(token: str, k: int) -> str:
    digest = f"md5('{k // 4}:' || {token})"
    return f"(CAST(('0x' || substr({digest}, {1 + 8 * (k % 4)}, 8)) AS BIGINT) / 4294967296.0 - 0.5)"


TOKENS_SQL = """
tok AS (SELECT doc_id, [t FOR t IN string_split_regex(text, '\\s+') IF t <> ''] AS ts FROM documents),
words AS (SELECT doc_id, unnest(ts) AS t FROM tok)
"""


@query("hash_embed_mean", "WITH " + TOKENS_SQL + "SELECT doc_id, " + ", ".join(
    f"round(CAST(CAST(avg({entry_sql('t', k)}) AS FLOAT) AS DOUBLE), 5) AS v{k}" for k in range(WIDTH)) + " FROM words GROUP BY 1")
def hash_embed_mean(spark, folder):
    vectors = embed(table(spark, folder, "documents"), hash_embed(F.col("text"), WIDTH), ["doc_id"])
    return vectors.select("doc_id", *[F.round(F.col("embeddings")[k].cast("double"), 5).alias(f"v{k}") for k in range(WIDTH)])


@query("hash_embed_last", "WITH " + TOKENS_SQL + "SELECT doc_id, " + ", ".join(
    f"round(CAST(CAST({entry_sql('ts[len(ts)]', k)} AS FLOAT) AS DOUBLE), 5) AS v{k}" for k in range(WIDTH)) + " FROM tok WHERE len(ts) > 0")
def hash_embed_last(spark, folder):
    vectors = embed(table(spark, folder, "documents"), hash_embed(F.col("text"), WIDTH, "last_token"), ["doc_id"])
    return vectors.select("doc_id", *[F.round(F.col("embeddings")[k].cast("double"), 5).alias(f"v{k}") for k in range(WIDTH)])


@query("token_truncation", "WITH " + TOKENS_SQL + """
SELECT doc_id, len(ts) AS tokens, least(len(ts), 64) AS kept, CASE WHEN len(ts) > 0 THEN ts[least(len(ts), 64)] END AS last_kept FROM tok""")
def token_truncation(spark, folder):
    text = F.col("text")
    cut = tokens(text, 64)
    return table(spark, folder, "documents").select(
        "doc_id", F.size(tokens(text)).alias("tokens"), F.size(cut).alias("kept"), F.try_element_at(cut, F.lit(-1)).alias("last_kept"))


@query("model_inference", "SELECT doc_id, CAST(length(text) AS DOUBLE) AS chars, "
       "CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS lines FROM documents")
def model_inference(spark, folder):
    def make_predict_fn():
        import numpy as np

        def predict(texts):
            return np.array([[len(t), t.count("\n") + 1] for t in texts], dtype=np.float32)

        return predict

    vectors = embed(table(spark, folder, "documents"), model_embed(F.col("text"), make_predict_fn, 256), ["doc_id"])
    return vectors.select("doc_id", F.col("embeddings")[0].cast("double").alias("chars"), F.col("embeddings")[1].cast("double").alias("lines"))


@query("embedding_projection", "SELECT vec_id AS id, len(embedding) AS width FROM embeddings")
def embedding_projection(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "id")
    return embed(vectors, F.col("embedding")).select("id", F.size("embeddings").alias("width"))


def damaged(spark, folder):
    """Entries above 0.45 become NaN, below -0.45 null."""
    return table(spark, folder, "embeddings").withColumn("embedding", F.transform("embedding", lambda x: F.when(
        x > 0.45, F.lit(float("nan")).cast("float")).when(x >= -0.45, x)))


BAD_SQL = "len([x FOR x IN embedding IF abs(x) > CAST(0.45 AS DOUBLE)]) > 0"


@query("nan_audit", f"SELECT label, count(*) FILTER (WHERE {BAD_SQL}) AS bad, count(*) AS total FROM embeddings GROUP BY 1")
def nan_audit(spark, folder):
    return audit(damaged(spark, folder), "embedding", ["label"])


@query("invalid_mask", f"SELECT vec_id, {BAD_SQL} AS bad FROM embeddings")
def invalid_mask(spark, folder):
    return damaged(spark, folder).select("vec_id", is_bad(F.col("embedding")).alias("bad"))


@query("covariance", """
WITH d AS (SELECT vec_id, i, embedding[i + 1] AS v FROM embeddings, range(64) r(i))
SELECT a.i, b.i AS j, round(covar_samp(CAST(a.v AS DOUBLE), CAST(b.v AS DOUBLE)), 6) + 0.0 AS cov
FROM d a JOIN d b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2""")
def covariance_of_embeddings(spark, folder):
    df = covariance(table(spark, folder, "embeddings"), "embedding")
    return df.withColumn("cov", F.round("cov", 6) + 0.0)


DIMS = "range(1, 65)"

# Two principal components: the covariance squared again and again until one axis is left, then the same
# without that axis. Signs make the largest loading positive.
PCA_SQL = f"""
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dims AS (SELECT unnest({DIMS}) AS i),
mean AS (SELECT list(m ORDER BY i) AS m FROM (SELECT i, avg(v[i]) AS m FROM e, dims GROUP BY i)),
centred AS (SELECT vec_id, [v[i] - m[i] FOR i IN {DIMS}] AS v FROM e, mean),
cov AS (
  SELECT list(r ORDER BY i) AS c FROM (
    SELECT i, list(s ORDER BY j) AS r FROM (SELECT a.i, b.i AS j, sum(v[a.i] * v[b.i]) AS s FROM centred, dims a, dims b GROUP BY 1, 2) GROUP BY i)),
p1 AS (
  SELECT 0 AS step, c FROM cov
  UNION ALL
  SELECT step + 1, [[list_dot_product(x, y) / t / t FOR y IN c] FOR x IN c] FROM (SELECT step, c, list_sum([c[i][i] FOR i IN {DIMS}]) AS t FROM p1) WHERE step < 20),
d1 AS (SELECT c, [c[i][i] FOR i IN {DIMS}] AS d FROM p1 WHERE step = 20),
a1 AS (SELECT [x / sqrt(list_dot_product(r, r)) FOR x IN r] AS a FROM (SELECT c[list_position(d, list_max(d))] AS r FROM d1)),
l1 AS (SELECT a, c, list_dot_product(a, [list_dot_product(x, a) FOR x IN c]) AS l FROM cov, a1),
p2 AS (
  SELECT 0 AS step, [[c[i][j] - l * a[i] * a[j] FOR j IN {DIMS}] FOR i IN {DIMS}] AS c FROM l1
  UNION ALL
  SELECT step + 1, [[list_dot_product(x, y) / t / t FOR y IN c] FOR x IN c] FROM (SELECT step, c, list_sum([c[i][i] FOR i IN {DIMS}]) AS t FROM p2) WHERE step < 20),
d2 AS (SELECT c, [c[i][i] FOR i IN {DIMS}] AS d FROM p2 WHERE step = 20),
a2 AS (SELECT [x / sqrt(list_dot_product(r, r)) FOR x IN r] AS a FROM (SELECT c[list_position(d, list_max(d))] AS r FROM d2)),
pca AS (SELECT vec_id, list_dot_product(v, a1.a) AS x, list_dot_product(v, a2.a) AS y FROM centred, a1, a2)
"""


@query("pca_2d", f"""WITH RECURSIVE {PCA_SQL}
SELECT vec_id, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4) + 0.0 AS pca_2d_x, round(CAST(CAST(y AS FLOAT) AS DOUBLE), 4) + 0.0 AS pca_2d_y FROM pca""")
def pca_2d(spark, folder):
    points = reduce(table(spark, folder, "embeddings"), ["vec_id"], "embedding", ["pca", "no such method"])
    return points.select("vec_id", *[(F.round(F.col(c).cast("double"), 4) + 0.0).alias(c) for c in ("pca_2d_x", "pca_2d_y")])


@query("tsne_2d")
def tsne_2d(spark, folder):
    return reduce(table(spark, folder, "embeddings"), ["vec_id"], "embedding", ["tsne"])


@query("umap_2d")
def umap_2d(spark, folder):
    return reduce(table(spark, folder, "embeddings"), ["vec_id"], "embedding", ["umap"])


@query("layouts_with_gaps", f"SELECT vec_id, {BAD_SQL} AS tsne_empty, {BAD_SQL} AS umap_empty FROM embeddings")
def layouts_with_gaps(spark, folder):
    """Every row is placed by both layouts, or by none where its vector is damaged."""
    points = reduce(damaged(spark, folder), ["vec_id"], "embedding", ["tsne", "umap"])
    return points.select("vec_id", *[(F.isnan(f"{m}_2d_x") & F.isnan(f"{m}_2d_y")).alias(f"{m}_empty") for m in ("tsne", "umap")])


@query("pca_with_gaps", f"SELECT vec_id, {BAD_SQL} AS empty FROM embeddings")
def pca_with_gaps(spark, folder):
    points = reduce(damaged(spark, folder), ["vec_id"], "embedding", ["pca"])
    return points.select("vec_id", (F.isnan("pca_2d_x") & F.isnan("pca_2d_y")).alias("empty"))


@query("pca_50", "SELECT count(*) AS n, 50 AS width FROM embeddings")
def pca_50(spark, folder):
    narrow = pre_reduce(table(spark, folder, "embeddings"), "embedding", 64, "narrow")
    return narrow.agg(F.count("narrow").alias("n"), F.max(F.size("narrow")).alias("width"))


@query("pca_full", """
WITH d AS (SELECT i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(i))
SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(s), 5) AS variance, true AS ordered, true AS uncorrelated
FROM (SELECT var_samp(v) AS s FROM d GROUP BY i)""")
def pca_full(spark, folder):
    """All components: the total variance stays, largest first, and no two go together."""
    rows = materialize(pca(table(spark, folder, "embeddings"), "embedding", 64, "p").select("p"), "components")
    own = F.col("i") == F.col("j")
    all_of = covariance(rows, "p").agg(
        F.sum(F.when(own, F.col("cov"))).alias("variance"), F.array_sort(F.collect_list(F.when(own, F.struct("i", "cov")))).alias("c"),
        (F.max(F.when(~own, F.abs("cov"))) < 1e-9).alias("uncorrelated"))
    steps = F.zip_with(F.slice("c", 1, 63), F.slice("c", 2, 63), lambda a, b: a["cov"] >= b["cov"] - 1e-9)
    return all_of.select(F.lit(rows.count()).cast("long").alias("n"), F.round("variance", 5).alias("variance"), F.forall(steps, lambda x: x).alias("ordered"), "uncorrelated")


KNN_SQL = """
pairs AS (
  SELECT a.vec_id AS src, b.vec_id AS dst,
         list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
knn AS (
  SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pairs
  QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 15)
"""


def graph(spark, folder):
    return knn_graph(table(spark, folder, "embeddings"), "vec_id", "embedding", 15)


@query("knn_graph", f"WITH {KNN_SQL} SELECT src, dst, rank, round(dist, 6) AS dist FROM knn")
def knn(spark, folder):
    return graph(spark, folder).withColumn("dist", F.round("dist", 6))


# Copies: each vector rounded hard, so that many are equal.
@query("knn_with_copies", """
WITH e AS (SELECT vec_id, [CAST(round(CAST(x AS DOUBLE) * 2) AS DOUBLE) FOR x IN embedding] AS embedding FROM embeddings),
pairs AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_distance(a.embedding, b.embedding) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank, round(dist, 6) AS dist FROM pairs
QUALIFY row_number() OVER (PARTITION BY src ORDER BY dist, dst) <= 15""")
def knn_with_copies(spark, folder):
    coarse = table(spark, folder, "embeddings").select("vec_id", F.transform(
        "embedding", lambda x: F.round(x.cast("double") * 2)).alias("embedding"))
    return knn_graph(coarse, "vec_id", "embedding", 15, cell_rows=50).withColumn("dist", F.round("dist", 6))


@query("knn_descent", "SELECT count(*) AS points, count(*) * 15 AS entries, true AS recalled FROM embeddings WHERE vec_id % 20 = 0")
def descent(spark, folder):
    """Lists by descent beside the exact ones, of one point in twenty: at least 19 of 20 neighbours are found."""
    vectors = table(spark, folder, "embeddings")
    some = F.col("src") % 20 == 0
    near = knn_descent(vectors, "vec_id", "embedding", 15).where(some).select("src", "dst", F.lit(1).alias("met"))
    exact = graph(spark, folder).where(some).select("src", "dst")
    both = exact.join(near, ["src", "dst"], "left")
    counts = both.agg(F.countDistinct("src").alias("points"), (F.count("met") >= 0.95 * F.count("*")).alias("recalled"))
    return counts.withColumn("entries", F.lit(near.count()).cast("long")).select("points", "entries", "recalled")


PERPLEXITY_SQL = f"""
{KNN_SQL},
lists AS (SELECT src, list(dist * dist - m ORDER BY rank) AS d2, list(dst ORDER BY rank) AS dsts
          FROM (SELECT *, min(dist * dist) OVER (PARTITION BY src) AS m FROM knn) GROUP BY src),
b AS (
  SELECT 0 AS step, src, d2, CAST(0 AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, CAST(1 AS DOUBLE) AS beta FROM lists
  UNION ALL
  SELECT step + 1, src, d2, CASE WHEN h > ln(5) THEN beta ELSE lo END, CASE WHEN h > ln(5) THEN hi ELSE beta END,
         CASE WHEN h > ln(5) THEN CASE WHEN hi IS NULL THEN beta * 2 ELSE (beta + hi) / 2 END ELSE (lo + beta) / 2 END
  FROM (SELECT *, ln(list_sum([exp(-d * beta) FOR d IN d2])) +
               beta * list_sum([d * exp(-d * beta) FOR d IN d2]) / list_sum([exp(-d * beta) FOR d IN d2]) AS h FROM b)
  WHERE step < 64),
solved AS (SELECT src, dsts, l.d2, beta FROM b JOIN lists l USING (src) WHERE step = 64),
p AS (SELECT src, unnest(dsts) AS dst, unnest([exp(-d * beta) / list_sum([exp(-e * beta) FOR e IN d2]) FOR d IN d2]) AS p FROM solved)
"""


@query("conditional_affinities", f"WITH RECURSIVE {PERPLEXITY_SQL} SELECT src, dst, round(p, 6) AS p FROM p")
def conditional(spark, folder):
    return conditional_affinities(materialize(graph(spark, folder), "knn"), 5.0).withColumn("p", F.round("p", 6))


@query("tsne_affinities", f"""WITH RECURSIVE {PERPLEXITY_SQL}
SELECT src, dst, round(sum(p) / (2 * (SELECT count(*) FROM embeddings)), 8) AS p
FROM (SELECT src, dst, p FROM p UNION ALL SELECT dst, src, p FROM p) GROUP BY 1, 2""")
def tsne_affinities(spark, folder):
    return perplexity_affinities(materialize(graph(spark, folder), "knn"), 5.0).withColumn("p", F.round("p", 8))


FUZZY_SQL = f"""
{KNN_SQL},
lists AS (SELECT src, list(greatest(dist - rho, 0) ORDER BY rank) AS gap, list(dst ORDER BY rank) AS dsts, avg(dist) * 0.001 AS floor
          FROM (SELECT *, coalesce(min(CASE WHEN dist > 0 THEN dist END) OVER (PARTITION BY src), 0) AS rho FROM knn) GROUP BY src),
b AS (
  SELECT 0 AS step, src, gap, CAST(0 AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, CAST(1 AS DOUBLE) AS sigma FROM lists
  UNION ALL
  SELECT step + 1, src, gap, CASE WHEN h < log2(15) THEN sigma ELSE lo END, CASE WHEN h < log2(15) THEN hi ELSE sigma END,
         CASE WHEN h < log2(15) THEN CASE WHEN hi IS NULL THEN sigma * 2 ELSE (sigma + hi) / 2 END ELSE (lo + sigma) / 2 END
  FROM (SELECT *, list_sum([exp(-g / sigma) FOR g IN gap]) AS h FROM b) WHERE step < 64),
solved AS (SELECT src, dsts, l.gap, greatest(sigma, floor) AS sigma FROM b JOIN lists l USING (src) WHERE step = 64),
w AS (SELECT src, unnest(dsts) AS dst, unnest([exp(-g / sigma) FOR g IN gap]) AS w FROM solved)
"""


@query("fuzzy_membership", f"WITH RECURSIVE {FUZZY_SQL} SELECT src, dst, round(w, 6) AS w FROM w")
def fuzzy_membership(spark, folder):
    return membership(materialize(graph(spark, folder), "knn"), 15).withColumn("w", F.round("w", 6))


@query("fuzzy_graph", f"""WITH RECURSIVE {FUZZY_SQL}
SELECT src, dst, round(sum(w) - CASE WHEN count(*) = 2 THEN max(w) * min(w) ELSE 0 END, 6) AS w
FROM (SELECT src, dst, w FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY 1, 2""")
def fuzzy(spark, folder):
    return fuzzy_graph(materialize(graph(spark, folder), "knn"), 15).withColumn("w", F.round("w", 6))


@query("points_sink", f"SELECT label, count(*) AS n, count(*) FILTER (WHERE NOT {BAD_SQL}) AS placed FROM embeddings GROUP BY 1")
def points_sink(spark, folder):
    """Points written by label in small files, and read again."""
    path = scratch_path(spark, "points")
    rows = damaged(spark, folder)
    write_table(reduce(rows, ["vec_id", "label"], "embedding", ["pca"]), path, chunk_size=100, partition_by=["label"])
    return spark.read.parquet(path).groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(~F.isnan("pca_2d_x") & ~F.isnan("pca_2d_y")).alias("placed"))
