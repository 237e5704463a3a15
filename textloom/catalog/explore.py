"""Exploration queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.catalog.base import query, table
from textloom.catalog.vectors import PCA_SQL
from textloom.operators import explore as X
from textloom.operators.reduce import reduce
from textloom.sources.landed import zip_by_position, read_in_file_order


def rounded(df, *columns: str, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("json_expand", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS "tag.type", user_id AS "tag.user"
FROM events""")
def json_expand(spark, folder):
    events = table(spark, folder, "events")
    tag = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
    nested = F.to_json(F.struct(F.from_json("props", "k bigint")["k"].alias("k"), tag.alias("tag"), F.lit("x").alias("event_type")))
    return X.expand_json(events.select("event_id", "event_type", nested.alias("metadata_json")), "metadata_json")


@query("date_parse", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS issued, year(o_orderdate) AS year,
       CASE WHEN day(o_orderdate) <= 28 THEN strftime(make_date(year(o_orderdate), 2, day(o_orderdate)), '%Y-%m-%d')
            WHEN day(o_orderdate) = 29 AND year(o_orderdate) % 4 = 0 AND (year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0)
            THEN year(o_orderdate) || '-02-29' END AS in_february
FROM orders""")
def date_parse(spark, folder):
    orders = table(spark, folder, "orders")
    text = F.date_format("o_orderdate", "d/M/yyyy")
    february = F.concat(F.date_format("o_orderdate", "dd"), F.lit("/02/"), F.date_format("o_orderdate", "yyyy"))
    issued = X.parse_date(text)
    return orders.select(
        "o_orderkey", F.date_format(issued, "yyyy-MM-dd").alias("issued"), F.year(issued).alias("year"),
        F.date_format(X.parse_date(february), "yyyy-MM-dd").alias("in_february"))


PROFILE_SQL = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 1) AS null_pct, min(substr(CAST({c} AS VARCHAR), 1, 80)) AS sample, "
    f"count(DISTINCT {c}) AS \"unique\" FROM joined"
    for i, (c, t) in enumerate([("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                                ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]))


@query("schema_profile", f"WITH joined AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) {PROFILE_SQL}")
def schema_profile(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return X.schema_profile(docs.join(labels, "doc_id", "left"))


LENGTHS = "(SELECT CAST(length(text) AS DOUBLE) AS v FROM documents)"


@query("text_length_describe", f"""
WITH s AS (SELECT count(v) AS c, avg(v) AS m, stddev_samp(v) AS s, min(v) AS lo, max(v) AS hi,
  quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS d FROM {LENGTHS})
SELECT 'count' AS stat, CAST(c AS DOUBLE) AS value FROM s UNION ALL SELECT 'mean', round(m, 6) FROM s
UNION ALL SELECT 'std', round(s, 6) FROM s UNION ALL SELECT 'min', lo FROM s UNION ALL SELECT 'max', hi FROM s
UNION ALL SELECT '25%', round(a, 6) FROM s UNION ALL SELECT '50%', round(b, 6) FROM s UNION ALL SELECT '75%', round(d, 6) FROM s""")
def text_length_describe(spark, folder):
    lengths = table(spark, folder, "documents").select(F.length("text").alias("text_len"))
    return rounded(X.describe(lengths, "text_len"), "value")


@query("price_describe", """
WITH s AS (SELECT count(v) AS c, avg(v) AS m, stddev_samp(v) AS s, min(v) AS lo, max(v) AS hi,
  quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS d FROM (SELECT l_extendedprice AS v FROM lineitem))
SELECT 'count' AS stat, CAST(c AS DOUBLE) AS value FROM s UNION ALL SELECT 'mean', round(m, 4) FROM s
UNION ALL SELECT 'std', round(s, 4) FROM s UNION ALL SELECT 'min', lo FROM s UNION ALL SELECT 'max', hi FROM s
UNION ALL SELECT '25%', round(a, 4) FROM s UNION ALL SELECT '50%', round(b, 4) FROM s UNION ALL SELECT '75%', round(d, 4) FROM s""")
def price_describe(spark, folder):
    return rounded(X.describe(table(spark, folder, "lineitem"), "l_extendedprice"), "value", digits=4)


@query("length_histogram", f"""
WITH b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 100 AS w FROM {LENGTHS})
SELECT CAST(least(floor((v - lo) / w), 99) AS INTEGER) AS bin, count(*) AS count,
       round(lo + least(floor((v - lo) / w), 99) * w, 6) AS low, round(lo + (least(floor((v - lo) / w), 99) + 1) * w, 6) AS high
FROM {LENGTHS}, b GROUP BY bin, low, high""")
def length_histogram(spark, folder):
    lengths = table(spark, folder, "documents").select(F.length("text").alias("text_len"))
    return rounded(X.histogram(lengths, "text_len", 100), "low", "high")


@query("box_summary", f"""
WITH q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM {LENGTHS})
SELECT q1, median, q3,
       min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low_whisker,
       max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high_whisker,
       count(*) FILTER (WHERE NOT (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
FROM {LENGTHS}, q GROUP BY 1, 2, 3""")
def box_summary(spark, folder):
    return X.box_summary(table(spark, folder, "documents").select(F.length("text").alias("text_len")), "text_len")


@query("box_outliers", f"""
WITH q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM {LENGTHS})
SELECT doc_id, length(text) AS text_len FROM documents, q
WHERE length(text) < q1 - 1.5 * (q3 - q1) OR length(text) > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, folder):
    return X.outliers(table(spark, folder, "documents").select("doc_id", F.length("text").alias("text_len")), "text_len")


@query("top_values", """
SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, value LIMIT 20""")
def top_values(spark, folder):
    return X.top_values(table(spark, folder, "lineitem"), "l_partkey", 20)


@query("counts_per_year", """
SELECT year(o_orderdate) AS year, count(*) AS count FROM orders GROUP BY 1""")
def counts_per_year(spark, folder):
    year = F.year(X.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy")))
    return X.counts_by(table(spark, folder, "orders").select(year.alias("year")), "year")


@query("crosstab", """
WITH t AS (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10),
c AS (SELECT p_brand, year(l_shipdate) AS year, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE p_brand IN (SELECT p_brand FROM t) GROUP BY 1, 2)
SELECT b.p_brand, y.year, coalesce(c.count, 0) AS count
FROM (SELECT DISTINCT p_brand FROM c) b CROSS JOIN (SELECT DISTINCT year FROM c) y LEFT JOIN c ON c.p_brand = b.p_brand AND c.year = y.year""")
def crosstab(spark, folder):
    items, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    joined = items.join(part, items["l_partkey"] == part["p_partkey"]).select("p_brand", F.year("l_shipdate").alias("year"))
    return X.crosstab_long(joined, "p_brand", "year", 10)


YEARS = range(1992, 2003)


@query("crosstab_wide", """
SELECT o_orderpriority, """ + ", ".join(f'count(*) FILTER (WHERE year(o_orderdate) = {y}) AS "{y}"' for y in YEARS) + """
FROM orders WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
GROUP BY 1""")
def crosstab_wide(spark, folder):
    year = F.year("o_orderdate")
    known = F.when(year.isNull() | year.isin(*YEARS), year).otherwise(F.raise_error(F.concat(F.lit("no column for the year "), year)).cast("int"))
    orders = table(spark, folder, "orders").select("o_orderpriority", known.alias("year"))
    return X.crosstab(orders, "o_orderpriority", "year", 3, YEARS)


@query("top_other", """
WITH j AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL ELSE source END AS source FROM documents d LEFT JOIN labels l USING (doc_id)),
t AS (SELECT source FROM j WHERE source IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 15)
SELECT doc_id, source, CASE WHEN source IN (SELECT source FROM t) THEN source ELSE 'Other' END AS source_top FROM j""")
def top_other(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    joined = docs.join(labels, "doc_id", "left").select(
        "doc_id", F.when(F.col("quality").isNotNull(), F.col("source")).alias("source"))
    return X.top_or_other(joined, "source", 15)


@query("exact_sample", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 5000""")
def exact_sample(spark, folder):
    return X.exact_sample(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 5000)


@query("text_length", "SELECT doc_id, length(text) AS text_len FROM documents")
def text_length(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.length("text").alias("text_len"))


SERIES_SQL = """
SELECT algo, color_field, CASE color_field WHEN 'Language' THEN lang ELSE source END AS category, doc_id AS id,{place} substr(text, 1, 80) AS hover
FROM documents JOIN {points} ON doc_id = vec_id, (VALUES {algorithms}) a(algo), (VALUES ('Language'), ('Source')) c(color_field)"""


def series(spark, folder, algorithms):
    """The points of a reduction of the embeddings, joined to the documents by id."""
    docs = table(spark, folder, "documents")
    points = reduce(table(spark, folder, "embeddings"), ["vec_id"], "embedding", list(algorithms.values()))
    points = docs.join(points, docs["doc_id"] == points["vec_id"])
    return X.scatter_series(points, {"Language": "lang", "Source": "source"}, algorithms, id_column="doc_id")


@query("scatter_series", f"WITH RECURSIVE {PCA_SQL}" + SERIES_SQL.format(points="pca", algorithms="('PCA')", place="""
       round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4) + 0.0 AS x, round(CAST(CAST(y AS FLOAT) AS DOUBLE), 4) + 0.0 AS y,"""))
def scatter_series(spark, folder):
    rows = series(spark, folder, {"PCA": "pca"})
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 4) + 0.0 for c in ("x", "y")})


@query("scatter_layouts", SERIES_SQL.format(points="embeddings", algorithms="('PCA'), ('t-SNE'), ('UMAP')", place=" true AS placed,"))
def scatter_layouts(spark, folder):
    """All three series; where the points lie is for tests, SQL says that each has a place."""
    return series(spark, folder, X.ALGORITHMS).select(
        "algo", "color_field", "category", "id", (~F.isnan("x") & ~F.isnan("y")).alias("placed"), "hover")


@query("positional_zip", """
SELECT row_index, doc_id, vec_id, label
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, doc_id FROM documents)
JOIN (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_index, vec_id, label FROM embeddings) USING (row_index)""")
def positional_zip(spark, folder):
    docs = read_in_file_order(spark, f"{folder}/documents.parquet").select("row_index", "doc_id")
    vectors = read_in_file_order(spark, f"{folder}/embeddings.parquet").select("row_index", "vec_id", "label")
    return zip_by_position(docs, vectors)
