"""Profiles, counts, quantiles, samples and plot-ready series."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import settled


# -- metadata ----------------------------------------------------------------------


def flatten_struct(schema: T.StructType, root: Column, prefix: str = "") -> list[tuple[str, Column]]:
    """Leaves of a struct with dotted names."""
    out: list[tuple[str, Column]] = []
    for f in schema:
        name, col = f"{prefix}{f.name}", root.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            out += flatten_struct(f.dataType, col, name + ".")
        else:
            out.append((name, col))
    return out


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of a JSON string column over all its rows."""
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    if not (merged or "").startswith("OBJECT<"):
        raise ValueError(f"{column} holds no JSON objects")
    # Types only, not keys of the same names.
    ddl = re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", merged)
    ddl = re.sub(r"(: |<)VOID(?=[,>])", r"\1STRING", ddl)
    return df.sparkSession.sql(f"SELECT CAST(NULL AS {ddl}) AS c").schema[0].dataType


def expand_json(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    """Replace a JSON column by its members; columns already there win a name clash."""
    schema = schema or infer_json_schema(df, column)
    base = [c for c in df.columns if c != column]
    parsed = df.withColumn("_json", F.from_json(column, schema))
    members = [(n, c) for n, c in flatten_struct(schema, F.col("_json")) if n not in base]
    return parsed.select(*[F.col(f"`{c}`") for c in base], *[c.alias(n) for n, c in members])


def parse_date(text: Column) -> Column:
    """Day/month/year, null when it is no date."""
    return F.try_to_date(text, "d/M/yyyy")


# -- profile -----------------------------------------------------------------------


def schema_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Per column: type, non-null count, null percentage, distinct values, a sample value.

    Exact distinct counts group (column, value) pairs, so a frequent value is combined
    before the shuffle; values over 64 characters travel as their digest.
    """
    columns = list(columns or df.columns)
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        return F.col(f"`{c}`").cast("string")

    def compact(c: str) -> Column:
        long = F.length(text(c)) > 64
        return F.concat(F.when(long, "#").otherwise("="), F.when(long, F.sha2(F.encode(text(c), "UTF-8"), 256)).otherwise(text(c)))

    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggregates += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.min(F.substring(text(c), 1, 80)).alias(f"s{i}")]
        if approximate:
            aggregates.append(F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}"))
    wide = df.agg(*aggregates)
    long = wide.select(F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
            F.col(f"n{i}").alias("non_null"),
            F.bround(F.try_divide((F.col("rows") - F.col(f"n{i}")) * 100.0, F.col("rows")), 1).alias("null_pct"),
            F.col(f"s{i}").alias("sample"),
            (F.col(f"d{i}") if approximate else F.lit(None).cast("long")).alias("unique"),
        ) for i, c in enumerate(columns)])).alias("p")).select("p.*")
    if approximate:
        return long
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), compact(c).alias("value")) for i, c in enumerate(columns)])).alias("v")
    ).select("v.*").where(F.col("value").isNotNull())
    unique = pairs.groupBy("position", "value").agg(F.lit(1).alias("one")) \
        .groupBy("position").agg(F.count(F.lit(1)).alias("unique"))
    return long.drop("unique").join(F.broadcast(unique), "position", "left") \
        .withColumn("unique", F.coalesce("unique", F.lit(0)))


# -- numbers -----------------------------------------------------------------------


# The sketch behind approximate quantiles is off by at most one in SKETCH of the rows; the brackets are twice as wide.
SKETCH = 10_000
BINS = 256
LAST_ROWS = 10_000


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles as ``probability, value``."""
    found, _ = _quantiles(df, column, probabilities)
    return df.sparkSession.createDataFrame([(float(p), v) for p, v in zip(probabilities, found)], "probability double, value double")


def _quantiles(df: DataFrame, column: str, probabilities: Sequence[float], *more: Column) -> tuple[list[float | None], Row]:
    """Exact quantiles in two scans, and further aggregates of ``df`` taken in the first.

    The first scan makes a sketch, which merges from task to task, and brackets each wanted rank with it. The second
    counts: a value between brackets is kept with its number, all others are added up by the gap they lie in.
    That table holds some ten thousandths of the rows, and the ranks are found in it by counts of equal bins, finer
    with each turn, until few rows are left. Counts say whether a bracket holds its rank; where one does not, the
    brackets are taken wider and the second scan is done again.
    """
    v = F.col(column).cast("double")
    margin = 2 / SKETCH
    shares = sorted({min(1.0, max(0.0, p + side * margin)) for p in probabilities for side in (-1, 1)})
    row = df.agg(F.count(v).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high"), F.percentile_approx(v, shares, SKETCH).alias("_cuts"), *more).first()
    total = row["_n"]
    if not total:
        return [None] * len(probabilities), row
    cuts = dict(zip(shares, row["_cuts"]))
    ends = [(cuts[max(0.0, p - margin)], cuts[min(1.0, p + margin)]) for p in probabilities]
    ranks = sorted({r for p in probabilities for r in _ranks(p, total)})
    values = df.select(v.alias("v")).where(F.col("v").isNotNull())
    at = _at_ranks(values, _joined(ends), ranks)
    if at is None:
        at = _at_ranks(values, [(row["_low"], row["_high"])], ranks)
    out = []
    for p in probabilities:
        low, high = _ranks(p, total)
        above = p * (total - 1) - low
        out.append(at[low] if at[low] == at[high] else at[low] * (1 - above) + at[high] * above)
    return out, row


def _ranks(p: float, total: int) -> tuple[int, int]:
    return math.floor(p * (total - 1)), math.ceil(p * (total - 1))


def _joined(ends: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, those that overlap made one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(ends):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _at_ranks(values: DataFrame, brackets: list[tuple[float, float]], ranks: list[int]) -> dict[int, float] | None:
    """The value at each rank, or None where a rank lies outside the brackets. Slots in order: the gap below the first
    bracket is 0, the bracket 1, the gap above it 2, and so on."""
    v = F.col("v")
    slot = F.lit(2 * len(brackets))
    for k, (low, high) in reversed(list(enumerate(brackets))):
        slot = F.when(v < low, 2 * k).when(v <= high, 2 * k + 1).otherwise(slot)
    kept = F.when(slot % 2 == 1, v)
    counted = settled(values.sparkSession, "counts", lambda: values.groupBy(slot.cast("int").alias("slot"), kept.alias("v")).agg(F.count(F.lit(1)).alias("n")))
    below, spans, at = 0, {}, {}
    sums = {r["slot"]: r["n"] for r in counted.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    for k in range(2 * len(brackets) + 1):
        inside = [r for r in ranks if below <= r < below + sums.get(k, 0)]
        if inside and k % 2 == 0:
            return None
        if inside:
            spans[k // 2] = (*brackets[k // 2], below, sums[k], inside)
        below += sums.get(k, 0)
    work = [(low, high, under, n, inside) for low, high, under, n, inside in spans.values()]
    while work:  # each turn looks at the counts only, in bins of one BINS-th of what is left
        few = [w[3] <= LAST_ROWS or not 0 < (w[1] - w[0]) / BINS < math.inf for w in work]
        last, work = [w for w, f in zip(work, few) if f], [w for w, f in zip(work, few) if not f]
        if last:
            rows = counted.where(_any([v.between(w[0], w[1]) for w in last])).groupBy("v").agg(F.sum("n").alias("n")).orderBy("v").collect()
            for low, high, under, _, inside in last:
                for r in rows:
                    if low <= r["v"] <= high:
                        at |= {k: r["v"] for k in inside if under <= k < under + r["n"]}
                        under += r["n"]
        finer = []
        for low, high, under, _, inside in work:
            number = F.least(F.floor((v - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
            bins = counted.where(v.between(low, high)).groupBy(number.alias("bin")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
            for r in sorted(bins, key=lambda r: r["bin"]):
                held = [k for k in inside if under <= k < under + r["n"]]
                if held:
                    finer.append((r["low"], r["high"], under, r["n"], held))
                under += r["n"]
        work = finer
    return at


def _any(conditions: Sequence[Column]) -> Column:
    found = F.lit(False)
    for c in conditions:
        found = found | c
    return found


def describe(df: DataFrame, column: str) -> DataFrame:
    """``count, mean, std, min, 25%, 50%, 75%, max`` as ``stat, value`` rows, in two scans."""
    c = F.col(column).cast("double")
    found, row = _quantiles(df, column, [0.25, 0.5, 0.75], F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
    rows = [("count", float(row["_n"])), ("mean", row["mean"]), ("std", row["std"]), ("min", row["_low"]),
            *zip(("25%", "50%", "75%"), found), ("max", row["_high"])]
    return df.sparkSession.createDataFrame(rows, "stat string, value double")


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Equal-width bins between the smallest and largest value; empty bins are left out."""
    c = F.col(column).cast("double")
    low, high = df.agg(F.min(c), F.max(c)).first()
    schema = "bin int, low double, high double, count long"
    if low is None:
        return df.sparkSession.createDataFrame([], schema)
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((c - low) / width), F.lit(bins - 1)).cast("int")
    return (
        df.where(c.isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        .select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "count")
    )


def box_summary(df: DataFrame, column: str) -> DataFrame:
    """One row: quartiles, whiskers inside 1.5 times the quartile range, outlier count."""
    c = F.col(column).cast("double")
    (q1, q2, q3), _ = _quantiles(df, column, [0.25, 0.5, 0.75])
    spread = None if q1 is None else 1.5 * (q3 - q1)
    inside = F.lit(None).cast("boolean") if spread is None else c.between(q1 - spread, q3 + spread)
    return df.agg(
        F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"), F.lit(q3).cast("double").alias("q3"),
        F.min(F.when(inside, c)).alias("low_whisker"), F.max(F.when(inside, c)).alias("high_whisker"),
        F.count_if(c.isNotNull() & ~inside).alias("outliers"),
    )


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the whiskers."""
    box = box_summary(df, column).first()
    c = F.col(column).cast("double")
    return df.where((c < box["low_whisker"]) | (c > box["high_whisker"]))


# -- categories --------------------------------------------------------------------


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values, nulls left out, ties by value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value").limit(n)
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value in value order, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def crosstab_long(df: DataFrame, row: str, column: str, top: int = 10) -> DataFrame:
    """``row, column, count`` of the ``top`` most frequent row values, zeros included for
    every column value that occurs with one of them. Only the ``top`` names reach the
    driver."""
    leaders = [r["value"] for r in top_values(df, row, top).collect()]
    kept = df.where(F.col(row).isin(leaders) & F.col(column).isNotNull())
    wide = kept.groupBy(column).agg(
        *[F.count_if(F.col(row) == name).alias(f"_c{i}") for i, name in enumerate(leaders)])
    cells = F.array(*[
        F.struct(F.lit(name).alias(row), F.col(f"_c{i}").alias("count")) for i, name in enumerate(leaders)])
    if not leaders:
        return kept.select(row, column, F.lit(0).cast("long").alias("count"))
    long = wide.select(column, F.explode(cells).alias("c")).select(f"c.{row}", column, "c.count")
    dated = long.where("count > 0").select(row).distinct()
    return long.join(F.broadcast(dated), row, "left_semi")


def crosstab(df: DataFrame, row: str, column: str, top: int = 10, values: Sequence | None = None) -> DataFrame:
    """The same as a wide table, one column per column value. Pass ``values`` where they
    are known: without them their list is read first, and the driver holds it."""
    leaders = F.broadcast(top_values(df, row, top).select(F.col("value").alias(row)))
    kept = df.join(leaders, row, "left_semi").where(F.col(column).isNotNull())
    return kept.groupBy(row).pivot(column, list(values) if values is not None else None).count().fillna(0).orderBy(row)


def top_or_other(df: DataFrame, column: str, n: int = 15, name: str | None = None, other: str = "Other") -> DataFrame:
    """Add ``<column>_top``: the value when among the ``n`` most frequent, else ``Other``."""
    leaders = top_values(df, column, n).select(F.col("value").alias(column), F.col("value").alias("_hit"))
    return (
        df.join(F.broadcast(leaders), column, "left")
        .withColumn(name or f"{column}_top", F.coalesce("_hit", F.lit(other))).drop("_hit")
    )


# -- sample and series -------------------------------------------------------------


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all when there are no more), the same on every run.

    Rows are ordered by a seeded digest of their key. A bound on the digest, set from the
    row count, leaves little more than ``n`` rows to sort.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    keyed = df.withColumn("_digest", digest)
    total = df.count()
    if total <= n:
        return df
    share = (n + 6 * n**0.5 + 64) / total
    while share < 1:
        bound = f"{int(share * 16**12):012x}"
        kept = keyed.where(F.col("_digest") < bound)
        if kept.select("_digest").count() >= n:
            keyed = kept
            break
        share *= 2
    return keyed.orderBy("_digest", key).limit(n).drop("_digest")


# Plot titles and the point columns behind them.
ALGORITHMS = {"PCA": "pca", "t-SNE": "tsne", "UMAP": "umap"}


def scatter_series(points: DataFrame, color_fields: dict[str, str], algorithms: dict[str, str] | None = None,
                   text: str = "text", id_column: str = "id", hover: int = 80) -> DataFrame:
    """Long rows ``algo, color_field, category, id, x, y, hover``."""
    algorithms = algorithms or ALGORITHMS
    series = F.array(*[
        F.struct(F.lit(a).alias("algo"), F.lit(label).alias("color_field"), F.col(c).alias("category"),
                 F.col(f"{m}_2d_x").alias("x"), F.col(f"{m}_2d_y").alias("y"))
        for a, m in algorithms.items() for label, c in color_fields.items()])
    return points.select(
        F.col(id_column).alias("id"), F.substring(text, 1, hover).alias("hover"), F.explode(series).alias("s")
    ).select("s.algo", "s.color_field", "s.category", "id", "s.x", "s.y", "hover")
