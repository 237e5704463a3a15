"""Connected components of a link table, by alternating large and small stars.

Each round rewires every node's links to its smallest neighbour; the rounds grow with the logarithm
of the graph's depth. Smallest neighbours are aggregated before the shuffle and written before they are
joined, so a node with very many links is split by the skew join. Every round's links are written to the
shared folder and the round before is removed: lineage stays short, and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import remove, scratch_path, write


def _kept(df: DataFrame, made: list[str]) -> DataFrame:
    made.append(scratch_path(df.sparkSession, "links"))
    write(df, made[-1])
    return df.sparkSession.read.schema(df.schema).parquet(made[-1])


def _star(links: DataFrame, made: list[str]) -> DataFrame:
    """Each link ``(u, v)`` and each ``u`` itself, tied to the smallest node around ``u``."""
    least = _kept(links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), made)
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``links``, a table of pairs ``(a, b)`` of any order, repeated
    or not: ``component`` is the smallest node that can be reached. No links, no rows."""
    spark = links.sparkSession
    made: list[str] = []
    now = _kept(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), made)
    seen = None
    while True:
        kept = made[-1]
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _kept(_star(both, made).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), made)
        starred = _star(large, made)
        small = starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(starred.select("u", F.col("m").alias("v"))).distinct()
        now = _kept(small, made)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        for path in made[made.index(kept):-1]:
            remove(spark, path)
        del made[:-1]
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state


class Forest:
    """Which of ``n`` points of one task are connected so far."""

    def __init__(self, n: int):
        import numpy as np

        self.parent = np.arange(n)

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def add(self, a, b) -> list[tuple[int, int]]:
        """Adds the links between the points ``a`` and ``b``, arrays; returns those that connect anything new."""
        import numpy as np

        parent = self.parent
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
        new = []
        fresh = parent[a] != parent[b]
        for i, j in zip(a[fresh].tolist(), b[fresh].tolist()):
            ri, rj = self._root(i), self._root(j)
            if ri != rj:
                parent[max(ri, rj)] = min(ri, rj)
                new.append((i, j))
        return new
