"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated at random and cut into blocks of few dimensions. Two vectors of cosine ``t`` have
squared distance ``2 - 2 t``, so in at least one block they are within the share of that budget that is
proportional to the block's dimensions. Each block is a range join: its first dimensions are laid on a grid,
a vector goes to the cells its box of half the radius touches, and two vectors within the radius share a
cell. There its vectors lie in leaves, boxes of the block's widest dimensions; matrix products give the squared
distances of the block between leaves that are within the radius. Of the few pairs within budget the
cosine is taken exactly, in double precision, on the vectors as they were given. A link counts in the first
block that has it, in one cell.

Equal vectors are one vector with a count. A cell with more than ``CELL_ROWS`` vectors is dealt to several groups,
one for each pair of its parts, so no group is larger, whatever the cell holds. A vector then goes to as many groups as
its cell has parts, so the groups are made in rounds of ``ROUND_BYTES``, and what a round has shuffled goes before the
next. Nothing is capped: in blocks where most vectors are near each other the work grows with the square of a cell.

Rows: a vector that is null, zero or has null or non-finite entries links with nothing and is its own
component. Vectors of different lengths do not link. Repeated rows are vectors of their own; rows of one id
link with each other too. Extra columns are not kept. An empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import give_back, quoted
from textloom.llm.components import Forest, components
from textloom.session import materialize

COSINE = 0.95
BLOCKS = 8
GRID = 3
"""Dimensions of each block that the grid uses."""
CELL_ROWS = 48_000
"""For vectors of 64 dimensions; for wider ones fewer, at least WIDE_ROWS."""
WIDE_ROWS = 2000
ROUND_BYTES = 1_500_000_000
ROW_BYTES = 100
"""What a row has besides its vector when it is sent."""
LEAF = 256
SPLIT = 3
"""Dimensions that leaves are split in."""
SEED = 20
SLACK = 1e-9
"""Block distances may be over budget by this much, for rounding."""
SLICE = 512


def layout(width: int, cosine: float) -> list[tuple[int, int, float]]:
    """Start, end and squared-distance budget of each block."""
    count = min(BLOCKS, width)
    cuts = [width * k // count for k in range(count + 1)]
    return [(a, b, (2 - 2 * cosine) * (b - a) / width + SLACK) for a, b in zip(cuts, cuts[1:])]


def rotation(width: int):
    import numpy as np

    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(width, width)))[0]


def units(x):
    """Rows of length one, each the same whatever rows are beside it."""
    import numpy as np

    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def turned(unit, turn):
    """Unit vectors rotated, summed in one order whatever rows are beside them: all groups must agree on which block
    has a pair first."""
    import numpy as np

    out = np.empty_like(unit)
    for start in range(0, len(unit), SLICE):
        out[start:start + SLICE] = (unit[start:start + SLICE, :, None] * turn).sum(axis=1)
    return out


def cosines(x, y):
    """Of pairs of rows, by dot product and lengths."""
    import numpy as np

    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def low_cells(x, budget: float):
    """For each row and grid dimension the first cell its box touches, and the last. Boxes are a little larger than they
    need be, so that no rounding parts two vectors."""
    import numpy as np

    radius = budget**0.5 * (1 + 1e-6)
    return tuple(np.floor((x[:, :GRID] + side * radius / 2) / (2 * radius)).astype("i8") for side in (-1, 1))


def prepared(df: DataFrame, vector: str) -> DataFrame:
    """``(row, id, width, vec)``: a number for each row, and the given vector's bytes as doubles, scaled by a power of
    two so that no square is out of range; null where the vector can link with nothing."""

    def function(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            found, widths = [None] * batch.num_rows, [None] * batch.num_rows
            for i in range(batch.num_rows):
                if vectors[i].is_valid and vectors[i].values.null_count == 0:
                    x = vectors[i].values.to_numpy().astype("f8")
                    if len(x) and np.isfinite(x).all() and x.any():
                        x = np.ldexp(x, -np.frexp(np.abs(x).max())[1]) + 0.0
                        found[i], widths[i] = (x if (x != x.astype("f4")).any() else x.astype("f4")).tobytes(), len(x)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(widths, pa.int32()), pa.array(found, pa.binary())], names=["row", "id", "width", "vec"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), quoted("_id").alias("id"), quoted(vector).alias("vector"))
    return rows.mapInArrow(function, f"row long, id {df.schema['_id'].dataType.simpleString()}, width int, vec binary")


def opened(vecs: list[bytes], width: int):
    """Vectors of one width as doubles; those that single precision holds were written so."""
    import numpy as np

    return held(vecs, width).astype("f8")


def held(vecs, width: int):
    """Vectors of one width, in single precision where it holds all."""
    import numpy as np

    if all(len(v) == 4 * width for v in vecs):
        return np.frombuffer(b"".join(vecs), "f4").reshape(-1, width)
    return np.array([np.frombuffer(v, "f4" if len(v) == 4 * width else "f8") for v in vecs], "f8")


def leaves(x):
    """An order of the points ``x`` by strips of strips of their widest dimensions, where each leaf begins in it, and the
    lowest and highest corner of each."""
    import numpy as np

    n = len(x)
    wide = np.argsort(x.min(axis=0) - x.max(axis=0), kind="stable")[:SPLIT]
    strips = max(1, round((n / LEAF) ** (1 / len(wide))))
    leaf = np.zeros(n, "i8")
    for d in wide:
        order = np.lexsort((x[:, d], leaf))
        sizes = np.bincount(leaf)
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        leaf[order] = leaf[order] * strips + place * strips // np.repeat(sizes, sizes)
    order = np.argsort(leaf, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], leaf[order[1:]] != leaf[order[:-1]]]))
    return order, begin, np.minimum.reduceat(x[order], begin).astype("f8"), np.maximum.reduceat(x[order], begin).astype("f8")


def near_pairs(x, left, right, limit: float):
    """Numbers of the points of ``left`` and ``right`` whose squared distance is at most ``limit``, or a little more, as pairs
    of arrays; each pair once, where both are the same."""
    import numpy as np

    same = left is right
    if not len(left) or not len(right):
        return
    order, begin, low, high = leaves(x[left])
    left, ends = left[order], np.append(begin, len(order))
    if same:
        right, to, low_right, high_right = left, ends, low, high
    else:
        order, begin, low_right, high_right = leaves(x[right])
        right, to = right[order], np.append(begin, len(order))

    def raised(some, first: bool):
        near = x[some]
        square, one = (near * near).sum(axis=1)[:, None], np.ones((len(some), 1), "f4")
        return np.hstack([-2 * near, square, one]) if first else np.hstack([near, one, square])

    ahead, behind = raised(left, True), raised(right, False)
    for k in range(len(low)):
        gap = np.maximum(np.maximum(low_right - high[k], low[k] - high_right), 0)
        meets = (gap * gap).sum(axis=1) <= limit
        if same:
            meets[:k] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], meets, [False]]).view("i1")))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            for start in range(to[a], to[b], 8 * LEAF):
                end = min(start + 8 * LEAF, to[b])
                hit = np.flatnonzero(ahead[ends[k]:ends[k + 1]] @ behind[start:end].T <= np.float32(limit))
                if len(hit):
                    p, q = hit // (end - start) + ends[k], hit % (end - start) + start
                    if same:
                        p, q = p[p < q], q[p < q]
                    yield left[p], right[q]


def in_cells(rows: DataFrame, cosine: float, blocks: list[int] | None = None) -> DataFrame:
    """``(width, block, cell, row, n, low, vec)`` for each block, or those of ``blocks``, and each grid cell that a vector's box
    touches; ``low`` is the first of those cells."""

    def function(batches):
        from itertools import product

        import numpy as np
        import pyarrow as pa

        turn: dict = {}
        for batch in batches:
            widths = batch.column(batch.schema.get_field_index("width")).to_numpy()
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                part = batch.take(pa.array(at))
                row, n, vec = (part.column(part.schema.get_field_index(c)) for c in ("row", "n", "vec"))
                if width not in turn:
                    turn[width] = rotation(width)
                x = units(opened(vec.to_pylist(), width)) @ turn[width]
                for k, (a, b, budget) in enumerate(layout(width, cosine)):
                    if blocks is not None and k not in blocks:
                        continue
                    low, high = low_cells(x[:, a:b], budget)
                    first = pack(low)
                    for step in product((0, 1), repeat=low.shape[1]):
                        inside = np.flatnonzero((low + step <= high).all(axis=1))
                        if len(inside):
                            some, m = pa.array(inside), len(inside)
                            yield pa.record_batch([pa.array([width] * m, pa.int32()), pa.array([k] * m, pa.int32()), pa.array(pack(low[inside] + step)), row.take(some), n.take(some), pa.array(first[inside]), vec.take(some)],
                                                  names=["width", "block", "cell", "row", "n", "low", "vec"])

    return rows.select("row", "width", "n", "vec").mapInArrow(function, "width int, block int, cell long, row long, n long, low long, vec binary")


def pack(cells):
    """One number for the cells of all grid dimensions."""
    import numpy as np

    out = np.zeros(len(cells), "i8")
    for k in range(cells.shape[1]):
        out = out << 20 | (cells[:, k] + (1 << 19))
    return out


def latest(a, b, grid: int):
    """The greater of two packed cells in each dimension, packed."""
    import numpy as np

    out = np.zeros(len(a), "i8")
    for k in range(grid):
        part = np.int64((1 << 20) - 1 << 20 * k)
        out |= np.maximum(a & part, b & part)
    return out


def rounds(volumes: dict[int, int]) -> list[tuple[list[int], int, int]]:
    """Blocks to work on together, and which of how many shares of their groups: for each round about ROUND_BYTES of what the
    blocks have."""
    out, together, size = [], [], 0
    for block, volume in sorted(volumes.items()):
        if volume > ROUND_BYTES:
            shares = -(-volume // ROUND_BYTES)
            out += [([block], k, shares) for k in range(shares)]
            continue
        if together and size + volume > ROUND_BYTES:
            out.append((together, 0, 1))
            together, size = [], 0
        together, size = [*together, block], size + volume
    return out + [(together, 0, 1)] * bool(together)


def links(rows: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, n)``: for a vector the number of rows that it links with, found in one group (``b`` null), and links
    that connect all that is linked (``n`` null). ``rows`` are different vectors, ``n`` of each."""
    keys = ["width", "block", "cell"]
    most = F.least(F.lit(CELL_ROWS), F.greatest(F.lit(WIDE_ROWS), F.lit(64 * CELL_ROWS) / F.col("width")))
    cells = in_cells(rows, cosine).groupBy(keys).agg(F.count("*").alias("held"))
    cells = materialize(cells.withColumn("parts", F.ceil(F.col("held") / most).cast("int")), "cells")
    volume = F.sum(F.col("held") * F.col("parts") * (4 * F.col("width") + ROW_BYTES))
    volumes = {r["block"]: r["volume"] for r in cells.groupBy("block").agg(volume.alias("volume")).collect()}
    made = [materialize(_links(in_cells(rows, cosine, blocks), cells.where("parts > 1"), cosine, share, shares), "links")
            for blocks, share, shares in rounds(volumes) or [([], 0, 1)]]
    return reduce(DataFrame.unionAll, made)


def _links(sent: DataFrame, split: DataFrame, cosine: float, share: int, shares: int) -> DataFrame:
    """The links of one round, in ``share`` of ``shares`` of its groups. ``split`` has the parts of crowded cells: with the
    default cosine at most BLOCKS times the cells of a cube from -1 to 1, some thousand rows for each width."""
    keys = ["width", "block", "cell"]
    dealt = sent.join(F.broadcast(split.select(*keys, "parts")), keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    dealt = dealt.select(*keys, "row", "n", "low", "vec", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select(*keys, F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "row", "n", "low", "vec")
    if shares > 1:
        dealt = dealt.where(F.pmod(F.xxhash64(*keys, "first", "second", F.lit("round")), F.lit(shares)) == share)

    def function(key, table):
        import numpy as np
        import pyarrow as pa

        width, block, cell, first, second = (k.as_py() for k in key)
        ids, part, n, low = (table.column(c).to_numpy() for c in ("row", "part", "n", "low"))
        given = held([v.as_buffer() for v in table.column("vec")], width)
        plan, turn = layout(width, cosine), rotation(width)
        a, b, budget = plan[block]
        fast, near = np.empty((len(ids), width), "f4"), np.empty((len(ids), b - a), "f4")
        for start in range(0, len(ids), SLICE):
            unit = units(given[start:start + SLICE].astype("f8"))
            fast[start:start + SLICE], near[start:start + SLICE] = unit, unit @ turn[:, a:b]
        left = np.flatnonzero(part == first)
        right = left if first == second else np.flatnonzero(part == second)
        forest, count, edges = Forest(len(ids)), np.zeros(len(ids), "i8"), []
        rotated, done = np.empty((len(ids), width)), np.zeros(len(ids), bool)

        def exact(p, q):
            """Which of the pairs are links that belong to this block and cell."""
            ok = (fast[p] * fast[q]).sum(axis=1) >= cosine - 1e-4
            p, q = p[ok], q[ok]
            ok = latest(low[p], low[q], min(GRID, b - a)) == cell
            p, q = p[ok], q[ok]
            ok = cosines(given[p].astype("f8"), given[q].astype("f8")) >= cosine
            p, q = p[ok], q[ok]
            fresh = np.unique(np.concatenate([p, q]))
            fresh = fresh[~done[fresh]]
            rotated[fresh], done[fresh] = turned(units(given[fresh].astype("f8")), turn), True
            d = rotated[p] - rotated[q]
            d *= d
            ok = d[:, a:b].sum(axis=1) <= budget
            for s, e, limit in plan[:block]:
                ok &= d[:, s:e].sum(axis=1) > limit
            return p[ok], q[ok]

        for p, q in near_pairs(near, left, right, budget * 1.0001 + 1e-5):
            for k in range(0, len(p), 1 << 15):
                u, v = exact(p[k:k + (1 << 15)], q[k:k + (1 << 15)])
                np.add.at(count, u, n[v])
                np.add.at(count, v, n[u])
                edges += forest.add(u, v)
        some = np.flatnonzero(count)
        pairs = ids[np.array(edges, "i8").reshape(-1, 2)]
        give_back()
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table({"a": pa.concat_arrays([pa.array(ids[some]), pa.array(pairs[:, 0])]),
                         "b": pa.concat_arrays([none(len(some)), pa.array(pairs[:, 1])]),
                         "n": pa.concat_arrays([pa.array(count[some]), none(len(pairs))])})

    return dealt.groupBy(*keys, "first", "second").applyInArrow(function, "a long, b long, n long")


def near_duplicates(df: DataFrame, vec: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``df``: the id, ``n_links``, ``component_id`` (the smallest id that links reach)
    and ``kept``, whether that is its own."""
    rows = prepared(df.select(quoted(vec).alias("_id"), quoted(vector)), vector)
    rows = materialize(rows.withColumn("mark", F.when(F.col("vec").isNotNull(), F.sha2(F.concat("vec", F.encode(F.col("width").cast("string"), "utf-8")), 256))), "vectors")
    own = rows.where("mark IS NOT NULL").groupBy("mark").agg(F.min("row").alias("row"), F.min("id").alias("id"), F.count("*").alias("n"), F.first("width").alias("width"), F.first("vec").alias("vec"))
    own = materialize(own, "distinct")
    found = links(own.select("row", "width", "n", "vec"), cosine)
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    groups = components(found.where("n IS NULL").select("a", "b"))
    ids = own.select("row", "id")
    least = groups.join(ids, groups.node == ids.row).groupBy("component").agg(F.min("id").alias("least"))
    least = materialize(least, "least")
    groups = groups.join(least, "component").select(F.col("node").alias("row"), "least")
    # Copies of a vector link with each other too.
    classes = own.select("mark", "row", "n", F.col("id").alias("first_id")).join(counts, "row", "left").join(groups, "row", "left").select(
        "mark", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "first_id").alias("least"))
    classes = materialize(classes, "classes")
    return rows.select("id", "mark").join(classes, "mark", "left").select(
        F.col("id").alias(vec), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("least", "id").alias("component_id"), F.coalesce(F.coalesce("least", "id") == F.col("id"), F.lit(False)).alias("kept"))
