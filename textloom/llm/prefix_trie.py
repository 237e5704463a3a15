"""The prefix trie of conversations: what turns they begin with in common, and what a cache of prefixes would save.

A turn is named by 128 bits of the SHA-256 of its role and text, beside the bytes of its text; a conversation is the
sequence of its turns' names, its path. Equal paths are one row with a count, made before anything else, so a group of
copies, however large, is one row of the trie. Paths are dealt to shards by range, so that those with a common
beginning are neighbours. A shard numbers its turns, pads the paths to matrices of ``STRIP`` columns, sorts them with
``numpy.lexsort``, and marks where a path differs from the one above it; OR-accumulated over the columns, the marks
are where the nodes of each depth start, and ``reduceat`` sums up every depth.

A node is whole within one shard unless it lies on the path of the shard's first or last row. Those are given as
parts: two paths for each shard at most. The parts of a node are added up by Spark, and one small group of these nodes
alone (two for each shard and depth at most, whatever the number of conversations) carries the sums up the tree.

The ids that end at a node are joined in pieces of ``PIECE`` numbers and hashed piece after piece, so that the hash of a
large group is taken in constant memory. Texts are never gathered: a conversation must fit in memory as 24 bytes a turn.

Rows: a null role or text counts as empty, a null turn comes first, rows of one turn go by role, then by name. Rows
without a conversation id belong to none and are left out. A conversation may have no turns: it ends at the root. Other
columns are not kept. Without conversations there is no node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import give_back, quoted
from textloom.session import materialize

STRIP = 32
"""Columns of a matrix: longer paths go on in the next strip, without the rows that have ended."""
SHARD_TURNS = 200_000
PIECE = 512
TURN_BYTES = 24


def turn_name(role: Column, text: Column) -> Column:
    """48 hexadecimal digits: 128 bits of the hash of a turn, and the bytes of its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(F.encode(both, "utf-8"), 256), 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turns)``: the names of each conversation's turns in order."""
    at = quoted(turn)
    key = F.struct(at.isNotNull().alias("given"), at.alias("turn"), F.coalesce(quoted(role), F.lit("")).alias("role"), turn_name(quoted(role), quoted(text)).alias("name"))
    rows = rows.where(quoted(conv).isNotNull()).select(quoted(conv).cast("long").alias("conv"), key.alias("turn"))
    return rows.groupBy("conv").agg(F.transform(F.array_sort(F.collect_list("turn")), lambda t: t["name"]).alias("turns"))


def distinct_paths(convs: DataFrame) -> DataFrame:
    """``(path, n, least, ends)`` of ``(conv, turns)``: each path once, with its conversations' number, smallest id
    and the hash of their ids in order."""
    rows = convs.select("conv", F.unhex(F.array_join("turns", "")).alias("path"))
    pieces = rows.groupBy("path", F.expr(f"conv div {PIECE}").alias("piece")).agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def joined(batches):
        import hashlib

        import pyarrow as pa

        now, hasher, n, least = None, None, 0, 0
        for batch in batches:
            out = []
            for path, more, low, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("path", "n", "least", "ids"))):
                if path != now:
                    if hasher is not None:
                        out.append((now, n, least, hasher.hexdigest()))
                    now, hasher, n, least = path, hashlib.sha256(ids.encode()), more, low
                else:
                    hasher.update(b"," + ids.encode())
                    n += more
                    least = min(least, low)
            yield _batch(pa, out)
        if hasher is not None:
            yield _batch(pa, [(now, n, least, hasher.hexdigest())])
        give_back()

    # The hash of a path's ids is one sequence by nature; its pieces stream through one task.
    dealt = pieces.repartition("path").sortWithinPartitions("path", "piece")
    return dealt.mapInArrow(joined, "path binary, n long, least long, ends string")


def _batch(pa, rows):
    kinds = (("path", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string()))
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[c for c, _ in kinds])


def lexsorted(turns, start, lens):
    """The order of the paths, the shorter of two first, by ``lexsort`` of one strip of columns after the other."""
    import numpy as np

    rank = np.zeros(len(lens), "i8")  # where the group of equal beginnings starts
    for off in range(0, int(lens.max(initial=0)), STRIP):
        some = np.flatnonzero(lens > off)
        matrix = padded(turns, start[some], lens[some], off)
        sort = np.lexsort((*matrix.T[::-1], rank[some]))
        some, matrix = some[sort], matrix[sort]
        group = rank[some]
        held = np.bincount(rank, minlength=len(rank)) - np.bincount(group, minlength=len(rank))
        place = np.arange(len(some))
        new = np.ones(len(some), bool)
        new[1:] = (group[1:] != group[:-1]) | (matrix[1:] != matrix[:-1]).any(axis=1)
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank[some] = (group + held[group] + place - np.searchsorted(group, group))[head]  # paths that have ended come first
    return np.argsort(rank, kind="stable")


def padded(turns, start, lens, off):
    """The turns from ``off`` on as a matrix of at most ``STRIP`` columns, -1 where a path has ended."""
    import numpy as np

    across = np.arange(off, min(off + STRIP, int(lens.max())))
    inside = across < lens[:, None]
    matrix = np.full(inside.shape, -1, turns.dtype)
    matrix[inside] = turns[(start[:, None] + across)[inside]]
    return matrix


def columns_of(turns, start, lens):
    """For each depth from 1 on: the rows of sorted paths that reach it, and which of those start a node."""
    import numpy as np

    differs = np.zeros(len(lens), "i8")  # how often the beginning has changed, down the rows
    for off in range(0, int(lens.max(initial=0)), STRIP):
        some = np.flatnonzero(lens > off)
        matrix = padded(turns, start[some], lens[some], off)
        mask = np.ones(matrix.shape, bool)
        mask[1:] = matrix[1:] != matrix[:-1]
        mask[1:, 0] |= differs[some][1:] != differs[some][:-1]
        mask = np.logical_or.accumulate(mask, axis=1)
        for k in range(matrix.shape[1]):
            within = lens[some] > off + k
            yield some[within], np.flatnonzero(mask[within, k])
        differs = np.zeros(len(lens), "i8")
        differs[some] = mask[:, -1]
        differs = np.cumsum(differs)


KINDS = (("conv", "long"), ("depth", "long"), ("parent_conv", "long"), ("n_convs", "long"), ("n_children", "long"), ("n_leaves", "long"),
         ("saved", "long"), ("ends", "string"), ("edge", "binary"), ("parent_edge", "binary"), ("turn_bytes", "long"), ("held_bytes", "long"))
NODES = ", ".join(f"{c} {kind}" for c, kind in KINDS)


def shard_nodes(paths: list[bytes], counts, least, ends):
    """The nodes of a shard's distinct paths as columns named in ``KINDS``. A node on the path of the first or last
    row has an ``edge``, the hash of its path, and is a part: its leaves and children are those that are no such
    nodes, ``saved`` counts all occurrences of its subtree's turns, ``held_bytes`` one for each whole node of it."""
    import hashlib

    import numpy as np

    lens = np.array([len(p) // TURN_BYTES for p in paths], "i8")
    cells = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 3)
    high, low, size = (cells[:, k].astype("u8") for k in range(3))
    size = size.astype("i8")
    by_name = np.lexsort((low, high))
    fresh = np.ones(len(by_name), bool)
    fresh[1:] = (high[by_name][1:] != high[by_name][:-1]) | (low[by_name][1:] != low[by_name][:-1])
    turns = np.empty(len(by_name), "i8")
    turns[by_name] = np.cumsum(fresh) - 1
    start = np.concatenate([[0], np.cumsum(lens)])[:-1]

    order = lexsorted(turns, start, lens)
    paths, ends = [paths[k] for k in order], [ends[k] for k in order]
    lens, start, counts, least = lens[order], start[order], counts[order], least[order]
    rows = len(paths)
    leaf = np.array([not b.startswith(a) for a, b in zip(paths, paths[1:])] + [True], "i8")
    leaf[[0, -1]] = 0  # these end at edge nodes
    sums = np.concatenate([[0], np.cumsum(size)])
    total = sums[start + lens] - sums[start]

    def keys(path):
        hasher, out = hashlib.sha256(), []
        for at in range(0, len(path) + 1, TURN_BYTES):
            out.append(hasher.digest())
            hasher.update(path[at:at + TURN_BYTES])
        return out

    first_keys, last_keys = keys(paths[0]), keys(paths[-1])
    levels = [(np.arange(rows), np.zeros(1, "i8")), *columns_of(turns, start, lens)]
    fresh_bytes = np.zeros(rows, "i8")  # of the nodes that start in a row
    edge_bytes = np.zeros(rows, "i8")  # of those that are edge nodes
    for depth, (at, starts) in enumerate(levels[1:], 1):
        heads = at[starts]
        fresh_bytes[heads] += size[start[heads] + depth - 1]
        on_edge = {heads[0]} if at[0] == 0 else set()
        on_edge |= {heads[-1]} if at[-1] == rows - 1 else set()
        for head in on_edge:
            edge_bytes[head] += size[start[head] + depth - 1]
    whole_bytes = fresh_bytes - edge_bytes

    out: dict[str, list] = {c: [] for c, _ in KINDS}
    before = np.zeros(rows, "i8")  # bytes of the turns above a depth
    owner = np.zeros(rows, "i8")
    held: dict | None = None

    def emit(level, children):
        level["n_children"] = children
        for c, _ in KINDS:
            out[c].append(level[c])

    for depth, (at, starts) in enumerate(levels):
        heads, n = at[starts], len(starts)
        rest = total - before
        edge = np.full(n, None, object)
        if at[0] == 0:
            edge[0] = first_keys[depth]
        if at[-1] == rows - 1:
            edge[-1] = last_keys[depth]
        whole = np.equal(edge, None)
        saved = np.add.reduceat(counts[at] * rest[at], starts)
        saved[whole] -= (np.add.reduceat(fresh_bytes[at], starts) - fresh_bytes[heads] + rest[heads])[whole]
        parent = owner[heads] if depth else np.zeros(1, "i8")
        if held is not None:
            emit(held, np.bincount(parent[whole], minlength=len(held["conv"])))
        own_bytes = size[start[heads] + depth - 1] if depth else np.zeros(1, "i8")
        stop = lens[heads] == depth
        held = {
            "conv": np.minimum.reduceat(least[at], starts), "depth": np.full(n, depth),
            "parent_conv": np.where(depth, held["conv"][parent], 0) if held else np.zeros(1, "i8"),
            "n_convs": np.add.reduceat(counts[at], starts), "n_leaves": np.add.reduceat(leaf[at], starts), "saved": saved,
            "ends": np.array([ends[h] if s else None for h, s in zip(heads.tolist(), stop.tolist())], object), "edge": edge,
            "parent_edge": held["edge"][parent] if held else np.full(1, None, object), "turn_bytes": own_bytes,
            "held_bytes": np.where(whole, 0, np.add.reduceat(whole_bytes[at], starts)),
        }
        before[at] += size[start[at] + depth - 1] if depth else 0
        owner = np.full(rows, -1)
        owner[at] = np.cumsum(np.bincount(starts, minlength=len(at))) - 1
    emit(held, np.zeros(len(held["conv"]), "i8"))
    return {c: np.concatenate(out[c]) for c, _ in KINDS}


def _kernel(batches):
    import numpy as np
    import pyarrow as pa

    columns: dict[str, list] = {c: [] for c in ("path", "n", "least", "ends")}
    for batch in batches:
        for c, values in columns.items():
            values += batch.column(batch.schema.get_field_index(c)).to_pylist()
    if columns["path"]:
        made = shard_nodes(columns["path"], np.array(columns["n"], "i8"), np.array(columns["least"], "i8"), columns["ends"])
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        yield pa.record_batch([pa.array(made[c], kinds[kind]) for c, kind in KINDS], names=[c for c, _ in KINDS])
    give_back()


def _carried_up(table):
    """The edge nodes made whole: leaves, children and bytes of edge nodes below added to each."""
    import numpy as np
    import pyarrow as pa

    keys = {k: i for i, k in enumerate(table.column("edge").to_pylist())}
    parent = np.array([keys.get(k, -1) for k in table.column("parent_edge").to_pylist()], "i8")
    values = {c: table.column(c).to_numpy().astype("i8") for c in ("conv", "depth", "n_convs", "n_children", "n_leaves", "saved", "held_bytes", "turn_bytes")}
    below = np.flatnonzero(parent >= 0)
    children = values["n_children"] + np.bincount(parent[below], minlength=len(parent))
    leaves, once = (children == 0).astype("i8"), values["turn_bytes"].copy()
    for depth in range(int(values["depth"].max()), 0, -1):
        at = np.flatnonzero(values["depth"] == depth)
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(once, parent[at], once[at])
    up = pa.array(values["conv"][parent], mask=parent < 0)
    return pa.table({"edge": table.column("edge"), "conv": values["conv"], "depth": values["depth"], "parent_conv": up, "n_convs": values["n_convs"],
                     "n_children": children, "n_leaves": values["n_leaves"] + leaves, "saved": values["saved"] - values["held_bytes"] - once, "ends": table.column("ends")})


def nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``(conv, turns)``: ``conv`` (the smallest member), ``depth``, ``parent_conv``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved`` and ``ends`` (null where no member ends)."""
    spark = convs.sparkSession
    paths = materialize(distinct_paths(convs), "paths")
    total = paths.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (TURN_BYTES * shard_turns)))
    found = materialize(paths.repartitionByRange(shards, "path").mapInArrow(_kernel, NODES), "nodes")
    parts = found.where("edge IS NOT NULL").groupBy("edge").agg(
        F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.first("parent_edge").alias("parent_edge"), F.first("turn_bytes").alias("turn_bytes"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "held_bytes")])
    result = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    edges = parts.groupBy(F.lit(0).alias("all")).applyInArrow(
        _carried_up, "edge binary, conv long, depth long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long, ends string")
    edges = materialize(edges, "edges")
    whole = found.where("edge IS NULL").alias("w").join(edges.select(F.col("edge").alias("parent_edge"), F.col("conv").alias("up")), "parent_edge", "left")
    return whole.withColumn("parent_conv", F.coalesce("up", "parent_conv")).select(*result).unionAll(edges.select(*result))
