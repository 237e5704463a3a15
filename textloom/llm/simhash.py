"""SimHash near-duplicates, found exactly with vantage-point trees.

Equal fingerprints are one point. Two points within ``radius`` bits agree on one of ``radius + 1`` blocks of
bits, so there is one tree for each block: its root parts the points by that block, where such a pair is at
distance 0. Below the root, a vantage point parts them by Hamming distance on the other bits into shells;
by the triangle inequality a pair's distances differ by at most ``radius``, so a point near a shell's inner
boundary is also sent to the shell within. Shell and block value make a shard; inside a shard, trees of
further vantage points prune in the same way until few points are left to compare.

Rows: a text that is null or has no words has fingerprint zero and links like any other. Repeated rows keep
their rows and share a component. Extra columns pass through; columns named like the results are replaced.
Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, per_text, quoted, without
from textloom.llm.components import Forest, components
from textloom.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
PORTION = 1 << 16
SHELL = 8
RUN = 32
"""Points of a shard that are compared side by side; more go through a vantage-point tree."""


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text's word shingles, as a signed number."""
    from itertools import repeat

    import numpy as np
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z only, and blanks are space and \t to \r
    if not words:
        return 0
    if len(words) < width:
        return int(np.array(xxhash.xxh64_intdigest(b" ".join(words), SEED), "u8").view("i8"))
    n = len(words) - width + 1
    ones = np.zeros(64, "i8")
    for start in range(0, n, PORTION):
        part = words[start:start + PORTION + width - 1]
        count = len(part) - width + 1
        shingles = map(b" ".join, zip(*[part[k:] for k in range(width)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "u8", count)
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i4")
    return int(np.packbits(2 * ones > n, bitorder="little").view("i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint", width: int = SHINGLE) -> DataFrame:
    """Adds the fingerprint, a ``long``."""
    import pyarrow as pa

    return appended(docs, per_text(text, lambda value: (fingerprint(value, width),), lambda r: 8, pa.int64()), (into, T.LongType()))


def _near(x, y, radius):
    import numpy as np

    return np.bitwise_count((x ^ y).view("u8")) <= radius  # of a signed number it would count those of its absolute value


def tree_links(points, radius: int):
    """Links within ``radius`` between the points of one shard, enough to connect all that are linked:
    the edges of a spanning forest. A vantage-point tree; a branch gets the points whose distance allows
    a partner there."""
    import numpy as np

    forest = Forest(len(points))
    out: list[tuple[int, int]] = []

    def compare(members, queries):
        step = max(1, PORTION // max(1, len(members)))
        for k in range(0, len(queries), step):
            part = queries[k:k + step]
            q, m = np.nonzero(_near(points[part][:, None], points[members][None, :], radius))
            out.extend(forest.add(part[q], members[m]))

    work = [(np.arange(len(points)), np.arange(len(points)))]
    while work:
        members, queries = work.pop()
        if not len(members) or not len(queries):
            continue
        if len(members) * len(queries) <= PORTION:
            compare(members, queries)
            continue
        vantage = points[members[len(members) // 2]]
        of_members, of_queries = (np.bitwise_count((points[x] ^ vantage).view("u8")).astype("i2") for x in (members, queries))
        middle = int(np.median(of_members))
        near = of_members <= middle
        if near.all():  # at least half lie on the median: take it out of the nearer part
            middle -= 1
            near = of_members <= middle
        if near.all() or not near.any():
            compare(members, queries)
            continue
        work.append((members[near], queries[of_queries - radius <= middle]))
        work.append((members[~near], queries[of_queries + radius > middle]))
    return out


def _at_shells(shells: Column, tree: int, value: Column) -> Column:
    return F.transform(shells, lambda s: F.struct(F.lit(tree).alias("tree"), value.alias("value"), s.alias("shell")))


def links(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints within ``radius`` bits: all of them in small shards, and
    in any case enough to connect what is linked. ``points`` has distinct fingerprints in ``p``."""
    if not 1 <= radius <= 7:
        raise ValueError("radius must be 1 to 7 bits")
    blocks = radius + 1
    size = -(-64 // blocks)
    rows = []
    for k in range(blocks):
        width = min(size, 64 - k * size)
        mask = ((1 << width) - 1) << k * size
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        value = F.col("p").bitwiseAND(F.lit(mask))
        vantage = F.lit(0x5DEECE66D1CE4E5B)
        distance = F.bit_count(F.col("p").bitwiseXOR(vantage).bitwiseAND(F.lit(~mask)))
        shell = F.floor(distance / SHELL).cast("int")
        shells = F.when((distance % SHELL < radius) & (shell > 0), F.array(shell, shell - 1)).otherwise(F.array(shell))
        rows.append(_at_shells(shells, k, value))
    sent = points.select("p", F.explode(F.concat(*rows)).alias("at")).select("p", "at.tree", "at.value", "at.shell")

    def function(batches):
        import numpy as np
        import pyarrow as pa

        def found(p, key, last):
            """Links of the whole shards in ``p``; and where the last shard, which may go on, begins."""
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(p)]])
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            sizes = ends - starts
            out = []
            small = np.repeat(sizes <= RUN, sizes)
            short, of = p[:len(small)][small], np.repeat(np.arange(len(sizes)), sizes)[small]
            for k in range(1, RUN):
                same = of[k:] == of[:-k]
                if not same.any():
                    break
                hit = np.flatnonzero(same & _near(short[k:], short[:-k], radius))
                out.append(np.stack([short[hit], short[hit + k]]))
            for s, e in zip(starts[sizes > RUN].tolist(), ends[sizes > RUN].tolist()):
                shard = p[s:e]
                pairs = np.array(tree_links(shard, radius), "i8").reshape(-1, 2)
                out.append(np.stack([shard[pairs[:, 0]], shard[pairs[:, 1]]]))
            done = int(ends[-1]) if len(ends) else 0
            return (np.concatenate(out, axis=1) if out else np.zeros((2, 0), "i8")), done

        rest_p, rest_key = np.zeros(0, "i8"), np.zeros(0, "u8")
        for batch in batches:
            tree, value, shell = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("tree", "value", "shell"))
            part = np.right_shift(value.view("u8"), tree.astype("u8") * np.uint64(size))
            key = part << np.uint64(8) | tree.astype("u8") << np.uint64(5) | shell.astype("u8")
            rest_p = np.concatenate([rest_p, batch.column(batch.schema.get_field_index("p")).to_numpy()])
            rest_key = np.concatenate([rest_key, key])
            pairs, done = found(rest_p, rest_key, False)
            rest_p, rest_key = rest_p[done:], rest_key[done:]
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
        if len(rest_p):
            pairs, _ = found(rest_p, rest_key, True)
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    keys = ("tree", "value", "shell")
    return sent.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(function, "a long, b long").distinct()


def with_components(docs: DataFrame, doc: str = "doc_id", mark: str = "fingerprint", radius: int = RADIUS) -> DataFrame:
    """Adds ``component_id``, the smallest ``doc`` among all whose fingerprints can be reached by links, and
    ``component_point``, the smallest of those fingerprints. ``docs`` should be a written table: it is read twice."""
    points = materialize(docs.groupBy(quoted(mark).alias("p")).agg(F.min(quoted(doc)).alias("least")), "points")
    linked = components(links(points.select("p"), radius))
    groups = points.join(linked, points.p == linked.node, "left").select("p", "least", F.coalesce("component", "p").alias("component"))
    smallest = materialize(groups.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    found = groups.join(smallest, "component").select(F.col("p").alias("_point"), "component_id", F.col("component").alias("component_point"))
    found = materialize(found, "groups")
    kept = without(docs, "component_id", "component_point")
    return kept.join(found, kept[mark] == found["_point"], "left").drop("_point")
