import hashlib
import random
import zlib

import numpy as np
import pytest

from textloom.llm import prefix_trie as P
from textloom.llm.queries import op11_prefix_trie

NAMES = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]


def brute(convs):
    """Rows like those of ``nodes`` out of ``{conv: [(role, text), ...]}``, by dictionaries of prefixes."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {k: 0 for k in members}
    for k in members:
        if k:
            kids[k[:-1]] += 1
    out = []
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k in members:
        cost = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += cost
            leaves[k[:d]] += not kids[k]
    for k, m in members.items():
        own = sorted(c for c in m if len(convs[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    empty = hashlib.sha256(b"").hexdigest()
    return sorted((tuple(r[c] if c != "ends" else r[c] or empty for c in NAMES) for r in df.collect()), key=str)


def convs_frame(spark, convs):
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    named = P.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    empty = [(c, []) for c, turns in convs.items() if not turns]
    return named.unionAll(spark.createDataFrame(empty, named.schema)) if empty else named


def some_convs(seed):
    random.seed(seed)
    convs = {}
    for c in random.sample(range(-50, 5000), random.choice([1, 2, 30, 200])):
        if convs and random.random() < 0.5:
            base = random.choice(list(convs.values()))
            turns = base[:random.randint(0, len(base))]
        else:
            turns = []
        long = random.random() < 0.03
        convs[c] = turns + [(random.choice(["user", "assistant", ""]), random.choice(["", "a", "é", "hello", "user"])) for _ in range(random.randint(0, 100 if long else 4))]
    return convs


@pytest.mark.parametrize("seed", range(6))
def test_nodes_are_those_of_brute_force(spark, seed):
    convs = some_convs(seed)
    frame = convs_frame(spark, convs)
    assert got(P.nodes(frame)) == brute(convs)
    assert got(P.nodes(frame, shard_turns=20)) == brute(convs)


@pytest.mark.parametrize("seed", range(40))
def test_a_shard_alone(seed):
    """Sorting and marking by strips: with edges carried up, one shard gives all nodes."""
    convs = some_convs(seed)
    import pyarrow as pa

    paths = {}
    for c, turns in convs.items():
        path = b"".join(hashlib.sha256(repr(t).encode()).digest()[:16] + len(t[1].encode()).to_bytes(8, "big") for t in turns)
        paths.setdefault(path, []).append(c)
    keys = list(paths)
    random.shuffle(keys)
    ends = [hashlib.sha256(",".join(map(str, sorted(paths[k]))).encode()).hexdigest() for k in keys]
    made = P.shard_nodes(keys, np.array([len(paths[k]) for k in keys]), np.array([min(paths[k]) for k in keys]), ends)
    edge = made["edge"]
    part = {c: made[c][~np.equal(edge, None)] for c in made}
    table = pa.table({c: pa.array(part[c], pa.binary() if c in ("edge", "parent_edge") else pa.string() if c == "ends" else pa.int64()) for c in part})
    up = P._carried_up(table).to_pylist()
    known = {r["edge"]: r["conv"] for r in up}
    empty = hashlib.sha256(b"").hexdigest()
    rows = [tuple(r[c] if c != "ends" else r[c] or empty for c in NAMES) for r in up]
    for i in np.flatnonzero(np.equal(edge, None)):
        r = {c: made[c][i] for c in made}
        r["parent_conv"] = known.get(r["parent_edge"], r["parent_conv"])
        rows.append(tuple(r[c] if c == "ends" and r[c] else empty if c == "ends" else int(r[c]) for c in NAMES))
    assert sorted(rows, key=str) == brute(convs)


def rebuilt(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = op11_prefix_trie(spark, folder)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rebuilt(rows))


def test_query_on_odd_rows(spark, folder):
    rows = [(10, None, None, None), (10, 0, "user", "x"), (11, 0, "", ""), (11, 1, "a", "b"), (12, 5, None, ""), (13, 0, "u", "y" * 100_000), (14, 0, "u", "z"),
            (27, 0, "q", "no base"), (None, 0, "user", "nobody's"), (16, 0, "u", "t")]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS conv", "'x' AS turns", "2 AS path", "3 AS `n`")
    got = sorted(map(tuple, op11_prefix_trie(spark, folder(conversations=df)).collect()), key=str)
    assert got == brute(rebuilt([r for r in rows if r[0] is not None]))
    assert op11_prefix_trie(spark, folder(conversations=spark.createDataFrame([], schema))).count() == 0


def test_repeated_rows_and_ties(spark):
    """Rows of one turn are turns of their own, in the order of role and name whatever the order of the table."""
    rows = [(1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "y"), (2, 0, "a", "y"), (2, 0, "b", "x"), (2, 0, "a", "y")]
    schema = "conv_id long, turn long, role string, text string"
    a, b = (got(P.nodes(P.sequences(spark.createDataFrame(x, schema)))) for x in (rows, rows[::-1]))
    assert a == b == brute({1: [("a", "y"), ("a", "y"), ("b", "x")], 2: [("a", "y"), ("a", "y"), ("b", "x")]})


def test_many_copies_end_in_pieces(spark):
    convs = {c: [("u", "same")] for c in range(-1500, 1500)} | {c: [] for c in range(5000, 5010)}
    assert got(P.nodes(convs_frame(spark, convs))) == brute(convs)
