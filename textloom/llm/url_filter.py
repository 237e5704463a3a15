"""URL rules by Bloom filter cascades: exact membership of every key the corpus can ask for, without a join.

A rule is a host and the beginning of a path. It fits that host and its subdomains where the URL's path begins
with the rule's; the longest rule that fits decides. So a URL asks for a few keys: for each shape of a rule
(labels of its host, length of its path) the last labels of the URL's host and the first characters of its path.

Each action has a cascade. Level 1 is a Bloom filter of the listed keys; its false positives among all keys of the
corpus are found in one pass and go into level 2, whose own false positives among the listed keys go into level 3,
and so on until a level has none. A key walks down the levels until one does not hold it: over the whole key
universe of the corpus the answer is exact, and needs no more than the filters' bits, which enter the plan as
literals. Level 1 is sized so that its false positives are about as many as the listed keys, the others at one half.

The bits grow with the number of rules alone. Where one filter would be over ``FILTER_BITS``, the keys are dealt by
a hash to as many shards as are needed, each with its own cascades, and the table is judged shard by shard, written
in between, so that one shard's bits are in a plan at a time. All of it is Spark expressions.

Rows: a URL that is null or has no ``://`` has an empty host and path, and no rule. Repeated rows are judged each.
Other columns pass through; those named like the results are replaced. Rules with a null or empty host, a path that
begins with no slash or an action that is neither ``allow`` nor ``block`` fit nothing; a key listed for both actions
is blocked. What no rule fits has the verdict ``default``. Empty tables give empty ones; without rules all is default.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import let
from textloom.llm.common import quoted, without
from textloom.session import materialize

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_BITS = 1 << 22
"""At most so many bits of one level in a plan."""
LEVELS = 100
"""Filters of different levels are independent: each level holds about half of the one before, so this is never reached."""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, in lower case; and from there
    up to a question mark, hash or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def listed_keys(rules: DataFrame) -> DataFrame:
    """``key, action, labels, length`` of the rules that can fit, each key once."""
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    usable = rules.where(F.col("host").isNotNull() & (F.col("host") != "") & ((path == "") | path.startswith("/")) & F.col("action").isin(ALLOW, BLOCK))
    keys = usable.select(F.concat(host, path).alias("key"), "action", labels(host).alias("labels"), F.length(path).alias("length"))
    return keys.groupBy("key").agg(F.max("action").alias("action"), F.max("labels").alias("labels"), F.max("length").alias("length"))


def asked_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys that a URL asks for, one for each shape it is long enough for."""
    known = F.from_json(F.lit(json.dumps([{"n": n, "c": c} for n, c in shapes])), "array<struct<n:int,c:int>>")
    has = labels(host)
    fits = F.filter(known, lambda s: (s["n"] <= has) & (s["c"] <= F.length(path)))
    return F.transform(fits, lambda s: F.concat(F.call_function("substring_index", host, F.lit("."), -s["n"]), F.left(path, s["c"])))


@dataclass
class Level:
    """One Bloom filter: its words as a text of numbers, and how to probe it."""

    words: str
    size: int
    probes: int
    seed: int

    def places(self, key: Column) -> Column:
        """The bits of a key: two hashes, combined."""
        base = F.pmod(F.xxhash64(F.lit(2 * self.seed), key), F.lit(self.size))
        step = F.pmod(F.xxhash64(F.lit(2 * self.seed + 1), key), F.lit(self.size - 1)) + 1
        return F.struct(base.alias("base"), step.alias("step"))

    def place(self, at: Column, k: int) -> Column:
        return (at["base"] + at["step"] * k) % F.lit(self.size)

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to a literal once

        def probed(at: Column) -> Column:
            found = F.lit(True)
            for k in range(self.probes):
                bit = self.place(at, k)
                found = found & (F.getbit(F.get(words, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1)
            return found

        return let(self.places(key), probed)


def level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """The filter of a table's ``key`` at a false-positive rate."""
    probes = max(1, round(-math.log2(rate)))
    words = max(1, math.ceil(count * probes / math.log(2) / 64))
    made = Level("", 64 * words, probes, seed)
    bits = keys.select(made.places(F.col("key")).alias("at")).select(F.explode(F.array(*[made.place(F.col("at"), k) for k in range(probes)])).alias("bit"))
    set_bits = bits.select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits"))
    all_words = set_bits.unionAll(keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
    by_word = all_words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))  # FILTER_BITS / 64 at most
    made.words = by_word.agg(F.array_join(F.transform(ordered, lambda w: w["bits"].cast("string")), ",")).first()[0]
    return made


@dataclass
class Cascade:
    levels: list[Level]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed: odd levels hold what is listed, even ones what is not."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[k].holds(key), answer).otherwise(F.lit(k % 2 == 1))
        return answer


def cascade(first: Level, listed: DataFrame, passed: DataFrame) -> Cascade:
    """The cascade below a first level; ``passed`` holds the keys of the universe that some first level holds."""
    flagged = passed.where(first.holds(F.col("key"))).select("key", F.lit(0).alias("own")).unionAll(listed.select("key", F.lit(1).alias("own")))
    levels, held = [first], listed.select("key")
    wrong = materialize(flagged.groupBy("key").agg(F.max("own").alias("own")).where("own = 0").select("key"), "wrong")
    while (count := wrong.count()) and len(levels) < LEVELS:
        levels.append(level(wrong, count, 0.5, first.seed + len(levels)))
        held, wrong = wrong, materialize(held.where(levels[-1].holds(F.col("key"))), "wrong")
    if count:
        raise RuntimeError("a cascade has not ended")
    return Cascade(levels)


def build(listed: DataFrame, universe: DataFrame) -> dict[str, Cascade]:
    """A cascade for each action out of ``listed`` (``key, action``), exact on all of ``universe`` (``key``, with
    repeats). The universe is read twice: to size the first levels, and for the keys that they hold."""
    sizes = {r["action"]: r["n"] for r in listed.groupBy("action").agg(F.count("*").alias("n")).collect()}
    asked = universe.agg(F.approx_count_distinct("key")).first()[0]
    firsts = {}
    for k, action in enumerate((ALLOW, BLOCK)):
        n = sizes.get(action, 0)
        if n:
            firsts[action] = level(listed.where(F.col("action") == action), n, min(0.5, math.sqrt(0.5) * n / max(asked, 1)), k * LEVELS)
    if not firsts:
        return {a: Cascade([]) for a in (ALLOW, BLOCK)}
    some = F.lit(False)
    for first in firsts.values():
        some = some | first.holds(F.col("key"))
    passed = materialize(universe.where(some).select("key").distinct(), "passed")
    return {a: cascade(firsts[a], listed.where(F.col("action") == a), passed) if a in firsts else Cascade([]) for a in (ALLOW, BLOCK)}


def _in_shard(shard: int, shards: int) -> Callable[[Column], Column]:
    return lambda key: F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)) == shard if shards > 1 else F.lit(True)


def _judgement(made: dict[str, Cascade]) -> Callable[[Column], Column]:
    """What the cascades say of a key: its length, that of its host, itself, and the verdict, null where it is not listed."""
    def found(key: Column) -> Column:
        verdict = F.when(made[BLOCK].contains(key), BLOCK).when(made[ALLOW].contains(key), ALLOW)
        return F.struct(F.length(key).alias("n"), F.instr(key, "/").alias("h"), key.alias("key"), verdict.alias("verdict"))

    return found


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (the longest that fits, host and path together, null where none does) and
    ``verdict``. ``rules`` has ``host, path, action``. Of equally long rules the one with the longer host counts."""
    listed = materialize(listed_keys(rules), "rules")
    shapes = [tuple(r) for r in listed.select("labels", "length").distinct().orderBy("labels", "length").collect()]
    host, path = host_and_path(quoted(url))
    kept = without(df, "host", "path", "rule", "verdict").columns
    none = F.lit(None).cast("struct<n:int,h:int,key:string,verdict:string>")
    rows = df.select(*[quoted(c) for c in kept], host.alias("host"), path.alias("path"), none.alias("rule"))
    # 64 bits a key are more than any first level takes while the universe has below 2**44 keys.
    shards = max(1, math.ceil(listed.count() * 64 / filter_bits))
    for shard in range(shards):
        own = _in_shard(shard, shards)
        keys = df.select(F.explode(asked_keys(host, path, shapes)).alias("key"))
        made = build(listed.where(own(F.col("key"))).select("key", "action"), keys.where(own(F.col("key"))))
        fits = F.transform(F.filter(asked_keys(F.col("host"), F.col("path"), shapes), own), _judgement(made))
        rows = rows.withColumn("rule", F.greatest("rule", F.array_max(F.filter(fits, lambda r: r["verdict"].isNotNull()))))
        if shards > 1:
            rows = materialize(rows, "judged")
    return rows.select(*[quoted(c) for c in kept], "host", "path", F.col("rule.key").alias("rule"), F.coalesce("rule.verdict", F.lit(default)).alias("verdict"))
