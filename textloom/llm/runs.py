"""Periodic runs of words: stretches that repeat with a period, found with a suffix automaton and link-cut access.

The words of a text are appended to a suffix automaton one by one. Its suffix links form a tree in which the states
from the newest prefix up to the root hold all suffixes of what was read. Each state's last occurrence is a colour;
states of one colour that lie on one path are a preferred path of a link-cut tree, kept in a splay tree. Appending
word ``i`` accesses the new state: the walk to the root meets one segment after the other, each with the place ``e``
where its suffixes ended last, then all take the colour ``i``. A segment whose longest suffix has ``m`` words says
that the last ``m + d`` words have period ``d = i - e``, that no smaller one is theirs, and that the word before
would break it: a square, where ``m >= d``, grown to the left as far as it goes. It has grown to the right as far as
it goes when no later access meets the same start and period. Splay trees make this ``O(n log n)`` steps.

A run repeats all its words but those of the first period at the same distance, so its windows of ``GRAM`` words
repeat within half the length of a stretch of such repeats. Only stretches where that holds (numpy, one sort for each
text) are fed to the automaton, each with a margin that holds the whole run and its neighbours; elsewhere there is none.

Memory is in proportion to one text: about 60 bytes for a word, and 300 for a word in a stretch that is fed.

Rows: a text that is null, empty or has few words has no runs and keeps its words. Repeated rows are judged each.
Other columns pass through; those named like the results are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, per_text

LEAST_WORDS = 24
LEAST_EXPONENT = 3
RUN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]))


def repeats(words, least: int, exponent: int) -> dict[tuple[int, int], int]:
    """``(start, period)`` of each run of a list of numbers, and where it ends, exclusive."""
    link, length, to = [0, 0], [0, 0], [{}, {}]  # state 1 is the root, 0 none
    above, left, right, colour = [0, 0], [0, 0], [0, 0], [0, 0]  # splay trees; a colour is that of the root's whole path

    def rotate(x):
        p = above[x]
        g = above[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            above[b] = p
        above[p] = x
        above[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(x):
        root = x
        while (p := above[root]) and (left[p] == root or right[p] == root):
            root = p
        if root == x:
            return
        colour[x] = colour[root]
        top = above[root]
        while (p := above[x]) != top:
            g = above[p]
            if g != top:
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    def state(size):
        link.append(0)
        length.append(size)
        for tree in (above, left, right, colour):
            tree.append(0)
        return len(length) - 1

    found: dict[tuple[int, int], int] = {}
    last = 1
    for i, word in enumerate(words, 1):
        new = state(i)
        to.append({})
        p = last
        while p and word not in to[p]:
            to[p][word] = new
            p = link[p]
        if not p:
            up = 1
        else:
            up = to[p][word]
            if length[up] != length[p] + 1:
                old, up = up, state(length[p] + 1)
                to.append(to[old].copy())
                while p and to[p].get(word) == old:
                    to[p][word] = up
                    p = link[p]
                link[up], link[old] = link[old], up
                splay(old)  # what is split off a state occurred last where that did: it joins its path, right above it
                higher = left[up] = left[old]
                if higher:
                    above[higher] = up
                left[old], above[up] = up, old
        link[new] = above[new] = up
        last = new
        below, x = 0, new
        while x:
            splay(x)
            was = colour[x]
            if right[x]:
                colour[right[x]] = was
            right[x] = below
            if was:
                period, size = i - was, length[x]
                if size >= (exponent - 1) * period and size + period >= least:
                    found[i - size - period, period] = i
            below, x = x, above[x]
        colour[below] = i
    return found


def stretches(ids, least: int, exponent: int) -> list[tuple[int, int]]:
    """Where runs may be: ranges of words that hold every run whole, with a word beside it."""
    import numpy as np

    # A run of period q repeats at least max(least - q, (exponent - 1) q) words at distance q, which is
    # fewest at q = least / exponent.
    gram = max(1, (least - least // exponent) // 2)
    n = len(ids) - gram + 1
    if n < 2:
        return []
    factors = np.random.default_rng(7).integers(0, 1 << 63, gram, dtype="u8") * np.uint64(2) + np.uint64(1)
    marks = np.zeros(n, "u8")
    for k in range(gram):  # equal windows have equal marks; others may, which only adds to what is looked at
        marks += ids[k:k + n].astype("u8") * factors[k]
    order = np.argsort(marks, kind="stable")
    same = marks[order[1:]] == marks[order[:-1]]
    gap = np.zeros(n, "i8")
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    held = gap > 0
    starts = ends = reach = np.zeros(0, "i8")
    for _ in range(8):  # each turn only drops what can be in no run
        edges = np.flatnonzero(np.diff(np.concatenate([[0], held.view("i1"), [0]])))
        starts, ends = edges[::2], edges[1::2]
        covered = ends - starts + gram - 1
        reach = covered // (exponent - 1)  # no period within can be longer
        of = np.repeat(np.arange(len(starts)), ends - starts)
        at = np.flatnonzero(held)
        keep = (gap[at] <= reach[of]) & (covered[of] >= least - least // exponent)
        if keep.all():
            break
        held[at[~keep]] = False
    else:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], held.view("i1"), [0]])))
        starts, ends = edges[::2], edges[1::2]
        reach = (ends - starts + gram - 1) // (exponent - 1)
    out: list[tuple[int, int]] = []
    for s, e in zip((starts - reach - 1).tolist(), (ends + gram).tolist()):
        s, e = max(s, 0), min(e, len(ids))
        while out and out[-1][1] >= s:
            s = min(s, out.pop()[0])
        out.append((s, e))
    return out


def runs_of(words: list, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, in order."""
    import numpy as np

    if len(words) < least:
        return []
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), "i8", len(words))
    return sorted(
        (a + start, end - start, period)
        for a, b in stretches(ids, least, exponent)
        for (start, period), end in repeats(ids[a:b].tolist(), least, exponent).items()
        if end - start >= max(least, exponent * period))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words less those that a run repeats after its first period."""
    import numpy as np

    if not runs:
        return words
    change = np.zeros(len(words) + 1, "i8")
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Adds ``n_words``; ``runs``, all stretches of at least ``least`` words and ``exponent`` periods as
    ``(start, length, period)`` in words, by start and period; and ``collapsed``, the words that no run repeats,
    joined by blanks."""
    import pyarrow as pa

    if least < 4 or exponent < 2:
        raise ValueError("runs have at least four words and two periods")

    def compute(value: str):
        words = value.encode().split()  # bytes: blanks are space and \t to \r
        runs = runs_of(words, least, exponent)
        kept = b" ".join(collapsed(words, runs))
        return len(words), [{"start": s, "length": n, "period": p} for s, n, p in runs], kept.decode()

    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    function = per_text(text, compute, lambda r: 24 * len(r[1]) + len(r[2]), pa.int64(), run, pa.string())
    return appended(df, function, ("n_words", T.LongType()), ("runs", RUN), ("collapsed", T.StringType()))


def greatest(runs: str = "runs") -> Column:
    """The run of the greatest length by period, then the smallest start and period; null where there is none.
    Quotients of numbers below 2**26 are told apart and found equal as doubles."""
    best = F.array_max(F.transform(runs, lambda r: F.struct((r["length"] / r["period"]).alias("of"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run"))))
    return best["run"]


def written(runs: str = "runs") -> Column:
    """Each run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
