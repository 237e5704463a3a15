"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the normalised test items is built on the driver, in shards of at most
``SHARD_WORDS`` words, so each broadcast has a fixed bound; more items mean more passes. The words
of each document run through it, which gives at each word the longest match that ends there.

A window is ``window`` consecutive words of one item; an item with fewer words, but not none, is
one window. Words are maximal runs of digits, letters a-z (after lower-casing A-Z) and anything
beyond ASCII.

Rows: null and empty texts have no words and no hits. Null or empty items have no windows; an item
whose id is null gives hits but is not listed; rows of one id count once. Extra columns pass
through; columns named like the results are replaced. Empty tables give empty or hitless results.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, per_text, quoted

WINDOW = 13
SHARD_WORDS = 200_000
RESULTS = ("n_words", "hit_spans", "hit_items")


def separators() -> bytes:
    """A translation table: A-Z to a-z, all other ASCII that is no word character to a blank."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(table)


class Automaton:
    """All substrings of the items, as states; state 0 is the empty one."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.least = window
        coded = []
        for name, words in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words]
            coded.append((name, ids))
            last = 0
            for w in ids:
                last = self._extend(last, w)
            if ids:
                self.least = min(self.least, len(ids))
        #: Items by the state that stands for one of their windows.
        self.windows: dict[int, set] = {}
        #: Items of fewer words by the state of all their words, and for each state the nearest such state above it.
        self.short: dict[int, set] = {}
        for name, ids in coded:
            state, matched = 0, 0
            for w in ids:
                state, matched = self.advance(state, matched, w)
                if matched >= window:
                    self.windows.setdefault(self.at_window(state), set()).add(name)
            if 0 < len(ids) < window:
                self.short.setdefault(state, set()).add(name)
        self.above = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if up in self.short else self.above[up]

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the strings of ``q`` that come from ``p``."""
        copy = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        state = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return state

    def advance(self, state: int, matched: int, w: int) -> tuple[int, int]:
        """The longest match that ends after ``w``: its state and length."""
        while state and w not in self.step[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.step[state].get(w)
        return (to, matched + 1) if to is not None else (0, 0)

    def at_window(self, state: int) -> int:
        """The state of the last ``window`` words of what matches at ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def hits(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Word spans inside windows, merged, and the items that occur."""
        import numpy as np

        ids = np.fromiter(map(self.words.get, words, [-1] * len(words)), "i8", len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).view("i1")))
        spans: list[list[int]] = []
        items: set = set()
        for first, end in known.reshape(-1, 2).tolist():
            if end - first < self.least:
                continue
            state = matched = 0
            for i, w in enumerate(ids[first:end].tolist(), first):
                state, matched = self.advance(state, matched, w)
                reach = 0
                if matched >= self.window:
                    reach = self.window
                    items |= self.windows[self.at_window(state)]
                if self.short:
                    top = state if state in self.short and matched >= self.length[state] else self.above[state]
                    while top >= 0:
                        reach = max(reach, self.length[top])
                        items |= self.short[top]
                        top = self.above[top]
                if reach:
                    start = i + 1 - reach
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append([start, i + 1])
        return spans, items


def shards(items: DataFrame, item: str, text: str, window: int):
    """Automata of the items, each of a bounded number of words (or of one longer item)."""
    table, part, held = separators(), [], 0
    rows = items.select(quoted(item).cast("string").alias("name"), quoted(text).alias("text"))
    for name, value in rows.distinct().toLocalIterator():
        words = (value or "").encode().translate(table).split()
        if part and held + len(words) > SHARD_WORDS:
            yield Automaton(part, window)
            part, held = [], 0
        part.append((name, words))
        held += len(words)
    yield Automaton(part, window)


def mark(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds ``n_words``; ``hit_spans``, the merged spans of words inside a window, as numbers of
    words from 0, end exclusive; and ``hit_items``, the ids of items with a window in the text, sorted."""
    import pyarrow as pa

    spark = docs.sparkSession
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    table = separators()
    parts = []
    for number, automaton in enumerate(shards(items, item, item_text, window)):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(automaton))

        def compute(value, shared=shared, held=[]):  # noqa: B006  one list for each task
            if not held:
                held.append(cloudpickle.loads(shared.value))
            words = value.encode().translate(table).split()
            spans, found = held[0].hits(words)
            return len(words), [{"start": a, "end": b} for a, b in spans], sorted(x for x in found if x is not None)

        names = [f"_{r}_{number}" for r in RESULTS[1:]]
        function = per_text(text, compute, lambda r: 64 + 16 * len(r[1]) + 32 * len(r[2]), pa.int64(), arrow_span, pa.list_(pa.string()))
        docs = appended(docs, function, ("n_words", T.LongType()), (names[0], span), (names[1], T.ArrayType(T.StringType())))
        parts.append(names)
    spans, found = (F.flatten(F.array(*[quoted(p[k]) for p in parts])) for k in (0, 1))
    if len(parts) > 1:  # spans of several shards may overlap
        ordered = F.array_sort(spans)
        spans = F.aggregate(ordered, F.array().cast(span), lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(s))))
    inner = [n for p in parts for n in p]
    return docs.withColumns({"hit_spans": spans, "hit_items": F.array_sort(F.array_distinct(found))}).drop(*inner)


def n_hit() -> F.Column:
    """Words inside a window, of a table that ``mark`` has made."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def contaminated(words_of_hundred: int = 5) -> F.Column:
    """The coverage limit: a hit, and at least so many words of each hundred inside a window."""
    return (n_hit() > 0) & (n_hit() * 100 >= F.col("n_words") * words_of_hundred)


def cut(df: DataFrame, text: str = "text", least_words: int = WINDOW, into: str = "clean_text") -> DataFrame:
    """Adds the text less each hit span of ``least_words`` words or more: from the first to the
    last character of its words. Texts without such a span stay as they are, null too."""

    def function(batches):
        import re

        import pyarrow as pa

        word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
        for batch in batches:
            made = []
            texts, spans = (batch.column(batch.schema.get_field_index(c)) for c in (text, "hit_spans"))
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                drop = [s for s in spans[i].as_py() or [] if s["end"] - s["start"] >= least_words]
                if value and drop:
                    places = [m.span() for m in word.finditer(value)]
                    kept, at = [], 0
                    for s in drop:
                        kept.append(value[at:places[s["start"]][0]])
                        at = places[s["end"] - 1][1]
                    value = "".join([*kept, value[at:]])
                made.append(value)
            yield pa.record_batch([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, into])

    return appended(df, function, (into, T.StringType()))
