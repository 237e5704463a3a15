"""Repeated passages of words, by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. Of each document only the words at cover positions,
taken modulo ``PERIOD``, start an anchor: a hash of the ``WINDOW - PERIOD + 1`` words from there. Whatever the
places of two equal windows, some shift below ``PERIOD`` puts both on cover positions, so they share an
anchor. First the anchors that occur twice are found; then only windows around those are hashed in full, and
each window's first occurrence is found. The rest of its occurrences, merged and so extended to any length,
is removed.

Windows are told apart by 96 bits of two hashes that have nothing in common, made of the two halves of each
word's 128-bit hash: where 10**12 windows are compared, two different ones are taken for equal with a chance
of about 10**-5.

Rows: null and empty texts have no words. Rows of one id count as documents in some fixed order; a null
id comes first. One row per row of the table, with no other columns kept. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from textloom.llm.blocks import answer, finish, pack, parts_of, press, send, split_by, spread, to_parts
from textloom.session import materialize

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
"""Every difference modulo PERIOD is one of two cover positions."""
ANCHOR_BITS = 48


def mixed(x, salt: int):
    """64-bit numbers, well mixed."""
    import numpy as np

    x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


class Words:
    """The words of a block: the two halves of their hashes, the document of each and their place in it."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        from itertools import chain

        import numpy as np
        import xxhash

        self.texts = [t.split() for _, t in rows]  # bytes: blanks are space and \t to \r
        self.count = np.array([len(w) for w in self.texts], "i8")
        self.size = int(self.count.sum())
        halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, chain.from_iterable(self.texts))), "u8").reshape(-1, 2)
        self.hash, self.other = halves[:, 0].copy(), halves[:, 1].copy()
        self.first = np.cumsum(self.count) - self.count  # of each document; its words end where the next one's begin
        self.doc = np.repeat(np.arange(len(rows)), self.count)
        self.place = np.arange(self.size) - self.first[self.doc]

    def windows(self, width: int, salt: int, at, other: bool = False):
        """Hashes of the ``width`` words from each of the places ``at``, out of one half or the other of their own."""
        import numpy as np

        words = mixed(self.other if other else self.hash, salt)
        out = np.zeros(len(at), "u8")
        for k in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + words[at + k]
        return mixed(out, salt)

    def starts(self, width: int):
        """The words with ``width - 1`` words of their document after them."""
        import numpy as np

        return np.flatnonzero(self.place + width <= self.count[self.doc]) if self.size else np.zeros(0, "i8")

    def anchors(self):
        """Places of the anchors, and their hashes."""
        import numpy as np

        width = WINDOW - PERIOD + 1
        at = self.starts(width)
        at = at[np.isin(self.place[at] % PERIOD, COVER)]
        return at, self.windows(width, 2, at) >> np.uint64(64 - ANCHOR_BITS) << np.uint64(64 - ANCHOR_BITS)


def merged(replies, count: int = 1):
    """The arrays of all replies to a block, joined."""
    import numpy as np

    parts = [spread(r) for r in replies]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, "u8") for k in range(count)]


def member(values, known):
    """Which ``values`` are in ``known``."""
    import numpy as np

    if not len(known):
        return np.zeros(len(values), bool)
    known = np.sort(known)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def repeated_keys(rows):
    """Of sorted keys, each with whether its block has it twice, those that occur twice anywhere."""
    import numpy as np

    found = [spread(data) for _, data in rows]
    keys = np.concatenate([k for k, _ in found])
    often = np.concatenate([o for _, o in found])
    unique, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    twice = n > 1
    twice[at[often > 0]] = True
    start = 0
    for (block, _), (own, _) in zip(rows, found):
        mine = own[twice[at[start:start + len(own)]]]
        start += len(own)
        if len(mine):
            yield block, press(mine)


def owned_elsewhere(rows):
    """For each block the windows that occur earlier in another one."""
    import numpy as np

    found = [spread(data) for _, data in rows]
    high, low, doc = (np.concatenate([f[k] for f in found]) for k in range(3))
    block = np.repeat(np.arange(len(rows)), [len(f[0]) for f in found])
    order = np.lexsort((block, doc, low, high))
    new = np.concatenate([[True], (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])]) if len(order) else np.zeros(0, bool)
    other = np.sort(order[~new])
    cuts = np.searchsorted(block[other], np.arange(len(rows) + 1))
    for k, (number, _) in enumerate(rows):
        mine = other[cuts[k]:cuts[k + 1]]
        if len(mine):
            yield number, press(high[mine], low[mine])


def same_as_before(high, low):
    """Of windows in the order of their places, which have occurred before."""
    import numpy as np

    order = np.lexsort((np.arange(len(high)), low, high))
    out = np.zeros(len(high), bool)
    if len(order):
        out[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    return out


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, n_words, n_removed, kept)``: the words left, joined by blanks."""
    parts = parts_of(docs)
    blocks = materialize(pack(docs, doc, text), "blocks")

    def say_anchors(rows, _):
        import numpy as np

        keys, n = np.unique(Words(rows).anchors()[1], return_counts=True)
        part = to_parts(keys, parts)
        for number, (k, often) in split_by(part, np.arange(len(keys)), keys, (n > 1).astype("u1")):
            yield number, press(k, often)

    anchors = materialize(answer(send(blocks, say_anchors), repeated_keys), "anchors")

    def say_windows(rows, replies):
        import numpy as np

        words = Words(rows)
        at, keys = words.anchors()
        at = at[member(keys, merged(replies)[0])]
        near = np.zeros(words.size + 1, "i4")
        np.add.at(near, np.maximum(at - PERIOD + 1, words.first[words.doc[at]]), 1)
        np.add.at(near, at + 1, -1)
        windows = words.starts(WINDOW)
        windows = windows[np.cumsum(near)[windows] > 0]
        high, low = words.windows(WINDOW, 3, windows), (words.windows(WINDOW, 4, windows, other=True) >> np.uint64(32)).astype("u4")
        first = ~same_as_before(high, low)
        windows, high, low = windows[first], high[first], low[first]
        ids = np.array([-(1 << 63) if d is None else d for d, _ in rows], "i8")[words.doc[windows]]
        part = to_parts(high, parts)
        for number, arrays in split_by(part, np.lexsort((high, part)), high, low, ids):
            yield number, press(*arrays)

    owners = materialize(answer(send(blocks, say_windows, anchors), owned_elsewhere), "owners")

    def cut(rows, replies):
        from itertools import compress

        import numpy as np

        words = Words(rows)
        windows = words.starts(WINDOW)
        high, low = words.windows(WINDOW, 3, windows), (words.windows(WINDOW, 4, windows, other=True) >> np.uint64(32)).astype("u4")
        known = merged(replies, 2)
        gone = same_as_before(high, low)
        some = np.flatnonzero(member(high, known[0]))
        if len(some):  # the first hash alone can be that of another window
            pairs = np.unique(np.rec.fromarrays([known[0], known[1].astype("u4")]))
            mine = np.rec.fromarrays([high[some], low[some]], dtype=pairs.dtype)
            gone[some[np.isin(mine, pairs)]] = True
        marks = np.zeros(words.size + 1, "i4")
        gone = windows[gone]
        marks[gone] += 1
        np.add.at(marks, gone + WINDOW, -1)
        keep = np.cumsum(marks)[:-1] == 0
        for (key, _), text, start, count in zip(rows, words.texts, words.first.tolist(), words.count.tolist()):
            left = list(compress(text, keep[start:start + count].tolist()))
            yield key, count, count - len(left), b" ".join(left).decode()

    return finish(blocks, owners, cut, f"{doc} long, n_words long, n_removed long, kept string")
