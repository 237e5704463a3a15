"""Repeated byte strings, by a distributed merge sort of suffixes that never compares a prefix twice.

A string of ``LENGTH`` bytes starts a window. Each window has one anchor, the least hashed run of ``SEED``
bytes in it, so equal windows have their anchors at the same offset and only suffixes at anchors need sorting:
about two in ``LENGTH - SEED`` places. A block first says which anchor strings it has; those of one document only
can share no window. For the others it sorts their suffixes (what the anchor's windows hold to its right, then what
they hold to its left), each once with its smallest document, front-codes the run (length of the prefix shared
with the suffix before, and the rest) and sends each key range where it is merged: a loser tree keeps for each
run how much it shares with the last suffix put out, so runs that differ there are told apart without looking at
them, and others from there on only. The longest common prefixes that come out mark the suffixes that can share
windows; those windows are compared in full.

Rows: null and empty texts have no bytes. Strings in a row of the same id do not count, a null id is smaller than
any. One row per row of the table, with no other columns kept. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from textloom.llm.blocks import answer, finish, pack, parts_of, press, send, split_by, spread, to_parts
from textloom.llm.passages import member, merged, mixed, repeated_keys
from textloom.session import materialize

LENGTH = 50
SEED = 16
LEFT = LENGTH - SEED
WIDE = LENGTH + LEFT + 2
"""A suffix: LENGTH bytes to the right and LEFT to the left, those outside the anchor's windows as zeros, and how
many of each are inside."""
SAMPLES = 32
"""Places of the order that each block tells, to cut it in ranges."""
PLACES = 1 << 19
"""So many bytes of a block are searched for anchors at a time."""
PLACE_BITS = 20
MERGED = 1 << 17
"""About so many suffixes of a range are merged at a time, more where more begin with the same SEED bytes."""
SAMPLED = 64
PART_BLOCKS = 2
"""No range is for more than the suffixes of so many blocks on average."""


class Bytes:
    """The windows and anchors of a block."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        import numpy as np

        pad = bytes(LENGTH)
        text = self.text = np.frombuffer(pad + b"".join(t + b"\0" for _, t in rows) + pad, "u1")
        sizes = np.array([len(t) for _, t in rows], "i8")
        ends = LENGTH + np.cumsum(sizes + 1) - 1
        self.first, self.sizes = ends - sizes, sizes
        self.ids = np.array([-(1 << 63) if d is None else d for d, _ in rows], "i8")
        windows = self.first, ends - LENGTH + 1  # from the first that starts in a document to behind the last
        found = [self._anchors(start, min(start + PLACES, len(text) - LENGTH), *windows) for start in range(LENGTH, len(text) - LENGTH, PLACES)]
        anchor, begin, last, key, head = (np.concatenate([np.zeros(0, kind), *[f[k] for f in found]]) for k, kind in enumerate(("i8", "i8", "i8", "u8", "u8")))
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (begin[1:] != last[:-1] + 1)])[:len(anchor)]  # where slices meet, the two may be one
        begun = np.flatnonzero(new)
        self.anchor, self.key, self.head = anchor[begun], key[begun], head[begun]  # the head: the eight bytes from the anchor, as a number
        self.far, self.near = self.anchor - begin[begun], self.anchor - last[np.append(begun[1:], len(new))[:len(begun)] - 1]  # from the windows' first bytes to the anchor
        self.doc = np.searchsorted(ends, self.anchor)

    def _anchors(self, start, end, first, behind):
        """Of the windows that begin at the places ``start`` to ``end``: the anchors, the first and last window of each, their
        hashes and the eight bytes there."""
        import numpy as np

        some = slice(np.searchsorted(behind, start, side="right"), np.searchsorted(first, end))
        first, behind = first[some], behind[some]
        long = behind > first
        edges = np.zeros(end - start + 1, "i4")
        edges[np.clip(first[long], start, end) - start] += 1
        edges[np.clip(behind[long], start, end) - start] -= 1
        place = np.flatnonzero(np.cumsum(edges[:-1], dtype="i4"))
        if not len(place):
            return tuple(np.zeros(0, kind) for kind in ("i8", "i8", "i8", "u8", "u8"))
        x = self.text[start:end + LENGTH - 1].astype("u8")
        for step in (1, 2, 4):
            x = x[:-step] << np.uint64(8 * step) | x[step:]
        hashed = mixed(x[:-8] ^ mixed(x[8:], 5), 6)
        bits = np.uint64(PLACE_BITS)
        least = hashed >> bits << bits | np.arange(len(hashed), dtype="u8")
        width = LENGTH - SEED + 1
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
        of = (least[place] & (np.uint64(1) << bits) - np.uint64(1)).astype("i8")
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)]))
        last = np.append(new[1:], len(place)) - 1
        return of[new] + start, place[new] + start, place[last] + start, hashed[of[new]], x[of[new]]

    def suffixes(self, some):
        """The suffixes of the anchors with numbers ``some``, one row of WIDE bytes each."""
        import numpy as np

        out = np.zeros((len(some), WIDE), "u1")
        step = 1 << 14
        for start in range(0, len(some), step):
            part = some[start:start + step]
            to = out[start:start + step]
            at = self.anchor[part][:, None]
            right, left = LENGTH - self.near[part], self.far[part]
            k = np.arange(LENGTH)
            to[:, :LENGTH] = np.where(k < right[:, None], self.text[at + k], 0)
            k = np.arange(LEFT)
            to[:, LENGTH:LENGTH + LEFT] = np.where(k < left[:, None], self.text[at - 1 - k], 0)
            to[:, -2], to[:, -1] = right, left
        return out


def names(suffixes):
    """A 64-bit name for each suffix."""
    import numpy as np

    out = np.zeros(len(suffixes), "u8")
    for k in range(WIDE):
        out = (out + suffixes[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(31)
    return mixed(out, 7)


def front_code(suffixes):
    """Of sorted different suffixes, what each shares with the one before, and the rest of all."""
    import numpy as np

    shared = np.zeros(len(suffixes), "u1")
    if len(suffixes) > 1:
        shared[1:] = (suffixes[1:] != suffixes[:-1]).argmax(axis=1)
    return shared, suffixes[np.arange(WIDE) >= shared[:, None]]


class Run:
    """Front-coded suffixes, decoded up to one key after another."""

    def __init__(self, shared, rest):
        self.shared, self.data = shared.tobytes(), rest.tobytes()
        self.rewind()

    def rewind(self) -> None:
        self.next, self.at, self.before = 0, 0, b""

    def take(self, until: bytes | None = None) -> tuple[list[bytes], bytes]:
        """The suffixes before ``until`` that were not taken yet, and what each shares with the one before."""
        out, shared, data = [], self.shared, self.data
        k, at, before = self.next, self.at, self.before
        while k < len(shared):
            s = shared[k]
            end = at + WIDE - s
            value = before[:s] + data[at:end]
            if until is not None and value >= until:
                break
            out.append(value)
            k, at, before = k + 1, end, value
        some = shared[self.next:k]
        self.next, self.at, self.before = k, at, before
        return out, some


def decode(shared, rest) -> list[bytes]:
    """The suffixes again."""
    return Run(shared, rest).take()[0]


def portions(runs: list[Run]) -> list[bytes | None]:
    """Keys of SEED bytes that cut all suffixes of the runs in portions of about MERGED, and a last one without end. Suffixes
    that begin alike stay together."""
    sample, seen = [], 0
    if sum(len(r.shared) for r in runs) > MERGED:
        for run in runs:
            items = run.take()[0]
            run.rewind()
            sample += [x[:SEED] for x in items[-seen % SAMPLED::SAMPLED]]
            seen += len(items)
        sample.sort()
    step = max(1, MERGED // SAMPLED)
    return [*sorted(set(sample[step::step])), None]


def merge(runs: list[tuple[list[bytes], list[int] | bytes]]):
    """The order of all suffixes of sorted runs: the run of each, and how much it shares with the one before.

    ``know[r]`` is what the head of run ``r`` shares with the last suffix put out. Of two heads the one that
    shares more comes first, and the other's number stays right; only heads that share equally much are
    compared, from there on.
    """
    count = len(runs)
    leaves = 1
    while leaves < count:
        leaves *= 2
    place = [0] * leaves
    head: list[bytes | None] = [run[0][0] if run[0] else None for run in runs] + [None] * (leaves - count)
    know = [0] * leaves
    from_bytes = int.from_bytes

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None or know[b] > know[a]:
            return b, a
        if know[a] > know[b]:
            return a, b
        known = know[a]
        x, y = x[known:], y[known:]
        differ = from_bytes(x) ^ from_bytes(y)
        if not differ:
            low, high = (a, b) if a < b else (b, a)
            know[high] = WIDE
            return low, high
        shared = known + len(x) - (differ.bit_length() + 7) // 8
        if x < y:
            know[b] = shared
            return a, b
        know[a] = shared
        return b, a

    loser = [0] * leaves
    winners = list(range(leaves))
    level = leaves
    while level > 1:
        level //= 2
        next_winners = []
        for k in range(level):
            won, lost = play(winners[2 * k], winners[2 * k + 1])
            loser[level + k] = lost
            next_winners.append(won)
        winners = next_winners
    top = winners[0]
    order, shares = [], []
    while head[top] is not None:
        order.append(top)
        shares.append(know[top])
        items, lcps = runs[top]
        at = place[top] = place[top] + 1
        if at < len(items):
            head[top] = items[at]
            know[top] = lcps[at]
        else:
            head[top] = None
        node = (leaves + top) >> 1
        while node:
            other = loser[node]
            x, y = head[top], head[other]
            if y is not None:
                if x is None or know[other] > know[top]:
                    loser[node] = top
                    top = other
                elif know[other] == know[top]:
                    top, loser[node] = play(top, other)
            node >>= 1
    return order, shares


def shared_windows(suffixes, least, shares):
    """For each of the sorted different suffixes, as bits, the offsets of the windows that a suffix with a smaller
    document has too."""
    import numpy as np

    out = np.zeros(len(suffixes), "u8")
    after = np.append(shares[1:], 0)
    reach = np.minimum(np.maximum(np.where(shares >= SEED, shares, 0), np.where(after >= SEED, after, 0)), LENGTH)
    low = np.maximum(LENGTH - suffixes[:, -2].astype("i8"), LENGTH - reach)
    high = np.where(reach > 0, suffixes[:, -1].astype("i8"), -1)
    for offset in range(LEFT + 1):  # equal windows have their anchors at the same offset
        who = np.flatnonzero((low <= offset) & (offset <= high))
        if not len(who):
            continue
        windows = np.empty((len(who), LENGTH), "u1")
        windows[:, :LENGTH - offset] = suffixes[who, :LENGTH - offset]
        windows[:, LENGTH - offset:] = suffixes[who, LENGTH:LENGTH + offset]
        kinds = np.unique(windows.view(f"S{LENGTH}").ravel(), return_inverse=True)[1]
        best = np.full(kinds.max() + 1, np.iinfo("i8").max)
        np.minimum.at(best, kinds, least[who])
        out[who[best[kinds] < least[who]]] |= np.uint64(1 << offset)
    return out


def marked(runs: list[tuple[list[bytes], bytes]], docs):
    """Of suffixes of sorted runs, given with the smallest document of each in the runs' order: their bytes, and as bits the
    offsets of the windows that a smaller document has."""
    import numpy as np

    order, shares = merge(runs)
    order, shares = np.array(order, "i4"), np.array(shares, "u1")
    text = np.frombuffer(b"".join(x for items, _ in runs for x in items), "u1").reshape(-1, WIDE)
    by_run = np.argsort(order, kind="stable")  # the places of each run's suffixes, in the run's order
    new = shares < WIDE
    new[:1] = True
    kind = np.cumsum(new) - 1
    at = np.empty(len(order), "i8")
    at[by_run] = np.arange(len(order))  # numbered through all runs
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[at], first)
    windows = shared_windows(text[at[first]], least, shares[first].astype("i8"))
    masks = np.empty(len(order), "u8")
    masks[at] = np.where(docs[at] > least[kind], np.uint64((1 << 64) - 1), windows[kind])
    return text, masks


def merge_runs(rows):
    """For each block the suffixes with windows that a smaller document has, by name, and those windows. A range is merged
    portion by portion: its runs are held as they came, decoded is one portion of them."""
    import numpy as np

    runs, docs = [], []
    for _, data in rows:
        shared, rest, ids = spread(data)
        runs.append(Run(shared, rest))
        docs.append(ids)
    found = [[] for _ in runs]
    for until in portions(runs):
        begun = [r.next for r in runs]
        taken = [r.take(until) for r in runs]
        some = [k for k, (items, _) in enumerate(taken) if items]
        if not some:
            continue
        text, masks = marked([taken[k] for k in some], np.concatenate([docs[k][begun[k]:runs[k].next] for k in some]))
        name = np.zeros(len(masks), "u8")
        hit = np.flatnonzero(masks)
        name[hit] = names(text[hit])
        start = 0
        for k in some:
            end = start + len(taken[k][0])
            mine = hit[np.searchsorted(hit, start):np.searchsorted(hit, end)]
            if len(mine):
                found[k].append((name[mine], masks[mine]))
            start = end
    for (block, _), pieces in zip(rows, found):
        if pieces:
            yield block, press(*[np.concatenate(x) for x in zip(*pieces)])


def dealt(keys, parts: int):
    """The part of each of the sorted keys, and their order by it. Anchors have the least hashes of many, so the part goes by
    a hash of the hash: a range of equal width at the low end would hold most."""
    import numpy as np

    part = to_parts(mixed(keys >> np.uint64(16), 8), parts)
    return part, np.argsort(part, kind="stable")


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, n_bytes, n_removed, n_spans, kept)``: the bytes left, as one string."""
    import numpy as np
    from pyspark.sql import functions as F

    blocks = materialize(pack(docs, doc, text), "blocks")
    parts = max(parts_of(docs), -(-blocks.count() // PART_BLOCKS))

    def say_anchors(rows, _):
        import numpy as np

        data = Bytes(rows)
        keys, first, at, n = np.unique(data.key, return_index=True, return_inverse=True, return_counts=True)
        last = np.zeros(len(keys), "i8")
        last[at] = np.arange(len(at))  # documents are in the order of their ids
        several = data.ids[data.doc[first]] != data.ids[data.doc[last]]
        for number, (k, often) in split_by(*dealt(keys, parts), keys >> np.uint64(16) << np.uint64(16), several.astype("u1")):
            yield number, press(k, often)
        if len(data.anchor):
            heads = np.sort(data.head)
            yield -1, press(heads[np.linspace(0, len(heads) - 1, SAMPLES).astype("i8")])

    sent = materialize(send(blocks, say_anchors), "anchors")
    anchors = materialize(answer(sent.where("part >= 0"), repeated_keys), "repeated")

    def heads(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield pa.record_batch([pa.array((spread(data)[0] ^ np.uint64(1 << 63)).view("i8"))], names=["head"])

    cuts = sent.where("part < 0").select("data").mapInArrow(heads, "head long").agg(
        F.percentile_approx("head", F.array(*[F.lit(k / parts) for k in range(1, parts)]), 10_000) if parts > 1 else F.array()).first()[0]
    cuts = np.unique(np.array(cuts or [], "i8").view("u8") ^ np.uint64(1 << 63))

    def say_suffixes(rows, replies):
        import numpy as np

        data = Bytes(rows)
        some = np.flatnonzero(member(data.key >> np.uint64(16) << np.uint64(16), merged(replies)[0]))
        if not len(some):
            return
        suffixes = data.suffixes(some)
        first = np.unique(suffixes.view(f"S{WIDE}").ravel(), return_index=True)[1]  # sorted; the first is of the smallest document
        suffixes, ids = suffixes[first], data.ids[data.doc[some[first]]]
        part = np.searchsorted(cuts, data.head[some[first]], side="right")
        for number, (mine,) in split_by(part, np.arange(len(first)), np.arange(len(first))):
            yield number, press(*front_code(suffixes[mine]), ids[mine])

    runs = materialize(answer(send(blocks, say_suffixes, anchors), merge_runs), "runs")

    def cut(rows, replies):
        import numpy as np

        data = Bytes(rows)
        known, masks = merged(replies, 2)
        every = np.arange(len(data.anchor))
        name = np.concatenate([names(data.suffixes(every[k:k + (1 << 15)])) for k in range(0, len(every), 1 << 15)]) if len(every) else np.zeros(0, "u8")
        _, first, at = np.unique(name, return_index=True, return_inverse=True)
        whole = data.ids[data.doc] > data.ids[data.doc[first[at]]] if len(every) else np.zeros(0, bool)
        marks = np.zeros(len(data.text) + LENGTH + 1, "i4")
        np.add.at(marks, data.anchor[whole] - data.far[whole], 1)
        np.add.at(marks, data.anchor[whole] - data.near[whole] + LENGTH, -1)
        if len(known):
            order = np.argsort(known)
            known, masks = known[order], masks[order]
            place = np.minimum(np.searchsorted(known, name), len(known) - 1)
            some = np.flatnonzero((known[place] == name) & ~whole)
            for offset in range(LEFT + 1):
                hit = some[masks[place[some]] >> np.uint64(offset) & np.uint64(1) > 0]
                start = data.anchor[hit[(offset >= data.near[hit]) & (offset <= data.far[hit])]] - offset
                np.add.at(marks, start, 1)
                np.add.at(marks, start + LENGTH, -1)
        keep = np.cumsum(marks, dtype="i4") == 0
        edges = np.diff(keep.view("i1"))
        for (key, value), start, size in zip(rows, data.first.tolist(), data.sizes.tolist()):
            own = keep[start:start + size]
            kept = int(own.sum())
            left = value if kept == size else data.text[start:start + size][own].tobytes()
            yield key, size, size - kept, int((edges[start - 1:start + size - 1] == -1).sum()) if kept < size else 0, left

    return finish(blocks, runs, cut, f"{doc} long, n_bytes long, n_removed long, n_spans long, kept binary")
