"""Byte-level BPE. The merges of a pre-token run on a queue of merge ranks: one bucket of
positions per rank, and a bitmap in two levels that tells the lowest rank in use. A merge
leaves entries behind that no longer hold; they are skipped when their bucket is opened. A
pre-token of n bytes therefore costs O(n) queue steps, however long it is.

Rows: a null text has no tokens. Extra columns pass through; ``token_ids`` or ``decoded``, if
the table has them, are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.common import OUTPUT_BYTES, appended, worker_store

CACHED_CHUNKS = 160_000
CACHED_LENGTH = 32
PORTION = 3_000_000
"""About how many chunks that came again a worker remembers, the longest it does, and the characters encoded
together: matters of speed and memory only."""


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: always the lowest rank next, the leftmost of equals first.

    The queue: ``buckets`` holds positions by rank, ``low`` a bit for each rank in words of 256,
    ``top`` a bit for each word of ``low`` in use.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, rank_of = len(piece), ranks.get
    after = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n))  # where the token before this one starts
    pending = [rank_of(piece[i:i + 2], -1) for i in range(n)]  # the rank of the pair that starts here, -1 for none
    pending[-1] = -1
    buckets: dict[int, list[int]] = {}
    low: dict[int, int] = {}
    top = 0
    fresh = [(rank, i) for i, rank in enumerate(pending) if rank >= 0]
    while True:
        for rank, i in fresh:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                word = rank >> 8
                low[word] = low.get(word, 0) | 1 << (rank & 255)
                top |= 1 << word
        if not top:
            break
        word = (top & -top).bit_length() - 1
        bits = low[word]
        rank = word << 8 | (bits & -bits).bit_length() - 1
        low[word] = bits = bits & bits - 1
        if not bits:
            top &= top - 1
        positions = buckets.pop(rank)
        if len(positions) > 1:
            positions.sort()
        fresh = []
        for k, i in enumerate(positions):
            if pending[i] != rank:
                continue  # what this entry stood for has been merged since
            j = after[i]
            end = after[i] = after[j]
            pending[j] = new = -1
            before[end] = i
            if end < n:
                new = rank_of(piece[i:after[end]], -1)
                if new >= 0:
                    fresh.append((new, i))
            pending[i] = new
            h = before[i]
            older = -1
            if h >= 0:
                pending[h] = older = rank_of(piece[h:end], -1)
                if older >= 0:
                    fresh.append((older, h))
            if 0 <= new <= rank or 0 <= older <= rank:  # what is left of this bucket waits its turn
                fresh += [(rank, left) for left in positions[k + 1:]]
                break
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class RankQueue:
    """Buckets of positions by rank. ``low`` has a bit for each rank, in words of 256; ``top`` one
    for each word of ``low`` in use."""

    def __init__(self):
        self.buckets, self.low, self.top = {}, {}, 0

    def push(self, ranks, positions) -> None:
        """Arrays of the same length."""
        import numpy as np

        narrow = ranks.astype("u2") if ranks.max() < 1 << 16 else ranks  # numpy sorts short numbers digit by digit
        order = np.argsort(narrow, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, part in zip(ranks[starts].tolist(), np.split(positions, cuts)):
            if rank in self.buckets:
                self.buckets[rank].append(part)
            else:
                self.buckets[rank] = [part]
                word = rank >> 8
                self.low[word] = self.low.get(word, 0) | 1 << (rank & 255)
                self.top |= 1 << word

    def pop(self):
        """The lowest rank and its positions from left to right, each once."""
        import numpy as np

        word = (self.top & -self.top).bit_length() - 1
        bits = self.low[word]
        rank = word << 8 | (bits & -bits).bit_length() - 1
        self.low[word] = bits = bits & bits - 1
        if not bits:
            self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        if len(parts) == 1:
            return rank, parts[0]
        positions = np.sort(np.concatenate(parts))
        return rank, positions[np.concatenate([[True], positions[1:] != positions[:-1]])]


class Merger:
    """The merges of many pre-tokens at once."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: rank for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.ranks = ranks
        self.keys = np.array(sorted(pairs), "i8")
        self.values = np.array([pairs[k] for k in self.keys.tolist()], "i8")
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], "i8")

    def pair(self, left, right):
        """Rank of the merge of each pair of tokens, -1 where there is none."""
        import numpy as np

        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.values[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """For each piece its ids as 32-bit little-endian numbers."""
        import numpy as np

        sizes = np.array([len(x) for x in pieces], "i8")
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        n = int(bounds[-1])
        token = np.full(n + 1, -1)
        token[:n] = self.single[np.frombuffer(b"".join(pieces), "u1")]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[bounds[1:] - 1] = n  # n stands for the end of any piece, and for what precedes one
        before[bounds[:-1]] = n
        pending = self.pair(token, token[np.minimum(after, n)])
        queue = RankQueue()
        some = np.flatnonzero(pending >= 0)
        if len(some):
            queue.push(pending[some], some)
        while queue.top:
            rank, at = queue.pop()
            at = at[pending[at] == rank]  # the rest has been merged since
            if not len(at):
                continue
            if len(at) > 1:
                touch = after[at[:-1]] == at[1:]
                if touch.any():  # of pairs that overlap, every second one from the left
                    place = np.arange(len(at))
                    first = np.maximum.accumulate(np.where(np.concatenate([[True], ~touch]), place, 0))
                    at = at[(place - first) % 2 == 0]
            inner = after[at]
            end = after[inner]
            token[at] = rank
            after[at] = end
            token[inner] = pending[inner] = -1
            before[end] = at
            around = np.empty(2 * len(at), "i8")  # from left to right: what precedes a merge is at the merge before it at least
            around[0::2], around[1::2] = before[at], at
            once = around < n
            once[2::2] &= around[2::2] != around[1:-1:2]
            around = around[once]
            new = self.pair(token[around], token[after[around]])
            pending[around] = new
            if (some := new >= 0).any():
                if new[some].min() <= rank:  # merges are not in the order of ranks here
                    return [np.array(merge_piece(x, self.ranks), "<i4").tobytes() for x in pieces]
                queue.push(new[some], around[some])
        alive = token[:n] >= 0
        ids = token[:n][alive].astype("<i4").tobytes()
        ends = (4 * np.concatenate([[0], np.cumsum(alive)])[bounds]).tolist()
        return [ids[i:j] for i, j in zip(ends, ends[1:])]


chunks = re.compile(r" (?=\S)").split
"""A text cut at each blank that a non-space character follows. All parts but the first have lost such a blank; none
of them begins with one."""


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the text of a rank file."""
    lines = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def vocabulary(path: str) -> bytes:
    """A rank file's content, read on the driver: it is a few hundred kB, whatever the data."""
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, text: str, ranks: bytes, pattern: str, into: str = "token_ids", blanks_part: bool = False) -> DataFrame:
    """Adds the token ids of each whole text, ``array<int>``. ``ranks`` is the content of a rank
    file, ``pattern`` what splits a text into pre-tokens. ``blanks_part`` says that no match of
    the pattern goes on across a blank that a non-space character follows, which lets repeated
    words be split once."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def function(batches):
        import numpy as np
        import pyarrow as pa
        import regex

        store = worker_store("bpe").setdefault("encode", {})
        key = (hash(shared.value), pattern)
        if key not in store:
            store.clear()
            known = read_ranks(shared.value)

            store[key] = ({}, Merger(known), regex.compile(pattern))
        merged, merger, splitter = store[key]
        find = splitter.findall

        def split(found):
            """The pre-tokens of all chunks, and where those of each chunk begin and end."""
            if not (blanks_part and found):
                return found, range(len(found) + 1)
            joined = " " + " ".join(found)
            pieces = find(joined)
            ends = np.cumsum(np.fromiter(map(len, pieces), "i8", len(pieces)))
            wanted = np.cumsum(np.fromiter(map(len, found), "i8", len(found)) + 1)
            cuts = np.searchsorted(ends, wanted)
            if len(ends) and ends[-1] == len(joined) and (ends[cuts] == wanted).all():
                return pieces, [0, *(cuts + 1).tolist()]
            parts = [find(" " + chunk) for chunk in found]  # a pattern that leaves characters out
            return [piece for part in parts for piece in part], [0, *np.cumsum([len(part) for part in parts]).tolist()]

        def learn(found):
            """The ids of each chunk in ``found``. A first part of a text is marked by a blank, others have lost one."""
            heads = [chunk for chunk in found if chunk[:1] == " "] if blanks_part else []
            later = [chunk for chunk in found if chunk[:1] != " "] if blanks_part else list(found)
            pieces, cuts = split(later)
            pieces, cuts = list(pieces), list(cuts)
            for head in heads:
                pieces += find(head[1:])
                cuts.append(len(pieces))
            names = list(set(pieces))
            coded = [piece.encode() for piece in names]
            whole = [merger.ranks.get(x) for x in coded]
            known = {piece: rank.to_bytes(4, "little") for piece, rank in zip(names, whole) if rank is not None}
            rest = [i for i, rank in enumerate(whole) if rank is None]
            known.update(zip([names[i] for i in rest], merger.merge([coded[i] for i in rest])))
            ids = list(map(known.__getitem__, pieces))
            return {chunk: ids[i] if j == i + 1 else b"".join(ids[i:j]) for chunk, i, j in zip([*later, *heads], cuts, cuts[1:])}

        def encoded(texts):
            if len(merged) > CACHED_CHUNKS:
                merged.clear()
            lists = [chunks(t) if blanks_part else find(t) for t in texts]
            if blanks_part:
                for part in lists:
                    part[0] = " " + part[0]
            unseen = Counter([c for part in lists for c in part if c not in merged])
            merged.update(learn(unseen))
            of = merged.__getitem__
            made = [b"".join(map(of, part)) for part in lists]
            for chunk, times in unseen.items():  # what came once is not likely to come again
                if times == 1 or len(chunk) > CACHED_LENGTH:
                    del merged[chunk]
            return made

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            start, size, texts = 0, 0, []
            for i in range(batch.num_rows):
                texts.append(column[i].as_py() or "")
                size += len(texts[-1])
                if size > PORTION or i + 1 == batch.num_rows:
                    made = encoded(texts)
                    offsets = np.cumsum([0, *[len(x) // 4 for x in made]]).astype("i4")
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), "<i4")))
                    part = batch.slice(start, i + 1 - start)
                    yield pa.record_batch([*part.columns, ids], names=[*part.schema.names, into])
                    start, size, texts = i + 1, 0, []

    if text.lower() == into.lower():
        raise ValueError("the tokens need a column of their own")
    return appended(df, function, (into, T.ArrayType(T.IntegerType())), store="bpe")


def decode(df: DataFrame, tokens: str, ranks: bytes, into: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids in ``tokens`` stand for. No ids, or null, give no bytes."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def function(batches):
        import pyarrow as pa

        store = worker_store("bpe").setdefault("decode", {})
        key = hash(shared.value)
        if key not in store:
            store.clear()
            store[key] = {rank: token for token, rank in read_ranks(shared.value).items()}
        of = store[key].__getitem__
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(tokens))
            start, size, made = 0, 0, []
            for i in range(batch.num_rows):
                ids = column[i].values
                made.append(b"".join(map(of, ids.to_numpy(zero_copy_only=False).tolist())) if ids is not None else b"")
                size += len(made[-1])
                if size > OUTPUT_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.record_batch([*part.columns, pa.array(made, pa.binary())], names=[*part.schema.names, into])
                    start, size, made = i + 1, 0, []

    return appended(df, function, (into, T.BinaryType()), store="bpe")
