"""Two-dimensional layouts of a neighbour graph, the t-SNE way and the UMAP way, as rounds of Spark jobs.

Points are dealt to blocks of bounded size. A block keeps its points and the edges that leave them; of points
in other blocks that its edges lead to (its ghosts) it knows the coordinates of the last round. In a round each
block moves its points by a few steps, then sends mail: to each block that needs them the coordinates of some of
its points, and to the owner of each ghost one spring, the sum of all that its own edges pull on it with. So
a point that a third of all others are next to gets one spring from each block, not one from each neighbour.
Mail is addressed by the edges, which stay where they are: a round shuffles the points and the mail.

What acts between all pairs comes in a form whose size does not depend on the rows. For t-SNE it is a field: the
blocks add their points' charges to a grid, the sum is convolved with the repulsion of one charge by FFT, and
the field is read back by interpolation. For UMAP it is a sample of the points by a hash of row and round, out of
which each point takes its negatives by a hash too. Runs repeat: nothing is drawn but by hashes.

Each round is written to the shared folder and the one before is removed: lost executors cost one round.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialize, remove, scratch_path

BLOCK_POINTS = 20_000
LEAST_POINTS = 2000
SUMMARY_TASKS = 16
EDGES = 1 << 17
"""Of a block, so many edges are worked on together: what is made on the way does not grow with the block."""
TRAFFIC = "block int, kind string, frm int, blob binary"
WIRES = "block int, frm int, blob binary"


def pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(blob)


def hashed(*numbers) -> np.ndarray:
    """Well mixed 64-bit numbers out of whole numbers, of any shapes that broadcast."""
    mixed = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for n in numbers:
            mixed = mixed ^ np.asarray(n).astype("i8").view("u8")
            mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            mixed = mixed ^ mixed >> np.uint64(31)
    return mixed


def totals(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by the numbers in ``at``."""
    return np.stack([np.bincount(at, values[:, c], n) for c in range(values.shape[1])], axis=1)


@dataclass
class Block:
    """A block's points and the edges that leave them. Edge ends from ``len(rows)`` on are ghosts, which are ordered by
    their owners; ``inner`` marks the edges that are not to ghosts."""

    rows: np.ndarray
    spot: np.ndarray
    state: np.ndarray
    src: np.ndarray
    dst: np.ndarray
    weight: np.ndarray
    ghosts: np.ndarray
    springs: np.ndarray

    def pulled(self, pull: np.ndarray | Callable, places: np.ndarray, width: int = 3, far: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Springs on the block's points and, if ``far``, on its ghosts, as ``(strength, strength times place)``, of each edge
        on both of its ends. ``pull`` has the strengths, or gives those of some edges by their squared lengths, with
        more columns to be added up if a spring is wider."""
        n = len(self.rows)
        own, both = np.zeros((n, width)), np.zeros((len(places) if far else n + 1, width))
        x, y = np.ascontiguousarray(places[:, 0]), np.ascontiguousarray(places[:, 1])
        for start in range(0, len(self.src), EDGES):
            part = slice(start, start + EDGES)
            src, dst = self.src[part], self.dst[part]
            x_src, y_src, x_dst, y_dst = x[src], y[src], x[dst], y[dst]
            strength, *more = pull(part, (x_src - x_dst) ** 2 + (y_src - y_dst) ** 2) if callable(pull) else (pull[part],)
            more = list(np.column_stack(more).T) if more else []
            at = dst if far else np.minimum(dst, n)
            # Column by column: rows of a few numbers are slow to gather and to add up.
            for c, values in enumerate([strength, strength * x_src, strength * y_src, *more]):
                both[:, c] += np.bincount(at, values, len(both))
            for c, values in enumerate([strength, strength * x_dst, strength * y_dst, *more]):
                own[:, c] += np.bincount(src, values, n)
        return both[:n] + own, both[n:len(places)] if far else both[:0]


@dataclass(frozen=True)
class Grid:
    """Nodes of a square from ``-half`` to ``half``."""

    half: float
    nodes: int

    @property
    def step(self) -> float:
        return 2 * self.half / (self.nodes - 1)

    @staticmethod
    def around(reach: float, finest: float = 0.3, most: int = 1024) -> Grid:
        """A grid with room to grow; beyond ``most`` nodes a side its steps are longer."""
        half = 1.3 * reach + 2
        nodes = 64
        while nodes < most and 2 * half / (nodes - 1) > finest:
            nodes *= 2
        return Grid(half, nodes)

    def shares(self, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the 16 nodes around it, numbered, and their shares by cubic interpolation."""
        at = np.clip((spot + self.half) / self.step, 1, self.nodes - 3 - 1e-9)
        low = np.floor(at).astype("i8")
        t = at - low
        along = np.stack([-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6], axis=2)
        near = low[:, :, None] + np.arange(-1, 3)
        node = near[:, 0, :, None] * self.nodes + near[:, 1, None, :]
        return node.reshape(len(spot), 16), (along[:, 0, :, None] * along[:, 1, None, :]).reshape(len(spot), 16)

    def field(self, charge: np.ndarray) -> tuple[np.ndarray, float]:
        """What unit charges do to each other: at each node the sum of ``d / (1 + d d)**2`` over the charges, and the
        sum of ``1 / (1 + d d)`` over all ordered pairs, those of a charge with itself included."""
        n = self.nodes
        away = np.minimum(np.arange(2 * n), 2 * n - np.arange(2 * n)) * self.step
        square = 1 / (1 + away[:, None] ** 2 + away[None, :] ** 2)
        signed = np.where(np.arange(2 * n) < n, away, -away)
        wave = np.fft.rfft2(charge.reshape(n, n), (2 * n, 2 * n))

        def applied(kernel):
            return np.fft.irfft2(wave * np.fft.rfft2(kernel), (2 * n, 2 * n))[:n, :n].ravel()

        total = float(charge @ applied(square))
        return np.stack([applied(signed[:, None] * square**2), applied(signed[None, :] * square**2)], axis=1), total


@dataclass(frozen=True)
class Tsne:
    """Gradient steps with momentum and gains; early rounds with exaggerated attraction. Weights are p(dst | src)."""

    points: int
    early: int = 6
    late: int = 24
    steps: int = 5
    exaggeration: float = 12.0
    momentum: float = 0.5
    grid: Grid = Grid(2.0, 64)
    """Of the field that this round's points move in."""
    later: Grid = Grid(2.0, 64)
    """Of the charges that they leave for the next."""
    field: np.ndarray | None = None
    total: float = 1.0

    # How gains grow and shrink, their floor, and the least learning rate.
    GROW, SHRINK, FLOOR, LEAST_RATE = 0.2, 0.8, 0.01, 20.0
    WIDTH = 3  # of a spring

    @property
    def rounds(self) -> int:
        return self.early + self.late

    def start(self, spot: np.ndarray) -> np.ndarray:
        """Velocities and gains."""
        return np.column_stack([np.zeros_like(spot), np.ones_like(spot)])

    def move(self, b: Block, at: int) -> np.ndarray:
        """Moves the block's points; returns the springs on its ghosts."""
        more = self.exaggeration if at < self.early else 1.0
        rate = max(self.points / 48, self.LEAST_RATE)
        was, speed, gain = b.spot, b.state[:, :2], b.state[:, 2:]

        def springs(far: bool):
            return b.pulled(lambda part, square: (b.weight[part] / (2 * self.points) / (1 + square),), np.concatenate([b.spot, b.ghosts]), far=far)

        for _ in range(self.steps):
            own = springs(False)[0] + b.springs
            node, part = self.grid.shares(b.spot)
            moved = b.spot - was  # the field holds the point itself, where it was
            push = (self.field[node] * part[:, :, None]).sum(axis=1) - moved / ((1 + (moved * moved).sum(axis=1)) ** 2)[:, None]
            slope = 4 * (more * (own[:, :1] * b.spot - own[:, 1:]) - push / self.total)
            gain = np.maximum(np.where(np.sign(slope) == np.sign(speed), gain * self.SHRINK, gain + self.GROW), self.FLOOR)
            # No step overshoots the springs: those of a hub are many times as strong as others.
            pace = np.minimum(rate * gain, 1 / np.maximum(4 * more * own[:, :1], 1e-300))
            speed = self.momentum * speed - pace * slope
            limit = min(g.half - 3 * g.step for g in (self.grid, self.later))
            b.spot = np.clip(b.spot + speed, -limit, limit)
        b.state = np.column_stack([speed, gain])
        return springs(True)[1]

    def summary(self, b: Block, at: int) -> bytes:
        """The block's charges at the nodes of the later grid, and how far out its points are."""
        node, part = self.later.shares(b.spot)
        nodes, place = np.unique(node, return_inverse=True)
        return pack(nodes, np.bincount(place.ravel(), part.ravel()), np.abs(b.spot).max(axis=0))

    def combined(self, blobs: list[bytes]) -> bytes:
        charge, reach = np.zeros(self.later.nodes**2), np.zeros(2)
        for nodes, values, far in map(unpack, blobs):
            charge[nodes] += values
            reach = np.maximum(reach, far)
        nodes = np.flatnonzero(charge)
        return pack(nodes, charge[nodes], reach)

    def informed(self, blob: bytes) -> Tsne:
        nodes, values, reach = unpack(blob)
        charge = np.zeros(self.later.nodes**2)
        charge[nodes] = values
        field, total = self.later.field(charge)
        return replace(self, grid=self.later, later=Grid.around(float(reach.max())), field=field.astype("f4"), total=max(total - self.points, 1e-12))


@dataclass(frozen=True)
class Umap:
    """Epochs in which an edge pulls as often as its weight says and each pull brings negatives. Weights are memberships,
    each pair of points once."""

    points: int
    heaviest: float = 1.0
    rate: float = 0.1
    """Of the first epoch, falling to none. All of a point's springs act at once here, so it is less than the usual 1."""
    epochs: int = 200
    steps: int = 10
    sample: np.ndarray | None = None

    # The curve for a least distance of 0.1 at spread 1, negatives for each pull, the largest push.
    A, B, NEGATIVES, CLIP = 1.577, 0.895, 5, 4.0
    DRAWN, SAMPLE = 40, 4000
    TOGETHER = 2048  # points that draw their negatives together
    WIDTH = 4  # of a spring: with the number of pulls

    @property
    def rounds(self) -> int:
        return self.epochs // self.steps

    def start(self, spot: np.ndarray) -> np.ndarray:
        return np.zeros((len(spot), 0))

    def _pull(self, square: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(square > 0, 2 * self.A * self.B * square ** (self.B - 1) / (1 + self.A * square**self.B), 0.0)

    def _push(self, rows: np.ndarray, spot: np.ndarray, epoch: int) -> np.ndarray:
        """The mean push of the negatives that an epoch's hash draws for some points."""
        drawn = self.sample[hashed(rows[:, None], epoch, np.arange(self.DRAWN)) % np.uint64(len(self.sample))]
        apart = spot[:, None, :] - drawn
        square = (apart * apart).sum(axis=2)
        return np.clip((2 * self.B / ((0.001 + square) * (1 + self.A * square**self.B)))[:, :, None] * apart, -self.CLIP, self.CLIP).mean(axis=1)

    def move(self, b: Block, at: int) -> np.ndarray:
        often = np.minimum(b.weight / self.heaviest, 1.0)

        def springs(active: Callable[[slice], np.ndarray], far: bool):
            def pull(part, square):
                return 2 * active(part) * self._pull(square), active(part)

            return b.pulled(pull, np.concatenate([b.spot, b.ghosts]), self.WIDTH, far)

        for epoch in range(at * self.steps, (at + 1) * self.steps):
            pace = self.rate * (1 - epoch / (self.rounds * self.steps))
            own = springs(lambda part: (np.floor((epoch + 1) * often[part]) > np.floor(epoch * often[part])).astype("f8"), False)[0] + b.springs
            push = np.zeros_like(b.spot)
            for start in range(0, len(b.rows), self.TOGETHER):
                part = slice(start, start + self.TOGETHER)
                push[part] = self._push(b.rows[part], b.spot[part], epoch)
            strength = own[:, :1]
            # The exact way of a point on its springs under a steady push: it cannot overshoot.
            way = np.where(strength > 1e-9, -np.expm1(-pace * strength) / np.maximum(strength, 1e-9), pace)
            b.spot = b.spot + way * (own[:, 1:3] - strength * b.spot + self.NEGATIVES * own[:, 3:] * push)
        return springs(lambda part: often[part], True)[1]

    def summary(self, b: Block, at: int) -> bytes:
        chosen = hashed(b.rows, -1 - at).astype("f8") / 2.0**64 < self.SAMPLE / self.points
        return pack(b.spot[chosen], b.rows[chosen], b.spot[:1], b.rows[:1])

    def combined(self, blobs: list[bytes]) -> bytes:
        parts = [unpack(x) for x in blobs]
        one = min(range(len(parts)), key=lambda k: int(parts[k][3][0]))
        return pack(*[np.concatenate([p[k] for p in parts]) for k in (0, 1)], *parts[one][2:])

    def informed(self, blob: bytes) -> Umap:
        spot, rows, one, _ = unpack(blob)
        order = np.argsort(rows, kind="stable")
        return replace(self, sample=spot[order] if len(rows) else one)


def wire(points: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of the blocks: ``(block, rows, spots)`` out of ``points`` (``row, block, x, y``), and ``WIRES`` out of ``edges``
    (``src, dst, w``): where ``frm`` is the block itself, its edges, else the places of its points that ``frm`` needs."""
    order = Window.partitionBy("block").orderBy("row")
    places = materialize(points.select("row", "block", (F.row_number().over(order) - 1).alias("pos"), "x", "y"), "places")
    at = places.select("row", "block", "pos")
    ends = edges.join(at.toDF("src", "block", "from"), "src").join(at.toDF("dst", "other", "to"), "dst").select("block", "from", "other", "to", "w")

    def wired(key, table):
        block = key[0].as_py()
        src, other, to, w = (table.column(c).to_numpy() for c in ("from", "other", "to", "w"))
        sort = np.lexsort((to, other, src))  # rows arrive in any order, sums should not
        src, other, to, w = src[sort], other[sort], to[sort], w[sort]
        outer = other != block
        ghosts, place = np.unique(other[outer].astype("i8") << 32 | to[outer], return_inverse=True)
        dst = to.astype("i4")
        dst[outer] = -1 - place  # the number of own points is not known here
        owner, ghosts = (ghosts >> 32).astype("i4"), (ghosts & 0xFFFFFFFF).astype("i4")
        owners = np.unique(owner)
        cuts = np.append(np.searchsorted(owner, owners), len(owner))
        rows = [(block, block, pack(src.astype("i4"), dst, w, owners, cuts))]
        rows += [(int(o), block, pack(ghosts[cuts[k]:cuts[k + 1]])) for k, o in enumerate(owners)]
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "frm": pa.array([r[1] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary())})

    return places, materialize(ends.groupBy("block").applyInArrow(wired, WIRES), "wires")


def _letters(table: pa.Table) -> list[dict]:
    """The rows of a table, their blobs not copied."""
    rows = table.drop_columns("blob").to_pylist()
    return [row | {"blob": blob.as_buffer()} for row, blob in zip(rows, table.column("blob"))]


def _block(wires: list[dict], state: bytes, mail: list[dict], width: int) -> tuple[Block, list[tuple[int, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """A block as its mail leaves it; whom it has to tell of which points; and whose its ghosts are."""
    rows, spot, more = unpack(state)
    n = len(rows)
    src, dst, weight, owners, cuts = np.zeros(0, "i4"), np.zeros(0, "i4"), np.zeros(0), np.zeros(0, "i4"), np.zeros(1, "i8")
    tell = []
    for wire_ in wires:
        if wire_["frm"] == wire_["block"]:
            src, dst, weight, owners, cuts = unpack(wire_["blob"])
        else:
            tell.append((wire_["frm"], *unpack(wire_["blob"])))
    ghosts = np.zeros((int(cuts[-1]), 2))
    springs = np.zeros((n, width))
    asked = dict(tell)
    for letter in sorted(mail, key=lambda m: m["frm"]):
        if letter["kind"] == "places":
            k = int(np.searchsorted(owners, letter["frm"]))
            ghosts[cuts[k]:cuts[k + 1]] = unpack(letter["blob"])[0]
        else:
            springs[asked[letter["frm"]]] += unpack(letter["blob"])[0]
    return Block(rows, spot, more, src, np.where(dst < 0, n - 1 - dst, dst), weight, ghosts, springs), sorted(tell, key=lambda t: t[0]), (owners, cuts)


def _round(method, at: int):  # method: broadcast, as workers have no copy of this package
    """One round of a block: its wires, its state and its mail give the next state, mail and summary."""

    def function(left, right):
        rows = _letters(right)
        block = rows[0]["block"]
        state = next(r["blob"] for r in rows if r["kind"] == "state")
        told = cloudpickle.loads(method.value)
        b, tell, (owners, cuts) = _block(_letters(left), state, [r for r in rows if r["kind"] in ("places", "springs")], told.WIDTH)
        out = []
        if at >= 0:  # before the first round, places only are told
            on_ghosts = told.move(b, at)
            out += [(int(o), "springs", block, pack(on_ghosts[cuts[k]:cuts[k + 1]])) for k, o in enumerate(owners)]
        out.append((block, "state", block, pack(b.rows, b.spot, b.state)))
        out.append((block, "summary", block, told.summary(b, at)))
        out += [(int(to), "places", block, pack(b.spot[places])) for to, places in tell]
        return pa.table({"block": pa.array([r[0] for r in out], pa.int32()), "kind": [r[1] for r in out],
                         "frm": pa.array([r[2] for r in out], pa.int32()), "blob": pa.array([r[3] for r in out], pa.binary())})

    return function


def _written(traffic: DataFrame) -> tuple[DataFrame, str]:
    """A round's traffic by kind, so that a summary is read without the rest."""
    path = scratch_path(traffic.sparkSession, "round")
    traffic.write.partitionBy("kind").parquet(path)
    return traffic.sparkSession.read.schema(TRAFFIC).parquet(path).select("block", "kind", "frm", "blob"), path


def _summary(traffic: DataFrame, method, tasks: int) -> bytes:
    """The blocks' summaries made one: in ``SUMMARY_TASKS`` tasks at most first, whatever the number of blocks."""

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = sorted((frm, blob) for b in batches for frm, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if blobs:
            yield pa.record_batch([pa.array([blobs[0][0]], pa.int32()), pa.array([method.combined([b for _, b in blobs])], pa.binary())], names=["frm", "blob"])

    rows = traffic.where("kind = 'summary'").select("frm", "blob").repartition(min(tasks, SUMMARY_TASKS), "frm").mapInArrow(function, "frm int, blob binary").collect()
    return method.combined([bytes(r["blob"]) for r in sorted(rows, key=lambda r: r["frm"])])


def layout(points: DataFrame, edges: DataFrame, method) -> DataFrame:
    """``row, x, y`` of ``points`` (``row, block, x, y``) moved by a ``Tsne`` or ``Umap`` method along ``edges`` (``src, dst, w``)."""
    spark = points.sparkSession
    places, wires = wire(points, edges)
    blocks = places.select(F.max("block")).first()[0] + 1
    wires = wires.repartition(blocks, "block").persist()

    def gathered(key, table):
        table = table.sort_by("pos")
        rows = table.column("row").to_numpy()
        spot = np.stack([table.column(c).to_numpy() for c in ("x", "y")], axis=1)
        return pa.table({"block": [key[0].as_py()], "kind": ["state"], "frm": [key[0].as_py()], "blob": [pack(rows, spot, method.start(spot))]},
                        schema=pa.schema([("block", pa.int32()), ("kind", pa.string()), ("frm", pa.int32()), ("blob", pa.binary())]))

    traffic = places.groupBy("block").applyInArrow(gathered, TRAFFIC)
    before = None
    try:
        for at in range(-1, method.rounds):
            shared = spark.sparkContext.broadcast(cloudpickle.dumps(method))
            moved = wires.groupBy("block").cogroup(traffic.where("kind <> 'summary'").groupBy("block")).applyInArrow(_round(shared, at), TRAFFIC)
            traffic, path = _written(moved)
            if at + 1 < method.rounds:
                method = method.informed(_summary(traffic, method, blocks))
            if before:
                remove(spark, before)
            shared.unpersist()
            before = path
    finally:
        wires.unpersist()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rows, spot, _ = unpack(blob)
                yield pa.record_batch([pa.array(rows), pa.array(spot[:, 0]), pa.array(spot[:, 1])], names=["row", "x", "y"])

    return traffic.where("kind = 'state'").select("blob").mapInArrow(opened, "row long, x double, y double")
