"""Documents packed in blocks, and exchanges of sorted arrays between blocks.

A block holds some megabytes of text, documents in the order of their ids. What a block says about its
text goes out as one compressed array for each of ``parts`` hash or key ranges; what a range finds out comes
back as one array for each block. So a string that fills a third of the corpus counts once for each
block, and no task ever holds more than one block or one range of all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import give_back, quoted

BLOCK_BYTES = 4_000_000


def press(*arrays) -> bytes:
    """Arrays as bytes: each as its own kind, bytes of the same weight together, compressed."""
    import pickle

    import numpy as np
    import zstandard

    parts = [(a.dtype.str, a.shape, np.ascontiguousarray(a).view("u1").reshape(len(a), -1).T.tobytes() if len(a) else b"") for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts))


def spread(data: bytes) -> list:
    """The arrays again."""
    import pickle

    import numpy as np
    import zstandard

    out = []
    for kind, shape, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(size, -1).T).view(kind).reshape(shape))
    return out


def pack(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(block, payload)``: see ``unpack``. The numbers hold once the table is written."""

    def function(batches):
        import pickle

        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        rows, size = [], 0

        def block():
            nonlocal number, rows, size
            rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
            data = zstandard.ZstdCompressor(level=5).compress(pickle.dumps(rows))
            out = pa.record_batch([pa.array([number], pa.int64()), pa.array([data], pa.binary())], names=["block", "payload"])
            number, rows, size = number + 1, [], 0
            return out

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                value = (texts[i].as_py() or "").encode()
                if rows and size + len(value) > BLOCK_BYTES:
                    yield block()
                rows.append((ids[i].as_py(), value))
                size += len(value)
        if rows:
            yield block()

    return docs.select(quoted(doc).cast("long"), quoted(text)).mapInArrow(function, "block long, payload binary")


def unpack(payload: bytes) -> list[tuple[int | None, bytes]]:
    """The documents of a block, ``(id, text)``, by id, a null id first."""
    import pickle

    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def parts_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_replies(blocks: DataFrame, replies: DataFrame, do, schema) -> DataFrame:
    """What ``do(block, rows, replies)`` makes of each block and its replies: a record batch."""
    both = blocks.select("block", F.lit(0).alias("reply"), F.col("payload").alias("data")).unionAll(replies.select("block", F.lit(1).alias("reply"), "data"))

    def function(batches):
        block, payload, answers = None, None, []
        for batch in batches:
            for number, reply, data in zip(*[batch.column(k) for k in range(3)]):
                if not reply.as_py():
                    if payload is not None:
                        yield do(block, unpack(payload), answers)
                    block, payload, answers = number.as_py(), data.as_py(), []
                else:
                    answers.append(data.as_py())
        if payload is not None:
            yield do(block, unpack(payload), answers)
        give_back()

    return both.repartition("block").sortWithinPartitions("block", "reply").mapInArrow(function, schema)


def send(blocks: DataFrame, say, replies: DataFrame | None = None) -> DataFrame:
    """``(part, block, data)`` as ``say(rows, replies)`` gives ``(part, data)`` for each block."""
    import pyarrow as pa

    schema = "part int, block long, data binary"

    def made(block, rows, answers):
        out = list(say(rows, answers))
        return pa.record_batch([pa.array([p for p, _ in out], pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["part", "block", "data"])

    if replies is not None:
        return with_replies(blocks, replies, made, schema)

    def function(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield made(batch.column(0)[i].as_py(), unpack(batch.column(1)[i].as_py()), [])
        give_back()

    return blocks.mapInArrow(function, schema)


def answer(sent: DataFrame, find) -> DataFrame:
    """``(block, data)``: for each part ``find([(block, data)])`` gives ``(block, data)`` for the blocks that
    are to know something."""
    import pyarrow as pa

    def function(key, table):
        said = table.column(1).to_pylist()
        data = [value.as_buffer() for value in table.column(2)]  # where the table has it, not copied
        out = list(find([(said[k], data[k]) for k in sorted(range(len(said)), key=said.__getitem__)]))
        give_back()
        return pa.table([pa.array([b for b, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["block", "data"])

    return sent.groupBy("part").applyInArrow(function, "block long, data binary")


def finish(blocks: DataFrame, replies: DataFrame, do, schema: str) -> DataFrame:
    """Rows as ``do(rows, replies)`` gives them for each block, tuples of the columns of ``schema``."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(T._parse_datatype_string(schema))

    def made(_, rows, answers):
        import pyarrow as pa

        out = do(rows, answers)
        return pa.record_batch([pa.array(list(column), field.type) for column, field in zip(zip(*out), shape)], schema=shape)

    return with_replies(blocks, replies, made, schema)


def to_parts(keys, parts: int):
    """The range of equal width that each 64-bit key falls in."""
    import numpy as np

    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("i8")


def split_by(part, order, *arrays):
    """For each part its number and the arrays' values there; ``order`` sorts by part first."""
    import numpy as np

    sorted_part = part[order]
    cuts = np.flatnonzero(np.concatenate([[True], sorted_part[1:] != sorted_part[:-1]])) if len(order) else []
    for start, end in zip(cuts, [*cuts[1:], len(order)]):
        yield int(sorted_part[start]), [a[order[start:end]] for a in arrays]
