"""Toxicity by multiple-instance learning. A document is a bag of sentences; a sentence's score is a
logistic function of its words and their beginnings; the document's is the noisy-or of those. Only
documents have labels: the gradient of the noisy-or spreads them over the sentences.

Rows: a text that is null or has no words scores 0 and has no offending sentences. Documents without
a label are not learned from; of several labels the highest counts. Without any labelled document
every score is that of the prior. Extra columns pass through; columns named like the results are
replaced.
"""

from __future__ import annotations

import zlib

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, drop_stores, give_back, per_text, quoted
from textloom.session import materialize, remove

BITS = 17
TRAIN_DOCUMENTS = 12_000
"""At most so many labelled documents, of the smallest hashed ids, are learned from."""
TRAIN_TASKS = 12
STEPS = 60
RATE = 0.3
FLOOR = 2e-4
"""Gradients well below this move a weight in proportion, those above it by about RATE."""
DECAY = 1e-5
LEAST_DOCUMENTS = 3
"""A feature of fewer sampled documents has no weight: it would learn those by heart."""
BEGINNINGS = (4, 5, 6)
CACHED_WORDS = 60_000
OFFENDING = 0.5


def sentence_table() -> bytes:
    """A translation table: A-Z to a-z, what ends a sentence to a line feed, other ASCII that is
    no letter or digit to a blank."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 10 if c in ".!?\n\r" else 32
    return bytes(table)


def features(word: bytes) -> list[int]:
    """Hashed numbers of a word and its beginnings."""
    parts = {b"=" + word, *[b"^" + word[:k] for k in BEGINNINGS if len(word) >= k]}
    return sorted({zlib.crc32(x) & (1 << BITS) - 1 for x in parts})


def training_rows(docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str, bound: int) -> DataFrame:
    """``(toxic, features, ends)`` of a bounded sample: the features of a document's sentences one
    after the other, and where each sentence ends."""
    sample = (
        labels.where(quoted(label).isNotNull()).groupBy(quoted(doc).alias("doc")).agg(F.max(quoted(label).cast("double")).alias("toxic"))
        .orderBy(F.xxhash64("doc"), "doc").limit(bound)
    )
    rows = docs.select(quoted(doc).alias("doc"), quoted(text).alias("text")).join(F.broadcast(sample), "doc").select("toxic", "text")
    table = sentence_table()

    def function(batches):
        import pyarrow as pa

        drop_stores()
        known: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                numbers, ends = [], []
                for line in (batch.column(1)[i].as_py() or "").encode().translate(table).split(b"\n"):
                    if words := set(line.split()):
                        for w in words:
                            if w not in known:
                                known[w] = features(w)
                            numbers += known[w]
                        ends.append(len(numbers))
                if len(known) > CACHED_WORDS:
                    known.clear()
                if ends:
                    yield pa.record_batch([batch.column(0)[i:i + 1], pa.array([numbers], pa.list_(pa.int32())), pa.array([ends], pa.list_(pa.int32()))], names=["toxic", "features", "ends"])
        known.clear()
        give_back()

    return rows.mapInArrow(function, "toxic double, features array<int>, ends array<int>")


class Scorer:
    """Sentence scores from learned weights; the last weight is the constant."""

    def __init__(self, weights):
        self.weights = weights
        self.known: dict[bytes, float] = {}
        self.table = sentence_table()

    def weigh(self, word: bytes) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            value = self.known[word] = float(self.weights[features(word)].sum())
        return value

    def score(self, text: str):
        """The document's score and its offending sentences."""
        import math

        import numpy as np

        lines = text.encode().translate(self.table).split(b"\n")
        weigh, constant = self.weigh, float(self.weights[-1])
        logits = np.array([sum(map(weigh, words)) + constant if (words := set(line.split())) else -np.inf for line in lines])
        score = -math.expm1(-float(np.logaddexp(0, logits).sum()))
        found = []
        high = math.log(OFFENDING / (1 - OFFENDING))
        if len(logits) and logits.max() >= high:
            start, data = 0, text.encode()
            for line, z in zip(lines, logits.tolist()):
                if z >= high:
                    at = len(data[:start].decode())
                    found.append({"start": at, "end": at + len(data[start:start + len(line)].decode()), "score": 1 / (1 + math.exp(-z))})
                start += len(line) + 1
        return score, found


def fit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = TRAIN_DOCUMENTS) -> Scorer:
    """Learns the weights: full-batch steps, each a Spark job over the sampled rows whose tasks give
    one gradient each."""
    import numpy as np

    spark = docs.sparkSession
    path_rows = materialize(training_rows(docs, labels, doc, text, label, bound).repartition(TRAIN_TASKS), "toxicity")
    total = path_rows.agg(F.count("*"), F.sum("toxic"), F.sum(F.size("ends"))).first()
    count, positive, sentences = total[0], total[1] or 0.0, total[2] or 0
    rate = (positive + 0.5) / (count + 1)
    weights = np.zeros((1 << BITS) + 1)
    weights[-1] = np.log(rate * max(count, 1) / max(sentences, 1))
    first, second = np.zeros_like(weights), np.zeros_like(weights)

    def spread(batches):
        import numpy as np
        import pyarrow as pa

        drop_stores()
        total = np.zeros(1 << BITS)
        for batch in batches:
            for i in range(batch.num_rows):
                total[np.unique(batch.column(1)[i].values.to_numpy())] += 1
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["g"])

    used = sum([np.frombuffer(r.g) for r in path_rows.mapInArrow(spread, "g binary").collect()], np.zeros(1 << BITS)) >= LEAST_DOCUMENTS
    for step in range(1, STEPS + 1 if count else 1):
        shared = spark.sparkContext.broadcast(weights)

        def gradient(batches, shared=shared):
            import numpy as np
            import pyarrow as pa

            drop_stores()
            w = shared.value
            total = np.zeros_like(w)
            for batch in batches:
                lists, ends = batch.column(1), batch.column(2)
                ids = lists.flatten().to_numpy()
                starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])[:-1]
                sizes = ends.value_lengths().to_numpy()
                end = ends.flatten().to_numpy() + np.repeat(starts, sizes)
                owner = np.repeat(np.arange(batch.num_rows), sizes)
                begin = np.concatenate([[0], end[:-1]])
                z = np.add.reduceat(w[ids], begin) + w[-1]
                p = np.exp(-np.logaddexp(0, -z))
                bag = np.bincount(owner, np.logaddexp(0, z), batch.num_rows)
                clean = np.exp(-bag)
                toxic = batch.column(0).to_numpy()
                pull = np.where(toxic > 0, clean / np.maximum(-np.expm1(-bag), 1e-12), -1.0)
                slope = p * pull[owner]
                total[:-1] += np.bincount(ids, np.repeat(slope, end - begin), len(w) - 1)
                total[-1] += slope.sum()
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["g"])

        parts = path_rows.mapInArrow(gradient, "g binary").collect()  # one vector for each of TRAIN_TASKS
        shared.destroy()
        g = sum(np.frombuffer(r.g) for r in parts) / count - DECAY * np.append(weights[:-1], 0)
        g *= np.append(used, True)
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        weights = weights + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + FLOOR)
        weights[:-1] = np.maximum(weights[:-1], 0)  # words are evidence for toxicity or none; the constant is against it
    if count:
        remove(spark, path_rows.inputFiles()[0].rsplit("/", 1)[0])
    return Scorer(weights)


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """Adds ``toxicity``, 0 to 1, and ``offending``: the sentences that score at least ``OFFENDING``
    alone, as spans of characters, end exclusive, with their scores."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(scorer))

    def compute(value, held=[]):  # noqa: B006  one list for each task
        if not held:
            held.append(cloudpickle.loads(shared.value))
        return held[0].score(value)

    span = [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    function = per_text(text, compute, lambda r: 50 + 16 * len(r[1]), pa.float64(), pa.list_(pa.struct(span)))
    found = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    return appended(docs, function, ("toxicity", T.DoubleType()), ("offending", found))


def learned_from(docs: DataFrame, labels: DataFrame, rows: Column) -> Scorer:
    """The scorer learned from the labels of the given rows of ``labels``."""
    return fit(docs, labels.where(rows))
