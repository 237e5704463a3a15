"""Language mixtures. Each language is a distribution over hashed byte trigrams of lower-cased
text, counted over all labelled documents. A document's language shares are found by expectation
maximisation over its trigrams; the set of languages is the one with the best likelihood less a
penalty for each language more.

Rows: a text that is null or has no letters is ``und`` with score 0; so is every text where nothing
could be learned. Equal shares go to the language whose name sorts first. Rows without a language
are not learned from. Extra columns pass through; columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import appended, per_text, quoted

BITS = 16
SMOOTHING = 0.1
STEPS = 25
SETTLED = 1e-3
PENALTY = 3.0
"""A language more must gain so many times half the logarithm of the number of trigrams; each letter
counts in three trigrams."""


def grams(text: str):
    """The hashed trigrams of a text and how often it has each."""
    import numpy as np

    table = bytearray(range(256))
    for b in range(128):
        table[b] = ord(chr(b).lower()) if chr(b).isalpha() else 32
    a = np.frombuffer(b" %b " % text.encode().translate(bytes(table)), "u1").astype("u4")
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]  # one blank for any run
    if len(a) < 3:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    codes = ((a[:-2] << 16 | a[1:-1] << 8 | a[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    counts = np.bincount(codes)
    found = np.flatnonzero(counts)
    return found, counts[found]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts ``(lang, gram, n)`` over all rows with a language. Each task adds up its own first."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        total: dict = {}
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                found, n = grams(texts[i].as_py())
                name = langs[i].as_py()
                if name not in total:
                    total[name] = np.zeros(1 << BITS, "i8")
                total[name][found] += n
        for name, counts in total.items():
            found = np.flatnonzero(counts)
            yield pa.record_batch([pa.array([name] * len(found)), pa.array(found), pa.array(counts[found])], names=["lang", "gram", "n"])

    rows = docs.select(quoted(lang).cast("string").alias("lang"), quoted(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Mixture:
    """Language shares of a text. ``counts`` maps a language to its trigram counts."""

    def __init__(self, counts: dict):
        import numpy as np

        self.names = sorted(counts)
        table = np.array([counts[n] for n in self.names], "f8").reshape(len(self.names), 1 << BITS).T + SMOOTHING
        self.p = (table / table.sum(axis=0)).astype("f4")

    def shares(self, p, n):
        """Weights of the columns of ``p`` and the log-likelihood of trigrams seen ``n`` times."""
        import numpy as np

        w = np.full(p.shape[1], 1 / p.shape[1])
        total = n.sum()
        for _ in range(STEPS):
            new = w * ((n / (p @ w)) @ p) / total
            settled = np.abs(new - w).max() < SETTLED
            w = new
            if settled:
                break
        return w, float(n @ np.log(p @ w))

    def predict(self, text: str):
        """The main language, its share, and the shares of all languages of the chosen set."""
        import math

        import numpy as np

        if not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, {}
        found, n = grams(text)
        if not len(found):  # letters of which no trigram can be made do not occur: a blank is put on either side
            return "und", 0.0, {}
        p = self.p[found].astype("f8")
        n = n.astype("f8")
        alone = n @ np.log(p)
        best = [int(alone.argmax())]
        weights, value = np.ones(1), float(alone.max())
        if len(self.names) > 1:
            price = PENALTY * 0.5 * math.log(n.sum() + 1)
            full, reach = self.shares(p, n)
            if reach - price > value:  # else no set of more languages can win
                order = np.argsort(-full, kind="stable").tolist()
                for size in range(2, len(order) + 1):
                    w, likely = (full[order], reach) if size == len(order) else self.shares(p[:, order[:size]], n)
                    if likely - price * (size - 1) > value:
                        best, weights, value = order[:size], w, likely - price * (size - 1)
                    if reach - price * size <= value:
                        break
        mixture = {self.names[k]: float(x) for k, x in zip(best, weights / weights.sum())}
        main = min(mixture, key=lambda k: (-mixture[k], k))
        return main, min(1.0, mixture[main]), mixture


def model(counts: DataFrame) -> Mixture:
    """The learned model: one array of ``2 ** BITS`` numbers for each language, whatever the number of documents."""
    import numpy as np

    arrays: dict = {}
    for lang, gram, n in counts.toLocalIterator():
        arrays.setdefault(lang, np.zeros(1 << BITS, "i8"))[gram] = n
    return Mixture(arrays)


def identify(docs: DataFrame, mixture: Mixture, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``languages``, the shares of the chosen set."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(mixture))

    def compute(value, held=[]):  # noqa: B006  one list for each task
        if not held:
            held.append(cloudpickle.loads(shared.value))
        main, score, shares = held[0].predict(value)
        return main, score, list(shares.items())

    function = per_text(text, compute, lambda r: 100, pa.string(), pa.float64(), pa.map_(pa.string(), pa.float64()))
    return appended(docs, function, ("lang_pred", T.StringType()), ("score", T.DoubleType()), ("languages", T.MapType(T.StringType(), T.DoubleType())))


def learned_from(docs: DataFrame, rows: Column, text: str = "text", lang: str = "lang") -> Mixture:
    return model(learn(docs.where(rows), text, lang))
