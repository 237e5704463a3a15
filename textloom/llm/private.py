"""Personal data: four kinds found by form, and more by bootstrapped contexts. Spark expressions only.

By form: e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, leftmost and without overlap
for each kind. The forms are written so that no text takes more than linear time.

By context: what was found by form is the seed. The two words before a mention, or the label glued to it, are its
lexical pattern. Patterns of at least ``SUPPORT`` different seeds are kept; how often each occurs before
anything at all is counted over the whole corpus. Patterns and instances form a graph: a pattern's
confidence is the share of its occurrences that are mentions of believed instances, an instance's is the
noisy-or of its patterns; ``ROUNDS`` rounds pass belief along. Other tokens with digits or an at sign that
confident patterns point to become spans too, of the kind of the pattern's seeds.

Rows: null and empty texts have no spans. Repeated rows are found alike. Extra columns pass through ``redact``;
columns named like the results are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import let
from textloom.llm.common import quoted
from textloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
FORMS = {
    # A run of local characters is tried from its first one only; where a match has ended, the run goes on.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
"""A text without this has no match."""
TOKEN = r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9._%+@-]*+"
"""What else may be an identifier."""
LABEL = r"^[^=:(\"\[<]*+[=:(\"\[<]++"
SUPPORT = 5
CONFIDENT = 0.8
ROUNDS = 3
BUCKETS = 1 << 17
"""Patterns are looked for by hash bucket first: a table of this many bytes, however many patterns there are."""
TAIL = 200
SPANS = "array<struct<start:int,place:int,kind:string,end:int>>"


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is right."""
    back = F.reverse(digits)
    value = lambda i: F.substr(back, i + 1, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, value(i)).when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2))
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(match, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def cut(text: Column, form: str, hint: str, use, none: Column) -> Column:
    """``use(matches, pieces)`` of the matches of a form and the pieces of text before each and after the
    last; ``none`` for texts without a ``hint``. Both lists are made once."""
    both = F.struct(F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("m"), F.split(text, form, -1).alias("p"))
    return F.when(text.rlike(hint), let(both, lambda b: use(b["m"], b["p"]))).otherwise(none)


def mentions(text: Column, kind: str) -> Column:
    """Spans of a kind: ``(start, end, text, before)``, in code points; ``before`` is the text since the last match."""
    none = F.array().cast("array<struct<start:int,end:int,text:string,before:string>>")

    def step(s, x):
        start = s["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        found = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"), F.right(x["p"], F.lit(TAIL)).alias("before"))
        return F.struct(end.alias("at"), F.when(valid(kind, x["m"]), F.concat(s["out"], F.array(found))).otherwise(s["out"]).alias("out"))

    def spans(matches, pieces):
        both = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
        return F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])

    return cut(text, FORMS.get(kind, TOKEN), HINTS.get(kind, "[0-9@]"), spans, none)


def pattern_of(before: Column) -> Column:
    """The label glued to what follows, or else the two words before it, in lower case."""
    def made(words):
        last = F.element_at(words, -1)
        return F.when(last != "", last).otherwise(F.concat_ws(" ", F.get(words, F.size(words) - 3), F.get(words, F.size(words) - 2)))

    return let(F.split(F.lower(before), r"\s+", -1), made)


def patterns_in(text: Column) -> Column:
    """The pattern in front of each word of a text."""
    def made(words):  # a list once made: each word looks at the two before it
        return F.transform(words, lambda w, i: F.when(w.rlike(LABEL), F.regexp_extract(w, LABEL, 0)).when(i > 1, F.concat(F.get(words, i - 2), F.lit(" "), F.get(words, i - 1))))

    return let(F.split(F.lower(text), r"\s+", -1), made)


def spans_of(kind: str, found: Column | None = None) -> Column:
    return F.transform(F.col(kind) if found is None else found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def mentions_of(kind: str) -> Column:
    name = F.lit(kind if kind in KINDS else None).cast("string")
    return F.transform(kind, lambda m: F.struct(name.alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), m["before"].alias("before")))


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc, base, found)``, one row per row: the spans by form and those by context, each an array of
    ``(start, place, kind, end)`` in order; ``place`` is the kind's number."""
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), quoted(doc).alias("doc"), body.alias("body"))
    rows = rows.select("row", "doc", *[mentions(F.col("body"), k).alias(k) for k in KINDS], mentions(F.col("body"), "token").alias("token"))
    rows = materialize(rows, "mentions")
    base = F.array_sort(F.concat(*[spans_of(k) for k in KINDS]))
    seen = rows.select("row", F.explode(F.concat(*[mentions_of(k) for k in (*KINDS, "token")])).alias("m")).select("row", "m.kind", "m.start", "m.end", F.col("m.text").alias("instance"), pattern_of(F.col("m.before")).alias("pattern"))
    seen = materialize(seen.where("pattern <> ''"), "seen")
    kinds = seen.where("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.countDistinct("instance").alias("n")).groupBy("pattern").agg(
        F.sum("n").alias("n"), F.max_by("kind", F.struct("n", "kind")).alias("kind")).where(F.col("n") >= SUPPORT).select("pattern", "kind")
    kinds = materialize(kinds, "patterns")
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    table = bytearray(BUCKETS)
    for (b,) in kinds.select(bucket("pattern")).distinct().toLocalIterator():  # BUCKETS numbers at most
        table[b] = 1
    words = docs.where(quoted(text).isNotNull()).select(F.explode(patterns_in(quoted(text))).alias("pattern")).where("pattern IS NOT NULL")
    words = words.where(F.substring(F.lit(bytes(table)), bucket("pattern") + 1, F.lit(1)) == F.lit(b"\1"))
    counts = words.groupBy("pattern").agg(F.count("*").alias("all"))
    links = seen.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max(F.col("kind").isNotNull()).alias("seed"))
    links = materialize(links.join(kinds, "pattern").join(counts, "pattern", "left"), "graph")
    belief = links.select("instance", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("belief")).groupBy("instance").agg(F.max("belief").alias("belief"))
    for _ in range(ROUNDS):
        known = links.join(belief, "instance")
        scores = known.groupBy("pattern", "kind").agg((F.sum(F.col("n") * F.col("belief")) / F.greatest(F.sum("n"), F.max(F.coalesce("all", F.lit(0))))).alias("score"))
        scores = materialize(scores, "scores")
        belief = links.join(scores.select("pattern", "score"), "pattern").groupBy("instance").agg(
            F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-12)))))).alias("belief"))
        belief = materialize(belief, "belief")
    sure = scores.where(F.col("score") >= CONFIDENT).select("pattern", F.col("kind").alias("as"))
    found = seen.where("kind IS NULL").join(sure, "pattern").join(belief.where(F.col("belief") >= CONFIDENT).select("instance"), "instance")
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("as")).cast("int") - 1
    found = materialize(found.groupBy("row").agg(F.collect_list(F.struct("start", place.alias("place"), F.col("as").alias("kind"), "end")).alias("more")), "found")
    out = rows.select("row", "doc", base.alias("base")).join(found, "row", "left")
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return out.select("row", "doc", "base", F.coalesce(F.array_sort(free), F.array().cast(SPANS)).alias("found"))


def count_of(kind: str) -> Column:
    """How many spans by form are of a kind, of a table that ``find`` has made."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, kind: str) -> Column:
    """``text`` with each span of a kind written as ``<KIND>``."""
    mark = F.lit(f"<{kind.upper()}>")

    def joined(matches, pieces):
        before = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.concat(p, F.when(valid(kind, m), mark).otherwise(m)))
        return F.concat(F.array_join(before, ""), F.element_at(pieces, -1))

    return cut(text, FORMS[kind], HINTS[kind], joined, text)


def merged(spans: Column) -> Column:
    """Spans without overlap, in order: those that overlap are one, of the kind of the first."""
    def step(done, s):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), last["place"].alias("place"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), step)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` with each of the merged spans written as its kind."""
    def made(s):
        before = F.transform(s, lambda m, i: let(F.when(i > 0, F.get(s, i - 1)["end"]).otherwise(0), lambda at: F.concat(
            F.substr(text, at + 1, m["start"] - at), F.lit("<"), F.upper(m["kind"]), F.lit(">"))))
        return F.when(F.size(s) > 0, F.concat(F.array_join(before, ""), F.substr(text, F.try_element_at(s, F.lit(-1))["end"] + 1))).otherwise(text)

    return let(spans, made)


def redact(docs: DataFrame, text: str = "text", into: str = "text") -> DataFrame:
    """``docs`` with all that ``find`` finds in a text written as its kind, ``<EMAIL>``; null stays null. Spans
    that overlap are cut out as one, of the kind of the first."""
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = find(numbered, "_row", text).where(F.size("found") > 0).select(F.col("doc").alias("_row"), F.col("found").alias("_found"))
    marked = numbered.join(found, "_row", "left")
    spans = F.concat(F.coalesce("_found", F.array().cast(SPANS)), *[spans_of(k, mentions(quoted(text), k)) for k in KINDS])
    marked = marked.withColumn("_body", F.when(quoted(text).isNotNull(), without_spans(quoted(text), merged(spans))))
    for kind in KINDS:  # what a span cut out has left may have a form of its own; each reads what the one before has left
        marked = marked.withColumn("_body", masked(F.col("_body"), kind))
    kept = [quoted(c) for c in docs.columns if c.lower() != into.lower()]
    return marked.select(*kept, F.col("_body").alias(into))
