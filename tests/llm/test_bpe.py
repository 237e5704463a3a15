import base64
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from textloom.llm import bpe, queries

NAME = "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(bpe.vocabulary(public_tokenizers.path(NAME)))


@pytest.fixture(scope="module")
def own(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(7)
    some = ["a", "the", " ", "  ", "\n", "\r\n", "\t", "'s", "'ll", "1", "23", ".", "é", " ", " ", "\x1c", "\U0001f600", "ß", "٣", "<|endoftext|>", "anhely"]
    return [None, "", " ", "   ", "\n\n", " \n b", "a\n \nb", "x" * 20_000, "ab" * 9000 + "é" * 5000, " " * 3000 + "z"] + ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(400)]


def test_texts(spark, table, folder, own, sha):
    texts = odd_texts()
    rows = queries.op1_byte_bpe(spark, folder(documents=table(texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = own.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r.doc_id] or "")), repr(texts[r.doc_id])


def test_given_table(spark, data, own, sha):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in queries.op1_byte_bpe(spark, data).collect():
        assert r.ids_sha256 == sha(" ".join(map(str, own.encode_ordinary(texts[r.doc_id]))))


def test_merges_alone_and_together(ranks, own):
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"abet \n.0\xc3\xa9inghe") for _ in range(rng.choice([1, 2, 3, 8, 30, 200]))) for _ in range(1500)] + [b"a" * k for k in range(1, 60)]
    want = [own._core_bpe.encode_single_piece(p) for p in pieces]
    assert [bpe.merge_piece(p, ranks) for p in pieces] == want
    for piece, ids, got in zip(pieces, want, bpe.Merger(ranks).merge(pieces)):
        assert np.frombuffer(got, "<i4").tolist() == ids, piece


def test_vocabulary_out_of_order():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abc": 300, b"ab": 301, b"abcd": 257, b"cd": 258}
    pieces = [b"abcd", b"abcabcd", b"abab", b"bcbcd"]
    got = [np.frombuffer(x, "<i4").tolist() for x in bpe.Merger(ranks).merge(pieces)]
    assert b"".join({v: k for k, v in ranks.items()}[i] for ids in got for i in ids) == b"".join(pieces)
    assert got[1:] == [bpe.merge_piece(p, ranks) for p in pieces[1:]]


def test_other_columns_and_no_blank_rule(spark, ranks, own):
    raw = bpe.vocabulary(public_tokenizers.path(NAME))
    df = spark.createDataFrame([("a b", 1, "x"), (None, 2, "y")], "text string, token_ids int, Decoded string")
    out = bpe.decode(bpe.encode(df, "text", raw, public_tokenizers.PATTERN), "token_ids", raw)
    rows = out.select("text", "token_ids", F.col("decoded").cast("string").alias("d")).collect()
    assert sorted((r.text or "", r.token_ids, r.d) for r in rows) == [("", [], ""), ("a b", own.encode_ordinary("a b"), "a b")]


def encoder(monkeypatch, spark, raw, pattern, **options):
    """The task of ``encode``, and how often it called the splitter."""
    import regex

    held, calls, compiled = [], [], regex.compile

    class Counted:
        def __init__(self, splitter):
            self.splitter = splitter

        def findall(self, text):
            calls.append(text)
            return self.splitter.findall(text)

    monkeypatch.setattr(regex, "compile", lambda p: Counted(compiled(p)))
    monkeypatch.setattr(bpe, "appended", lambda df, function, *fields, **more: held.append(function))
    bpe.worker_store("bpe").clear()
    bpe.encode(spark.createDataFrame([("a",)], "text string"), "text", raw, pattern, **options)
    return held[0], calls


def ids_of(function, texts):
    return [x for batch in function(iter([pa.record_batch([pa.array(texts)], names=["text"])])) for x in batch.column(1).to_pylist()]


def test_unseen_words_are_split_together(spark, monkeypatch, own):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdeé.'s1") for _ in range(6)) for _ in range(300)) for _ in range(10)] + ["", "one", " \n x", "a  b"]
    function, calls = encoder(monkeypatch, spark, bpe.vocabulary(public_tokenizers.path(NAME)), public_tokenizers.PATTERN, blanks_part=True)
    assert ids_of(function, texts) == [own.encode_ordinary(t) for t in texts]
    assert len(calls) <= len(texts) + 1  # the first word of each text, and all others at once
    assert ids_of(function, texts) == [own.encode_ordinary(t) for t in texts]
    assert ids_of(function, ["one"]) == [own.encode_ordinary("one")]
    bpe.worker_store("bpe").clear()


def test_pattern_that_leaves_characters_out(spark, monkeypatch, ranks):
    function, _ = encoder(monkeypatch, spark, bpe.vocabulary(public_tokenizers.path(NAME)), "[a-z]+", blanks_part=True)
    assert ids_of(function, ["ab 12 cd!e", "7", " z"]) == [[i for w in words for i in bpe.merge_piece(w, ranks)] for words in ([b"ab", b"cd", b"e"], [], [b"z"])]
    bpe.worker_store("bpe").clear()
