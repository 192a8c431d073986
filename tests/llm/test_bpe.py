import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfspark.llm import bpe

SF = "/root/testdata/sf0.001"
LIB = Tokenizer.from_file(bpe.VOCABULARY)


def plain(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return np.asarray(ids, dtype="<u4").tobytes(), LIB.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("bits", [2, 4, 10])
def test_equals_the_library(bits, monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    rng = random.Random(bits)
    bits_of = ["the", "don't", "Éa", "é", "́", "1234", "<|endoftext|>", "<|startoftext|>x", " ", " ",
               "日本語", "🙂🙂", "it's", "'", "''s", "--", "\x00", "İI", "ß", "a" * 50, "\x85", "Σς", "ﬁ", "한글"]
    seps = [" ", "  ", "\n", "\t", "", "\r\n", " ", "\x0b"]
    texts = ["".join(rng.choice(bits_of) + rng.choice(seps) for _ in range(rng.choice([0, 1, 5, 200]))) for _ in range(300)]
    texts += texts[:50]
    coder = bpe.Coder(bpe.VOCABULARY)
    assert coder.encode(texts) == [plain(t) for t in texts]
    assert coder.encode(texts[::-1]) == [plain(t) for t in texts[::-1]]


def test_cuts_follow_content():
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 122, size=20_000, dtype=np.uint8)
    a, b = (np.concatenate([rng.integers(97, 122, size=n, dtype=np.uint8), shared]) for n in (101, 977))
    zero = np.zeros(1, dtype=np.int64)
    ca, cb = bpe.cut_points(a, zero) - 101, bpe.cut_points(b, zero) - 977
    assert len(ca) > 10
    assert set(ca[ca > bpe.WINDOW]) == set(cb[cb > bpe.WINDOW])


def test_query_equals_the_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in bpe.query(spark, SF).collect():
        ids, text = plain(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark, make_docs):
    long = "x" * 300_000
    docs = make_docs([(1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "a b"), (None, "c"), (5, long), (6, "w " * 40_000)])
    docs = docs.withColumn("ids", F.lit(1)).withColumn("N_tokens", F.lit("x"))
    out = bpe.encode_documents(docs, keep=True)
    got = sorted(((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in out.collect()), key=lambda r: (r[0], r[2]))
    want = [(0, "c"), (1, ""), (2, ""), (3, ""), (4, "a b"), (4, "a b"), (5, long), (6, "w " * 40_000)]
    for g, (i, t) in zip(got, want, strict=True):
        ids, text = plain(t)
        assert g == (i, np.frombuffer(ids, dtype="<u4").tolist(), text)
    assert bpe.encode_documents(docs.where("false")).count() == 0


def test_words_are_given_to_the_library_together(monkeypatch):
    """New words of one step are few texts for the library, with the ids of each word alone."""
    coder = bpe.Coder(bpe.VOCABULARY)
    calls = []

    class Counted:
        def __getattr__(self, name):
            return getattr(lib, name)

        def encode_batch(self, texts, **kw):
            calls.append(len(texts))
            return lib.encode_batch(texts, **kw)
    lib, coder.lib = coder.lib, Counted()
    words = {f"w{i}é<|endoftext|>́x{i}".encode() for i in range(1000)} | {"́".encode(), b"\x00", " ".encode(), b"Don't"}
    coder._learn(words)
    assert sum(calls) <= len(words) // bpe.TOGETHER + 1
    assert {w: coder.words[w] for w in words} == {w: plain(w.decode()) for w in words}
