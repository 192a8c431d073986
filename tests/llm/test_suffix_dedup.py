import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import induced_sort, suffix_dedup as S

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), len(t) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


def rows(df):
    return sorted(((r["doc_id"] or 0), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_repeated_places_equal_brute_force(small, monkeypatch):
    if small:      # queues on disk, blocks of a few entries
        monkeypatch.setattr(induced_sort, "BLOCK", 4)
        monkeypatch.setattr(induced_sort, "MEMORY", 60)
    rng = random.Random(small)
    for _ in range(150):
        cap, k, parts = rng.choice([1, 2, 3, 5, 8]), rng.choice([1, 2, 3, 6]), []
        for _ in range(rng.randint(1, 6)):
            f = [rng.randint(1, k) for _ in range(rng.randint(0, 40))]
            parts.append(f[:5] + rng.choice(parts)[:rng.randint(0, 30)] if parts and rng.random() < 0.5 else f)
        t = [x for f in parts for x in [*f, 0]]
        seen = Counter(tuple(t[i:i + cap]) for i in range(len(t) - cap + 1))
        got = induced_sort.repeated_places(np.asarray(t, dtype=np.uint16), cap)
        for i in range(len(t) - cap + 1):
            w = tuple(t[i:i + cap])
            assert 0 in w or got[i] == (seen[w] > 1)


@pytest.mark.parametrize("length,seed", [(8, 0), (8, 1), (40, 2), (200, 3)])
def test_equals_brute_force(spark, make_docs, length, seed, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 4000)
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abé ") for _ in range(rng.randint(1, 4 * length))) for _ in range(6)]
    texts = ["".join(rng.choice([rng.choice(shared), "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, length))), "z" * length])
                     for _ in range(rng.randint(0, 5))) for _ in range(60)]
    got = rows(S.remove_repeats(make_docs(texts), length))
    assert got == [(i, *r) for i, r in enumerate(brute([t.encode() for t in texts], length))]
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("window", [64, 500])
def test_hot_anchors_are_split(spark, make_docs, monkeypatch, window):
    """One sentence between unlike neighbours in every document: no shard gets all of its fragments."""
    length, most, sort = 60, 3000, S.repeated_places
    monkeypatch.setattr(S, "SHARD_BYTES", most)
    monkeypatch.setattr(S, "WINDOW", window)
    rng = random.Random(window)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    hot, edge, near = noise(50), noise(59), noise(61)
    texts = [noise(rng.randint(20, 90)) + x + noise(rng.randint(20, 90)) for x in [hot, edge, near] * 100]
    texts += [noise(40) + texts[i] for i in (0, 1, 2)] + [noise(700) + texts[5] * 3]

    def bounded(text, n):
        assert len(text) < 8 * most
        return sort(text, n)

    monkeypatch.setattr(S, "repeated_places", bounded)
    got = rows(S.remove_repeats(make_docs(texts), length))
    assert got == [(i, *r) for i, r in enumerate(brute([t.encode() for t in texts], length))]
    assert all(r[2] for r in got[2:300:3])


def test_open_files_do_not_grow_with_the_shards(spark, make_docs, monkeypatch):
    """Tasks that may open 30 files more get through hundreds of shards."""
    length, read = 40, S.text_batches

    def few_files(batches):
        import os
        import resource
        limits = resource.getrlimit(resource.RLIMIT_NOFILE)
        resource.setrlimit(resource.RLIMIT_NOFILE, (max(map(int, os.listdir("/proc/self/fd"))) + 30, limits[1]))
        try:
            yield from read(batches)
        finally:
            resource.setrlimit(resource.RLIMIT_NOFILE, limits)

    monkeypatch.setattr(S, "SHARD_BYTES", 500)
    monkeypatch.setattr(S, "text_batches", few_files)
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = [noise(rng.randint(30, 90)) for _ in range(150)]
    texts = [noise(20) + a + noise(20) + rng.choice(shared) for a in shared for _ in range(3)]
    texts += [noise(30) + shared[0] + noise(30) for _ in range(60)]      # its anchors are hot
    got = rows(S.remove_repeats(make_docs(texts), length))
    assert got == [(i, *r) for i, r in enumerate(brute([t.encode() for t in texts], length))]


def test_query_equals_brute_force(spark):
    docs = sorted((r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute([t for _, t in docs], 200)
    assert rows(S.query(spark, SF)) == [(i, *w) for (i, _), w in zip(docs, want, strict=True)]


def test_odd_rows(spark, make_docs):
    text = "".join(random.Random(4).choice("abcdef") for _ in range(5000))
    docs = make_docs([(1, None), (2, ""), (3, "short"), (3, "short"), (4, text), (4, text), (None, "x" * 300_000), (5, "x" * 199), (6, text[:199])])
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("h", F.lit(1))
    out = S.remove_repeats(docs, keep=True).collect()
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out)
    assert got == [(0, 300_000, 300_000, 1, b""), (1, 0, 0, 0, b""), (2, 0, 0, 0, b""), (3, 5, 0, 0, b"short"), (3, 5, 0, 0, b"short"),
                   (4, 5000, 5000, 1, b""), (4, 5000, 5000, 1, b""), (5, 199, 0, 0, b"x" * 199), (6, 199, 0, 0, text[:199].encode())]
    assert S.remove_repeats(docs.where("false")).count() == 0
