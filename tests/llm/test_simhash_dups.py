import random

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfspark.llm import simhash_dups as S

SF = "/root/testdata/sf0.001"


def plain_fp(text, size=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def brute_roots(fps, max_bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fl = sorted(fps)
    for i, a in enumerate(fl):
        for b in fl[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def clustered(rng, n):
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            v = base
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.randrange(64)
            out.add(signed(v))
            base = v if rng.random() < 0.3 else base
    return out


@pytest.mark.parametrize("max_bits,bucket", [(1, 64), (2, 64), (2, 2), (3, 64), (3, 2)])
def test_components_equal_all_pairs(spark, max_bits, bucket):
    fps = clustered(random.Random(max_bits * 10 + bucket), 40)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["fp"]: r["root"] for r in S.classes(df, max_bits, bucket).collect()}
    assert got == brute_roots(fps, max_bits)


def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: plain_fp(t) for i, t in docs.items()}
    roots = brute_roots({signed(f) for f in fps.values()}, 2)
    low = {}
    for i, f in fps.items():
        r = roots[signed(f)]
        low[r] = min(low.get(r, i), i)
    want = {i: (f"{f:016x}", low[roots[signed(f)]]) for i, f in fps.items()}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.query(spark, SF).collect()}
    assert got == want


def test_hash_equals_the_jvm_one(spark):
    df = spark.createDataFrame([("Ça va b",)], "s string").select(F.xxhash64("s").alias("h"))
    assert S.shingles("Ça VA\tb c", 3)[0] == "Ça va b".encode()
    assert signed(xxhash.xxh64_intdigest("Ça va b".encode(), S.SEED)) == df.head()[0]


def test_odd_rows(spark, make_docs):
    long = "word " * 50_000
    docs = make_docs([(5, None), (3, ""), (9, " \t "), (7, "a b"), (8, "A  b"), (1, long), (1, long), (None, "x y z q")])
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in S.near_duplicates(docs).collect())
    assert got == [(0, None), (1, 1), (1, 1), (3, 3), (5, 3), (7, 7), (8, 7), (9, 3)]
    assert S.near_duplicates(docs.where("false")).count() == 0


def test_stage_keeps_one_row_of_each_group(spark, make_docs):
    docs = make_docs([(4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (6, "other words than these here"),
                      (None, "p q r"), (None, "p q r")]).withColumn("th", F.lit("x")).withColumn("fp", F.lit(1))
    out = S.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 2, 6]


def test_stage_keeps_unlike_texts_without_ids_and_of_one_id(spark, make_docs):
    unlike = ["alpha beta gamma delta", "one two three four five", "rain falls on the old roof", "ships sail past the far cape"]
    docs = make_docs([(None, t) for t in unlike] + [(None, unlike[0]), (1, "green trees stand in rows"), (1, "he reads a long book"),
                      (2, "he reads a long book")])
    got = sorted((r["doc_id"] or 0, r["text"]) for r in S.stage(spark, docs, "").collect())
    assert got == sorted([(0, t) for t in unlike] + [(1, "green trees stand in rows"), (1, "he reads a long book")])


def test_stage_carries_clashing_names(spark, make_docs):
    from shelfspark.llm import simhash_dups
    docs = make_docs([(1, "a b c d"), (2, "a b c d"), (3, "quite another text")]).withColumn("_th", F.lit("own")).withColumn(
        "_TH_", F.lit("too")).withColumn("root", F.lit("r"))
    out = simhash_dups.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["_th"], r["_TH_"], r["root"]) for r in out.collect()) == [(1, "own", "too", "r"), (3, "own", "too", "r")]
