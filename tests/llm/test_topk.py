import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm import topk

SF = "/root/testdata/sf0.001"
KIND = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows, every, k=5):
    import struct
    ok = {(i, tuple(math.floor(256 * struct.unpack("f", struct.pack("f", x))[0]) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in ok:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if (j, v) != (i, q) and len(v) == len(q))
            out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, every):
    df = spark.createDataFrame(rows, KIND).withColumn("q", F.lit("clash")).withColumn("cid", F.lit(1))
    return sorted(tuple(r) for r in topk.top_k(df, F.expr(f"vec_id % {every} = 0")).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(seed)
    base = [[rng.choice([-0.5, 0.25, 0.01, 1.5]) for _ in range(3 + seed)] for _ in range(30)]
    rows = [(i, rng.choice(base) if rng.random() < 0.6 else [rng.gauss(0, 1) for _ in range(3 + seed)]) for i in range(200)]
    assert run(spark, rows, 9) == brute(rows, 9)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [-1.0, -2.0]), (6, [1.0]), (7, [2.0]), (None, [1.0, 1.0]), (8, []), (10, [1e9, 1e9]), (20, [1.0, 2.0]), (30, [4.0])]
    assert run(spark, rows, 10) == brute(rows, 10)
    assert run(spark, rows[:1], 10) == []
    assert run(spark, [], 10) == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    out = topk.query(spark, SF)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    assert got == sorted(con.execute(topk.SQL).fetchall())
    assert len(got) == 50


def test_vectors_beyond_a_long(spark):
    """Finite components whose products no long can hold: no crash, and scores that fit are exact."""
    rows = [(0, [1.0, 2.0]), (1, [1e30, 1.0]), (2, [-1e30, 0.5]), (3, [3.0, 1.0]), (4, [5e6, -5e6]), (50, [5e6, 5e6]),
            (5, [2.0 ** 23, 2.0 ** 23]), (6, [1e9, 1e9]), (100, [1.7e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.expr("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect())
    q = {i: [max(-2 ** 62, min(2 ** 62, math.floor(256 * x) if abs(x) < 1e300 else 2 ** 62)) for x in v] for i, v in rows}

    def score(a, b):     # one component in each of the two lists
        return sum(x * y if abs(x * y) < 2 ** 62 else max(-2 ** 61, min(2 ** 61, x * y)) for x, y in zip(q[a], q[b], strict=True))
    want = []
    for a in (0, 50, 100):
        best = sorted((-score(a, b), b) for b in q if b != a)[:5]
        want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(best)]
    assert got == sorted(want)


def test_repeated_rows_are_candidates_of_their_own(spark, tmp_path):
    """The query: every row but the query's own is a candidate, so a row that comes twice takes two places."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.25, 1.5]) for _ in range(3)]) for i in range(1, 60)]
    rows += rows[:20] * 2 + [r for r in rows if r[0] == 50] + [(100, [0.25, 1.5, -0.5])]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/embeddings.parquet")
    ok = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows]
    want = []
    for n, (i, q) in enumerate(ok):
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in enumerate(ok) if m != n)[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    got = topk.query(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
