import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import exact_dups as X


def brute(rows):
    """(doc_id, text) rows -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, g in groups.items():
        g.sort(key=lambda r: r[:3])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r[3], g[0][3], len(g), k == 0, sha) for k, r in enumerate(g)]
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [(1, "a b"), (2, "ab "), (3, "a\tb\n"), (-5, "ab "), (4, None), (5, ""), (6, " \r"), (None, "a  b"), (None, None),
       (7, "a b"), (8, "été"), (9, "été"), (10, "\U0001F600 x"), (11, "\U0001F600x"),
       (12, "same"), (12, "same"), (13, "A b"), (2 ** 63 - 1, "big"), (-(2 ** 63), "big"), (None, "big"), (None, "big")]


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(1)])
def test_equals_brute_force_whatever_the_digest(make_docs, digest):
    """With weak digests unlike texts collide all the time: content alone decides."""
    assert got(X.exact_groups(make_docs(ODD), digest=digest)) == brute(ODD)


def test_hot_groups_are_salted(spark, make_docs, monkeypatch):
    monkeypatch.setattr(X, "LEAST", 20)
    rows = [(i, "hot text" + " " * (i % 7)) for i in range(300)] + [(1000 + i, f"t {i // 2}") for i in range(100)]
    rows += [(None, None)] * 60
    docs = make_docs(rows).repartition(13)
    assert got(X.exact_groups(docs)) == brute(rows)
    assert got(X.exact_groups(docs, digest=lambda c: F.length(c).cast("long"))) == brute(rows)


def test_empty_table_clashing_columns_and_long_text(spark, make_docs):
    assert X.exact_groups(make_docs([])).collect() == []
    names = ["digest", "norm", "rank", "uid", "salts", "slot", "best", "n", "kept", "keep_id"]
    docs = make_docs([(1, "x y"), (2, "xy")]).select("*", *[F.lit("z").alias(n) for n in names])
    assert got(X.exact_groups(docs)) == brute([(1, "x y"), (2, "xy")])
    rows = [(1, "ab c" * 600_000 + "x"), (2, "ab c" * 600_000 + "y"), (3, "abc" * 600_000 + "x")]
    assert got(X.exact_groups(make_docs(rows))) == brute(rows)


def test_plan_combines_before_each_shuffle(spark, make_docs):
    hot = spark.createDataFrame([(0, 2)], "digest long, salts int")
    texts = make_docs(ODD).select(F.xxhash64("text").alias("digest"), F.col("text").alias("norm"),
                                  X.rank(F.col("text"), F.col("doc_id")).alias("rank"))
    plan = X.winners(texts, hot)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max(rank") == 2 and plan.count("partial_max(best") == 1
    assert "SortAggregate" not in plan
