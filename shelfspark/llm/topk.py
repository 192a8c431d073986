"""Exact top-k inner products with a three-phase uniform threshold.

Components become integers, floor(256 * x). Each vector is split into ``LISTS`` lists of
dimensions; a list knows the partial scores of its dimensions only. For every query:

1. each list's blocks of rows give their k best partial scores; the exact scores of the rows named
   there give a safe cutoff t, the k-th best of them: the true k-th score is no lower;
2. the query is sent out again with t, and each list gives all entries with a partial score of at
   least t / LISTS. A row below that in every list scores less than t, so nothing is missed;
3. rows that are known in all lists have their score as the sum; the remaining are resolved from
   their vectors, and the k best stay.

The query set meets all rows in blocks of bounded size. Equal vectors are one class, of which only
the k + 1 smallest ids can matter, so thousands of copies are neither scored nor returned as pairs.

Defined results: a vector that is null or holds a null or non-finite component, or has no vec_id,
takes no part; only vectors of one length are compared; rows equal in vec_id and vector count
once, or with ``every_row`` as often as they come (each is a query, and a candidate of all others, as
the query has it); ties go to the smaller vec_id; fewer than k candidates give all; empty tables give no
rows; other columns are not read. Components beyond 2 ** 62 (``FAR``) count as that. The part of a score that a list gives is
exact if its products, without their signs, sum to less; else it is taken to double precision and to 2 ** 61 at most, so
that every score fits a signed 64-bit integer.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import cut

K, LISTS, EVERY = 5, 2, 50
#: Bound of quantised components and of sums that are taken in 64-bit integers.
FAR = 1 << 62
#: Rows and queries of a block.
ROWS, QUERIES = 4096, 1024


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, q) of the vectors that take part."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.coalesce(fine, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, _quantum).alias("q")))


def _quantum(v: Column) -> Column:
    wide = v.cast("double") * 256
    return F.when(F.abs(wide) < float(FAR), F.floor(wide).cast("long")).otherwise(F.when(wide > 0, F.lit(FAR)).otherwise(F.lit(-FAR)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column]) if len(column) else np.zeros((0, 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``; by floating point where that is exact."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a @ b.T
    reach = np.abs(a).astype(np.float64) @ np.abs(b).astype(np.float64).T
    if (reach < FAR).all():
        return exact
    near = np.clip(a.astype(np.float64) @ b.astype(np.float64).T, -FAR / 2, FAR / 2).astype(np.int64)
    return np.where(reach < FAR, exact, near)


def _cells(rows: DataFrame, asked: DataFrame, n_rows: int, n_asked: int, fn, schema: str) -> DataFrame:
    """Runs ``fn(rows, queries, list)`` for each list, block of rows and block of queries."""
    def lists(df):
        size = F.ceil(F.col("dim") / LISTS).cast("int")
        parts = F.array(*[F.struct(F.lit(j).alias("j"), F.slice("q", F.lit(j) * size + 1, size).alias("part"))
                          for j in range(LISTS)])
        return df.withColumn("l", F.explode(parts)).select(*[c for c in df.columns if c != "q"], "l.j", "l.part")

    spread = lambda df, n, own, other, m: (
        df.withColumn(own, F.pmod(F.xxhash64("cid"), F.lit(n)))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))
    left = spread(lists(rows), n_rows, "rb", "qb", n_asked)
    right = spread(lists(asked), n_asked, "qb", "rb", n_rows)
    key = ["dim", "j", "rb", "qb"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(fn, schema)


def _best(k: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            s = products(_matrix(asked["part"]), _matrix(rows["part"]))
            ids = rows["cid"].to_numpy()
            n = min(k + 1, len(ids))
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            for i, (cid, solo) in enumerate(zip(asked["cid"], asked["solo"], strict=True)):
                out += [(cid, ids[j], s[i, j]) for j in top[i] if not (solo and ids[j] == cid)]
        return pd.DataFrame(out, columns=["qcid", "cid", "partial"]).assign(j=int(asked["j"].iloc[0]) if len(asked) else 0)
    return run


def _above(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    out = {"qcid": [], "cid": [], "partial": []}
    if len(rows) and len(asked):
        s = products(_matrix(asked["part"]), _matrix(rows["part"]))
        ids = rows["cid"].to_numpy()
        for i, (cid, solo, t) in enumerate(zip(asked["cid"], asked["solo"], asked["cutoff"], strict=True)):
            hit = np.ones(len(ids), bool) if pd.isna(t) else s[i] >= -(-int(t) // LISTS)
            if solo:
                hit &= ids != cid
            out["qcid"].append(np.full(hit.sum(), cid))
            out["cid"].append(ids[hit])
            out["partial"].append(s[i, hit])
    return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})


def _dot(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact scores of (qcid, cid) pairs from their vectors."""
    a = classes.select(F.col("cid").alias("qcid"), F.col("q").alias("qv"), F.col("top").alias("qtop"))
    both = pairs.join(a, "qcid").join(classes.select("cid", "q", "top"), "cid")
    simple = F.aggregate(F.zip_with("qv", "q", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    small = F.col("top") * F.col("qtop") * F.size("q") < float(FAR)
    size = F.ceil(F.size("q") / LISTS).cast("int")

    def part(j: int) -> Column:
        x, y = (F.slice(c, F.lit(j) * size + 1, size) for c in ("qv", "q"))
        wide = F.zip_with(x, y, lambda a, b: a.cast("double") * b)
        reach = F.aggregate(wide, F.lit(0.0), lambda s, v: s + F.abs(v))
        exact = F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0).cast("long"), lambda s, v: s + v)
        near = F.aggregate(wide, F.lit(0.0), lambda s, v: s + v)
        near = F.least(F.greatest(near, F.lit(-FAR / 2)), F.lit(FAR / 2)).cast("long")
        return F.when(reach < float(FAR), exact).otherwise(near)
    by_list = reduce(lambda a, b: a + b, map(part, range(LISTS)))
    return both.select("qcid", "cid", F.when(small, simple).otherwise(by_list).alias("score"))


def top_k(vectors: DataFrame, is_query, k: int = K, every_row: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row where ``is_query`` (a condition on vec_id)."""
    rows = quantised(vectors)
    rows = cut(rows if every_row else rows.distinct(), "vectors")
    n = F.row_number().over(Window.partitionBy("q").orderBy("vec_id"))
    members = rows.withColumn("n", n).where(F.col("n") <= k + 1)
    classes = members.groupBy("q").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))   # k + 1 ids at most
    classes = classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("q"))
    top = F.coalesce(F.array_max(F.transform("q", F.abs)), F.lit(0)).cast("double")
    classes = cut(classes.withColumn("solo", F.size("ids") == 1).withColumn("top", top), "vector-classes")
    queries = cut(rows.where(is_query).join(classes.select("q", "cid"), "q").select("vec_id", "cid"), "queries")
    asked = cut(classes.join(queries.select("cid").distinct(), "cid", "left_semi").select("cid", "q", "dim", "solo"), "asked")
    base = classes.select("cid", "q", "dim")
    n_rows = -(-max(1, base.count()) // ROWS)
    n_asked = -(-max(1, asked.count()) // QUERIES)

    named = _cells(base, asked, n_rows, n_asked, _best(k), "qcid long, cid long, partial long, j int")
    first = Window.partitionBy("qcid", "j").orderBy(F.desc("partial"), "cid")
    named = named.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k).select("qcid", "cid").distinct()
    by_score = Window.partitionBy("qcid").orderBy(F.desc("score"), "cid")
    cutoff = (_dot(named, classes).withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k)
              .select(F.col("qcid").alias("cid"), F.col("score").alias("cutoff")))
    asked = cut(asked.join(cutoff, "cid", "left"), "asked-again")

    entries = _cells(base, asked, n_rows, n_asked, _above, "qcid long, cid long, partial long")
    got = entries.groupBy("qcid", "cid").agg(F.sum("partial").alias("score"), F.count("*").alias("known"))
    got = cut(got, "entries")
    exact = got.where(F.col("known") == LISTS).select("qcid", "cid", "score").union(
        _dot(got.where(F.col("known") < LISTS).select("qcid", "cid"), classes))
    single = exact.join(classes.select("cid", F.explode("ids").alias("vec_id")), "cid")
    order = Window.partitionBy("qcid").orderBy(F.desc("score"), "vec_id", "cid")
    best = (single.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
            .select("qcid", "n", "cid", "vec_id", "score"))
    lists = best.groupBy("qcid").agg(F.array_sort(F.collect_list(F.struct("n", "cid", "vec_id", "score"))).alias("best"))
    per = queries.withColumnsRenamed({"vec_id": "query_id", "cid": "qcid"}).join(lists, "qcid")
    own = F.filter("best", lambda b: (b["cid"] == F.col("qcid")) & (b["vec_id"] == F.col("query_id")))
    per = per.withColumn("own", F.get(own, 0)["n"])     # one row is the query's own; its repeats are others
    others = F.slice(F.filter("best", lambda b: F.col("own").isNull() | (b["n"] != F.col("own"))), 1, k)
    return (per.select("query_id", F.posexplode(others).alias("p", "b"))
            .select("query_id", (F.col("p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")))


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.expr(f"vec_id % {EVERY} = 0"), every_row=True)


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
