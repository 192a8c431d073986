"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.session import scratch_path

WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names, whatever their case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_batches(batches, step_bytes: int = 4 << 20):
    """Re-slice Arrow batches so that one holds about ``step_bytes`` at most, or a single row."""
    for b in batches:
        if not b.num_rows:
            continue
        rows = max(1, int(b.num_rows * step_bytes / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [s or "" for s in batch.column(batch.schema.names.index(name)).to_pylist()]


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str, cut_name: str) -> DataFrame:
    """Add ``name``: the gapless 0-based rank of each row in its group, without gathering a group in one task.

    Rows are range-partitioned by (group, order), written once, numbered inside each
    (partition, group) and shifted by the counts of the group in earlier partitions; the
    offsets are one row for each partition and group. Ties are broken by the row's place
    in the written partition, so rows that are equal in ``order`` get distinct ranks.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
    placed = cut(placed.withColumn("_at", F.monotonically_increasing_id())
                 .withColumn("_part", F.shiftright("_at", 33)), cut_name)
    firsts = placed.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offs = firsts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ["_part", *group]]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    return (placed.alias("a").join(offs.alias("b"), cond)
            .select(*[F.col(f"a.{c}") for c in df.columns],
                    (F.col("a._at") - F.col("b._first") + F.col("b._off")).cast("long").alias(name)))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: non-null longs): rows (node, root), root the smallest node.

    Alternating large-star and small-star steps: each is a grouped minimum and a join, so a
    node with very many neighbours is combined map-side and its join is split by adaptive
    execution. Every step is written to the shared folder; the loop ends when a step
    changes no edge, seen by count and an order-free sum of hashes.
    """
    def mark(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        return r[0], r[1]

    def star(e, large):
        if large:
            both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        j = both.join(low, "a")
        out = j.where(F.col("b") > F.col("a")) if large else j.where(F.col("b") != F.col("m"))
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            name)
    before = mark(e)
    while before[0]:
        e = cut(star(star(e, True), False), name)
        now = mark(e)
        if now == before:
            break
        before = now
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
