"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into a ring of equal segments. If two fingerprints differ in at most
``max_bits`` bits, some segment starts a chain in which, for every length l, the summed
differences of the first l segments stay within l * max_bits / segments. Budgets below one bit
mean equal segments, so the chain's first segments are a join key; the rest of the chain is
tested with its growing budgets before the full Hamming check.

Buckets of the join key with more than ``BUCKET`` fingerprints are not paired. Their members
send themselves to all points within half of the radius, and every point links all that met
there to one of them: linear in the members, and exact, since two fingerprints within the
radius always share such a point and two that share one are within the radius.

Equal fingerprints are one class before any linking. Links become components by star steps.

Defined results: null or blank text has no words and fingerprint zero, linked like any other; the
component of documents without any doc_id is null; repeated rows and ties each keep their row;
an empty table gives no rows; extra columns are not read, and stages carry them through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import components, cut, free_name, text_batches, texts_of

#: Largest bucket that is paired member by member.
BUCKET = 64
#: Bytes of texts whose shingles are hashed at once: a task holds some hundred times as much for a moment.
STEP_BYTES = 512 << 10
SEED = 42


def shingles(text: str, size: int) -> list[bytes]:
    """Space-joined runs of ``size`` words, repeats included; fewer words: all of them; none: nothing."""
    w = text.encode("utf-8", "replace").lower().split()
    if len(w) < size:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*[w[i:] for i in range(size)], strict=False)))


def fingerprints(texts: list[str], size: int) -> np.ndarray:
    """64-bit majority fingerprints as signed longs; no shingles: zero."""
    digest = xxhash.xxh64_intdigest
    flat: list[int] = []
    ends = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        flat.extend([digest(s, SEED) for s in shingles(t, size)])
        ends[i] = len(flat)
    starts = np.concatenate(([0], ends[:-1]))
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(ends > starts)
    if len(full):
        h = np.asarray(flat, dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int64)
        major = ones * 2 > (ends - starts)[full][:, None]
        out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out.view(np.int64)


def fingerprint_documents(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, th, fp) of every row; th: a hash of the text, fp: the fingerprint as a long."""
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")

    def run(batches):
        for b in text_batches(batches, STEP_BYTES):
            fp = pa.array(fingerprints(texts_of(b), size))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], names=["doc_id", "th", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, th long, fp long")


def ring(max_bits: int) -> tuple[int, int, int]:
    """Segments, bits of a segment, and equal segments at the head of a chain."""
    n = min(64, 8 << max(0, (max_bits - 1)).bit_length()) if max_bits else 1
    head = n if max_bits == 0 else -(-n // max_bits) - 1
    return n, 64 // n, head


def _turned(x, by: str):
    """The bits of ``x`` turned left around the ring."""
    return f"(shiftleft({x}, {by}) | (CASE WHEN {by} = 0 THEN 0 ELSE shiftrightunsigned({x}, 64 - {by}) END))"


def _ball(radius: int) -> list[int]:
    """All 64-bit patterns of at most ``radius`` bits, as signed longs."""
    out = [0]
    level = [(0, 0)]
    for _ in range(radius):
        level = [(v | (1 << b), b + 1) for v, lo in level for b in range(lo, 64)]
        out += [v for v, _ in level]
    return [v - (1 << 64) if v >> 63 else v for v in out]


def links(fps: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within ``max_bits``."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    spark = fps.sparkSession
    if max_bits == 0:
        return spark.createDataFrame([], "a long, b long")
    n, width, head = ring(max_bits)
    by = f"start * {width}"
    seg = (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("start"))
           .withColumn("key", F.expr(f"shiftrightunsigned({_turned('fp', by)}, {64 - head * width})")))
    sizes = cut(seg.groupBy("start", "key").count().where("count > 1"), "simhash-buckets")
    few = seg.join(sizes.where(F.col("count") <= bucket).drop("count"), ["start", "key"])
    other = few.withColumnRenamed("fp", "other")
    diff, chain = "(fp ^ other)", []
    for length in range(head + 1, n + 1):
        budget = length * max_bits // n
        if length == n or (length + 1) * max_bits // n > budget:   # the tightest test of each budget
            mask = -1 if length == n else ((1 << (length * width)) - 1) << (64 - length * width)
            mask = mask - (1 << 64) if mask >> 63 == 1 else mask
            chain.append(f"bit_count({_turned(diff, by)} & {mask}L) <= {budget}")
    pairs = (few.join(other, ["start", "key"]).where("fp < other")
             .where(" AND ".join(chain)).select(F.col("fp").alias("a"), F.col("other").alias("b")))
    many = seg.join(sizes.where(F.col("count") > bucket).drop("count"), ["start", "key"]).select("fp").distinct()
    wide, near = _ball(-(-max_bits // 2)), len(_ball(max_bits // 2))
    met = many.select("fp", F.posexplode(F.array(*[F.lit(v) for v in wide])).alias("i", "v")).select(
        F.col("fp").bitwiseXOR(F.col("v")).alias("point"), "fp", (F.col("i") < near).alias("close"))
    centre = met.groupBy("point").agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("b"), F.count("*").alias("c"))
    stars = met.join(centre.where("b is not null and c > 1").drop("c"), "point").where("fp <> b").select(
        F.col("fp").alias("a"), "b")
    return pairs.union(stars)


def classes(rows: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint, root its smallest fingerprint."""
    fps = rows.select("fp").distinct()
    roots = components(links(fps, max_bits, bucket), "simhash-links")
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, th, fp, root, component_id): root, the smallest fingerprint, tells components apart;
    component_id is the smallest doc_id that can be reached."""
    rows = cut(fingerprint_documents(docs, size), "simhash-rows")
    low = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    member = cut(low.join(classes(low, max_bits, bucket), "fp"), "simhash-classes")
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = member.join(least, "root").select("fp", "root", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "th", "fp", "root", "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str, size: int = 3, max_bits: int = 2) -> DataFrame:
    """Pipeline stage: the row of the smallest doc_id of each component stays (no row with one: the least text hash)."""
    found = near_duplicates(docs, size, max_bits)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k"))
    best = cut(best.select("k.doc_id", "k.th"), "simhash-kept").alias("k")
    own = free_name(docs, "_th")
    d = docs.withColumn(own, F.xxhash64("text")).alias("d")
    kept = d.join(best, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{own}") == F.col("k.th")), "left_semi")
    again = found.groupBy("doc_id", "th").count().where("count > 1").limit(1).count()
    if again:   # the same row more than once: one stays
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
