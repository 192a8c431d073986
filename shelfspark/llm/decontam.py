"""Benchmark decontamination with SimHash windows, in DataFrame operations only.

For each size of a benchmark item, windows of as many words slide over a document. A window and an
item are compared as weighted sets of five-word shingles (an item of fewer words: the words as one
shingle) and match at a weighted Jaccard similarity of 0.8 or more.

1. Screen, without loss: such a window holds s/(1+s) of both sides' shingles at places that the item
   knows, and can be moved so that it starts at such a place (or ends with the document). Windows
   below that count cannot match, so they get no fingerprint.
2. Fingerprint: the 64-bit SimHash of the weighted shingles of windows and items; equal windows once.
3. Multi-index Hamming blocks: 64 bits in ``BLOCKS`` blocks. Two fingerprints within ``RADIUS`` bits
   agree in some block up to RADIUS // BLOCKS bits, and items are entered under all values that
   close, so an equi-join on (size, block, value) guarantees every pair within the radius.
4. Verification: the exact weighted similarity.

The radius fits pairs of many distinct shingles: at a similarity of exactly 0.8 their expected distance is under
10 bits with a standard deviation under 3, so RADIUS = 20 is some 3.5 deviations off. Where few or repeated
shingles let bits fall together, a fingerprint promises less: the screened pairs of an item of fewer than
``SMOOTH`` distinct shingles, of an item that repeats one, and of a window that does, go to the verification
whatever their distance. Tests compare with brute force over all windows.

Words are lower-cased and split at ASCII white space. A document shorter than an item is one
window. Defined results: null or blank texts of documents or items match nothing; an item without
an id reports a null item_id; equal items are each reported; repeated rows are treated alike; empty
tables give no rows; extra columns are not read, and the stage carries them through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, free_name

SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 20, 7
#: Distinct shingles from which on the radius alone decides, if none is repeated.
SMOOTH = 32
#: Rows of the items' shingles up to which they are broadcast; beyond, Spark joins by shuffle.
BROADCAST_ROWS = 500_000
_WS = " \\t\\n\\u000b\\f\\r"


def _words(df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and the words of the text; texts without words go."""
    clean = F.expr(f"trim(BOTH '{_WS}' FROM lower(text))")
    return (df.select(*cols, clean.alias("clean")).where("clean <> ''")
            .select(*cols, F.split("clean", "[\\x20\\x09-\\x0D]+").alias("words")))


def _hash_at(width: int, words: str = "words"):
    return lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(width)])


def _simhash(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, fp): majority of the bits of ``h`` over the rows of each key."""
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(1)).alias(f"b{b}") for b in range(64)]
    got = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    bits = [F.shiftleft((F.col(f"b{b}") * 2 > F.col("n")).cast("long"), b) for b in range(64)]
    return got.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("fp"))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, bits) of each block."""
    small, more = divmod(64, BLOCKS)
    out, at = [], 0
    for b in range(BLOCKS):
        out.append((at, small + (b < more)))
        at += out[-1][1]
    return out


def _near(bits: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` of ``bits`` bits."""
    return [v for v in range(1 << bits) if v.bit_count() <= radius]


def _block_values(near: bool):
    """Structs (block, value) of column fp; near: with all values up to RADIUS // BLOCKS bits off."""
    def of(block: int, at: int, bits: int):
        v = F.shiftrightunsigned("fp", at).bitwiseAND((1 << bits) - 1).cast("int")
        masks = F.lit(_near(bits, RADIUS // BLOCKS) if near else [0])
        return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), v.bitwiseXOR(m).alias("value")))

    return F.concat(*[of(i, at, bits) for i, (at, bits) in enumerate(_blocks())])


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, th, item_id, similarity, start, n_words): the best window of each document and item that match."""
    items = _words(benchmark.select("item_id", F.monotonically_increasing_id().alias("item"), "text"), "item", "item_id")
    items = items.withColumn("m", F.size("words")).withColumn("k", F.least("m", F.lit(SHINGLE)))
    items = cut(items, "items")
    widths = [r["k"] for r in items.select("k").distinct().collect()]   # at most SHINGLE values
    shingles, hits = None, None
    text = _words(docs.select("doc_id", F.xxhash64("text").alias("th"), "text"), "doc_id", "th")
    rows = items.select(F.sum(F.col("m"))).head()[0] or 0
    near = F.broadcast if rows <= BROADCAST_ROWS else (lambda df: df)
    for k in widths or [SHINGLE]:
        own = items.where(F.col("k") == k).select("item", F.explode(
            F.transform(F.sequence(F.lit(0), F.col("m") - k), _hash_at(k))).alias("h"))
        shingles = own if shingles is None else shingles.union(own)
        seen = (text.where(F.size("words") >= k).select("doc_id", "th", (F.size("words") - k + 1).alias("n"), F.posexplode(
            F.transform(F.sequence(F.lit(0), F.size("words") - k), _hash_at(k))).alias("p", "h")))
        hit = seen.join(near(own.distinct()), "h").select("doc_id", "th", "n", "p", "item")
        hits = hit if hits is None else hits.union(hit)
    shingles = cut(shingles.groupBy("item", "h").agg(F.count("*").alias("iw")), "item-shingles")

    # windows that hold enough of an item's shingles, by (document, item): bounded by the document
    size = items.select("item", "m", "k", (F.col("m") - F.col("k") + 1).alias("full"))
    rough = shingles.groupBy("item").agg(((F.count("*") < SMOOTH) | (F.max("iw") > 1)).alias("rough"))
    places = hits.groupBy("doc_id", "th", "item").agg(F.max("n").alias("n"), F.array_sort(F.collect_set("p")).alias("ps"))
    places = places.join(near(size.join(rough, "item")), "item").withColumn("nw", F.least("full", "n"))
    need = F.ceil(similarity * (F.col("full") + F.col("nw")) / (1 + similarity) - 1e-9).cast("int")
    places = places.withColumn("need", need).withColumn("last", F.col("n") - F.col("nw")).where("size(ps) >= need")
    starts = F.expr("""filter(ps, (p, i) -> p < last AND get(ps, i + need - 1) <= p + nw - 1)""")
    tail = F.when(F.expr("get(ps, size(ps) - need) >= last"), F.array("last")).otherwise(F.expr("array()").cast("array<int>"))
    screened = cut(places.select("doc_id", "th", "item", "full", "rough", "m", "k", "nw", F.explode(
        F.concat(starts, tail)).alias("start")), "screened")
    windows = screened.select("doc_id", "th", "m", "k", "nw", "start").distinct()
    by_doc = windows.groupBy("doc_id", "th").agg(F.collect_list(F.struct("m", "k", "nw", "start")).alias("ws")).alias("w")
    # one plan at every size: the texts (not yet split) are shuffled once to the documents with windows
    t = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").alias("t")
    on = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.th") == F.col("w.th"))
    per = t.join(by_doc.hint("merge"), on).select("t.doc_id", "t.th", "t.text", "w.ws")
    per = _words(per, "doc_id", "th", "ws").dropDuplicates(["doc_id", "th"])
    hs = F.lit(None).cast("array<bigint>")
    per = per.select("doc_id", "th", "words", F.explode("ws").alias("w")).select(
        "doc_id", "th", "w.*", F.expr("slice(words, w.start + 1, w.nw + w.k - 1)").alias("part"))
    for k in widths:
        hs = F.when(F.col("k") == k, F.transform(F.sequence(F.lit(0), F.col("nw") - 1), _hash_at(k, "part"))).otherwise(hs)
    per = cut(per.select("doc_id", "th", "m", "nw", "start", hs.alias("hs"))
              .withColumn("id1", F.xxhash64("hs")).withColumn("id2", F.hash("hs"))
              .withColumn("again", F.size(F.array_distinct("hs")) < F.size("hs")), "window-shingles")
    content = ["m", "nw", "id1", "id2"]
    one = per.dropDuplicates(content).select(*content, F.explode("hs").alias("h"))
    weights = cut(one.groupBy(*content, "h").agg(F.count("*").alias("ww")), "window-weights")
    again = weights.select(*content, "h", F.explode(F.array_repeat(F.lit(1), F.col("ww").cast("int"))))
    window_fp = _simhash(again, *content)
    item_fp = _simhash(shingles.select("item", "h", F.explode(F.array_repeat(F.lit(1), F.col("iw").cast("int")))), "item")
    entries = (item_fp.join(size.select("item", "m", "full"), "item")
               .select("item", "m", "full", F.col("fp").alias("ifp"), F.explode(_block_values(True)).alias("e"))
               .select("item", "m", "full", "ifp", "e.*"))
    probes = window_fp.select(*content, "fp", F.explode(_block_values(False)).alias("e")).select(*content, "fp", "e.*")
    pairs = (probes.join(entries, ["m", "block", "value"])
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
             .select(*content, "item", "full"))
    # pairs whose distance says little: straight from the screen
    at = ["th", "m", "nw", "start"]
    same = reduce(lambda x, y: x & y, [F.col(f"s.{c}") == F.col(f"p.{c}") for c in at], F.col("s.doc_id").eqNullSafe(F.col("p.doc_id")))
    direct = (screened.alias("s").join(per.drop("hs").alias("p"), same).where("s.rough OR p.again")
              .select(*[F.col(f"p.{c}") for c in content], "s.item", "s.full"))
    pairs = pairs.union(direct).distinct()
    common = pairs.join(weights, content).join(shingles, ["item", "h"])
    inter = common.groupBy(*content, "item", "full").agg(F.sum(F.least("ww", "iw")).alias("both"))
    sim = inter.withColumn("similarity", F.col("both") / (F.col("full") + F.col("nw") - F.col("both")))
    sim = sim.where(F.col("similarity") >= similarity - 1e-9).select(*content, "item", "similarity")
    found = per.select("doc_id", "th", *content, "start").join(sim, content)
    best = found.groupBy("doc_id", "th", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("b"), F.max("m").alias("n_words"))
    return best.join(items.select("item", "item_id"), "item").select(
        "doc_id", "th", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.back")).alias("start"), "n_words")


def query(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row of each such document and item."""
    got = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select("doc_id", "item_id", "similarity", "start", "n_words").distinct()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    bad = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "th").distinct()
    bad = cut(bad, "contaminated").alias("b")
    own = free_name(docs, "_th")
    d = docs.withColumn(own, F.xxhash64("text")).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col(f"d.{own}") == F.col("b.th"))
    return d.join(bad.hint("merge"), on, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
