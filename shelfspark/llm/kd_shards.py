"""Sharding by k-d tree partitioning over metadata.

A node that has to become n leaves is split into n // 2 and the rest, at the weighted quantile of
bytes along its widest metadata dimension (widest: its range against the range in all documents),
until each leaf has about the target bytes. Dimensions: size, lang, source and doc_id, as numbers
that keep their order. The quantile is found for all nodes of a level at once, by histograms of
bytes over ``BINS`` bins that narrow around the wanted place: a grouped sum that is combined
map-side and brings at most nodes x BINS rows to the driver. Rows that tie in the dimension go by
the text's crc32 (so that equal texts stay together where they can), then doc_id, then by row; a
value that a third of all rows share is split like any other.

The law is ``bytes``: a cut is off its place by less than one document, or by ``TOLERANCE`` of a
shard. Slots are gapless ranks within a shard, found without gathering a shard in a task.

Defined results: null text has no bytes (size 16) and crc32 0; null lang, source or doc_id sort
first; repeated rows are sharded one by one; fewer rows than shards leave shards empty; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, rank_within

SHARDS, BINS, TOLERANCE, OVERHEAD = 40, 1024, 0.0005, 16
DIMENSIONS = ("size", "lang_n", "source_n", "id_n")
#: Keys that decide among rows that are equal in a dimension.
TIES = ("text_crc32", "id_n", "rid")


@dataclass
class Node:
    first: int                  # its first shard
    leaves: int
    keys: tuple = ()            # the dimension and the ties
    prefix: list = field(default_factory=list)   # values of the keys that are settled
    lo: int = 0
    hi: int = 0
    before: float = 0.0         # bytes of the node below lo
    goal: float = 0.0           # bytes wanted on the left
    done: bool = False

    def where(self) -> str:
        same = [f"{k} = {v}L" for k, v in zip(self.keys, self.prefix, strict=False)]
        return " AND ".join([f"node = {self.first}", *same])

    def bin(self) -> str:
        k = self.keys[len(self.prefix)]
        return (f"WHEN {self.where()} AND {k} BETWEEN {self.lo}L AND {self.hi}L "
                f"THEN CAST(({k} - {self.lo}L) DIV {self.width()}L AS INT)")

    def width(self) -> int:
        return (self.hi - self.lo) // BINS + 1

    def right(self) -> str:
        """The rows of the node at or above the cut ``lo``."""
        parts, same = [], [f"node = {self.first}"]
        for k, v in zip(self.keys, self.prefix, strict=False):
            parts.append(" AND ".join([*same, f"{k} > {v}L"]))
            same.append(f"{k} = {v}L")
        parts.append(" AND ".join([*same, f"{self.keys[len(self.prefix)]} >= {self.lo}L"]))
        return "(" + ") OR (".join(parts) + ")"

    def narrow(self, bins: list[tuple[int, float]], ranges: dict, slack: float) -> None:
        """Takes the bin that holds the goal; done when what is left to decide is small or one row."""
        if not bins:
            self.done = True
            return
        for b, weight in bins:
            if self.before + weight >= self.goal or b == bins[-1][0]:
                break
            self.before += weight
        w = self.width()
        lo, hi = self.lo + b * w, min(self.hi, self.lo + (b + 1) * w - 1)
        level = len(self.prefix)
        if weight <= slack or (w == 1 and level == len(self.keys) - 1):
            below, above = self.goal - self.before, self.before + weight - self.goal
            self.lo, self.done = (lo if below <= above else hi + 1), True
        elif w == 1:
            self.prefix.append(lo)
            self.lo, self.hi = ranges[self.keys[level + 1]]
        else:
            self.lo, self.hi = lo, hi


def _ordinal(column: str) -> str:
    """The first seven bytes of a text as a number that keeps the order; null: -1."""
    return (f"coalesce(cast(conv(rpad(hex(substring(encode({column}, 'utf-8'), 1, 7)), 14, '0'), 16, 10) AS bigint), -1L)")


def metadata(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.expr(f"cast(coalesce(octet_length(text), 0) + {OVERHEAD} AS bigint)").alias("size"),
        F.expr("coalesce(crc32(text), 0L)").alias("text_crc32"),
        F.expr(_ordinal("lang")).alias("lang_n"), F.expr(_ordinal("source")).alias("source_n"),
        F.expr("coalesce(shiftright(cast(doc_id AS bigint), 1), -4611686018427387904L)").alias("id_n"),
        F.monotonically_increasing_id().alias("rid"))


def _range(stats, key: str) -> tuple[int, int]:
    return stats[f"lo_{key}"], stats[f"hi_{key}"]


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; give ``shards``, or the bytes a shard should have."""
    rows = cut(metadata(docs), "kd-rows")
    keys = dict.fromkeys([*DIMENSIONS, *TIES])
    spans = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]
    whole = rows.agg(F.sum("size").alias("bytes"), *spans).head()
    total = whole["bytes"] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    ranges = {k: _range(whole, k) for k in keys}
    nodes = {0: Node(0, shards)} if total else {}
    rows = rows.withColumn("node", F.lit(0))
    while open_ := [n for n in nodes.values() if n.leaves > 1]:
        stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *spans).collect()}
        work = []
        for n in open_:
            s = stats.get(n.first)
            if s is None:
                n.leaves = 1
                continue
            def wide(k, s=s):
                lo, hi = ranges[k]
                return (s[f"hi_{k}"] - s[f"lo_{k}"]) / (hi - lo) if hi > lo else 0.0
            best = max(DIMENSIONS, key=wide)
            n.keys = (best, *[t for t in TIES if t != best])
            n.prefix, n.done, n.before = [], False, 0.0
            n.goal = s["bytes"] * (n.leaves // 2) / n.leaves
            n.lo, n.hi = _range(s, best)
            work.append(n)
        while left := [n for n in work if not n.done]:
            bins = F.expr("CASE " + " ".join(n.bin() for n in left) + " END")
            got = (rows.withColumn("bin", bins).where("bin is not null").groupBy("node", "bin")
                   .agg(F.sum("size").alias("w")).collect())     # at most nodes x BINS rows
            for n in left:
                n.narrow(sorted((r["bin"], r["w"]) for r in got if r["node"] == n.first), ranges,
                         TOLERANCE * total / shards)
        if not work:
            break
        move = "CASE " + " ".join(f"WHEN {n.right()} THEN {n.first + n.leaves // 2}" for n in work) + " ELSE node END"
        rows = cut(rows.withColumn("node", F.expr(move)), "kd-level")
        for n in work:
            nodes[n.first + n.leaves // 2] = Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2)
            n.leaves //= 2
    rows = rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), "id_n", "rid")
    return rank_within(rows, ["shard"], ["text_crc32", "id_n", "rid"], "slot", "kd-slots").drop("id_n", "rid")


def query(spark, sf_dir: str) -> DataFrame:
    out = kd_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
