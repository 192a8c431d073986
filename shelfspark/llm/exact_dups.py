"""Exact deduplication: texts that are the same once white space is deleted.

Three stages combine the rows of equal texts, each with the whole normalised text among its grouping
keys, so that a digest collision can never join unlike texts:

1. locally: the partial aggregate of every input task leaves one row for each text it met;
2. salted: digests of more than one row in HOT are dealt to about the square root of their rows' number of
   salts by input task, and the local winners of a salt are merged;
3. globally: the winners of a digest's salts are merged.

Other digests need one salt, so their second stage is their last and a text crosses the network once. Which
row belongs to which group then needs narrow rows only (digest, rank): the texts of a digest stand for
one group unless the counted contents of that digest are several, and only those few go by content again.
The joins back are salted for the hot digests in the same manner.

Defined results: a null text counts as empty; a null id comes after every id; of rows that agree in length and
id, one stays; empty table: no rows. Long texts are compared whole. Other columns are never read, so their names
cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, table

#: A digest is hot if it has more than one in so many rows: at most HOT digests are, which bounds the broadcast.
HOT = 4096
#: Below so many rows no digest is worth a salt.
LEAST = 1000
SPACE = "[\\x20\\x09-\\x0D]+"
#: Rank of a row in its group: code points first, then the smaller id; ids take less than 2 ** 65.
STEP, NO_ID = 1 << 65, 1 << 63


def number(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def rank(text: Column, doc_id: Column) -> Column:
    """One number that orders rows as the rule does; a decimal, so that a hash aggregate can hold its maximum."""
    length = F.length(F.coalesce(text, F.lit(""))).cast("decimal(10,0)")
    return (length * number(STEP) - F.coalesce(doc_id.cast("decimal(20,0)"), number(NO_ID))).cast("decimal(38,0)")


def id_of(best: Column) -> Column:
    """The id in a rank."""
    i = number(NO_ID) - (best + number(NO_ID)) % number(STEP)
    return F.when(i < number(NO_ID), i.cast("long"))


def winners(texts: DataFrame, hot: DataFrame) -> DataFrame:
    """digest, norm, best, n of every distinct text of ``texts`` (digest, norm, rank)."""
    own = texts.join(F.broadcast(hot), "digest", "left")
    local = [F.max("rank").alias("best"), F.count("*").alias("n")]
    cold = own.where("salts is null").groupBy("digest", "norm").agg(*local)
    salted = (own.where("salts is not null").withColumn("salt", F.pmod(F.spark_partition_id(), F.col("salts")))
              .groupBy("digest", "salt", "norm").agg(*local)
              .groupBy("digest", "norm").agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    return cold.unionByName(salted)


def labelled(members: DataFrame, groups: DataFrame, hot: DataFrame, key: list[str]) -> DataFrame:
    """Every member row (uid, doc_id, digest, rank, text_sha256) with its group's row that stays and size."""
    first = members.groupBy(*key, "rank").agg(F.min("uid").alias("keep_uid"))
    groups = groups.join(first.withColumnRenamed("rank", "best"), [*key, "best"])
    hot = F.broadcast(hot)
    slot = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    spread = groups.join(hot, "digest", "left").withColumn("slot", slot).drop("salts", "rank")
    own = (members.join(hot, "digest", "left")
           .withColumn("slot", F.pmod(F.xxhash64("uid"), F.coalesce(F.col("salts"), F.lit(1))).cast("int")))
    return own.join(spread, [*key, "slot"]).select(
        "doc_id", id_of(F.col("best")).alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. ``digest`` only deals the work: any
    function of the normalised text gives the same rows."""
    norm = normalised(F.col(text))
    texts = docs.select(digest(norm).alias("digest"), norm.alias("norm"), rank(F.col(text), F.col(doc_id)).alias("rank"),
                        F.col(doc_id).alias("doc_id"))
    narrow = [F.monotonically_increasing_id().alias("uid"), "doc_id", "digest", "rank",
              F.sha2("norm", 256).alias("text_sha256")]
    rows = cut(texts.select(*narrow), "exact_rows")
    least = max(LEAST, rows.count() // HOT)
    hot = cut(rows.groupBy("digest").count().where(F.col("count") > least)
              .select("digest", F.ceil(F.sqrt("count")).cast("int").alias("salts")), "exact_hot")
    of_digest = cut(winners(texts.drop("doc_id"), hot).groupBy("digest")
                    .agg(F.count("*").alias("contents"), F.max("best").alias("best"), F.sum("n").alias("n")), "exact_digests")
    single = of_digest.where("contents = 1").drop("contents")
    out = labelled(rows.join(single.select("digest"), "digest", "left_semi") if _several(of_digest) else rows, single, hot,
                   ["digest"])
    if _several(of_digest):
        several = of_digest.where("contents > 1").select("digest")
        unlike = cut(texts.join(several, "digest", "left_semi").select(*narrow, "norm"), "exact_unlike")
        groups = winners(unlike.select("digest", "norm", "rank"), hot)
        out = out.unionByName(labelled(unlike, groups, hot, ["digest", "norm"]))
    return out


def _several(of_digest: DataFrame) -> bool:
    """Whether a digest stands for more than one text."""
    return not of_digest.where("contents > 1").isEmpty()


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id NULLS LAST)
"""
