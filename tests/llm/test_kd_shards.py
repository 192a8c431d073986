import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import kd_shards as K

SF = "/root/testdata/sf0.1"


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    return [sum(r["size"] for r in by[s]) for s in range(shards)]


def test_query_is_near_equal_in_bytes(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = K.query(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    sums = check(rows, 40)
    mean, largest = sum(sums) / 40, max(r["size"] for r in rows)
    assert max(abs(s - mean) for s in sums) <= max(0.02 * mean, largest)


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 40])
def test_one_value_everywhere_still_splits(spark, make_docs, shards):
    docs = make_docs([(i // 2, "same text") for i in range(400)])
    sums = check(K.kd_shards(docs, shards).collect(), shards)
    assert max(sums) - min(sums) <= 3 * 25


def test_target_bytes(spark, make_docs):
    docs = make_docs([f"text {i}" * 9 for i in range(100)])
    total = sum(r["size"] for r in K.metadata(docs).collect())
    rows = K.kd_shards(docs, None, target_bytes=total // 5 + 1).collect()
    assert {r["shard"] for r in rows} == set(range(5))


def test_odd_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "a"), (3, "x" * 500_000), (4, "é")])
    docs = docs.withColumn("source", F.when(F.col("doc_id") > 2, F.col("source"))).withColumn("size", F.lit("clash"))
    docs = docs.withColumn("node", F.lit(1)).withColumn("slot", F.lit(1))
    rows = K.kd_shards(docs, 4).collect()
    check(rows, 4)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        [(1, 16, 0), (2, 16, 0), (2, 16, 0), (0, 17, zlib.crc32(b"a")), (3, 500_016, zlib.crc32(b"x" * 500_000)),
         (4, 18, zlib.crc32("é".encode()))])
    assert K.kd_shards(docs.where("false"), 4).count() == 0
