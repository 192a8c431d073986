"""Paged key listings and batched item requests.

A REST listing is paged and sequential on the client side; on Spark we land
the page envelopes (JSON) and read them all in parallel: every page is
consumed, whether or not an earlier page was empty (D13).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import truthy_coalesce
from ..schemas import KEY_PAGE_ITEMS_DDL, OFFSET_SPELLINGS


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed page files (one JSON envelope per line) -> ``page`` struct column."""
    return parse_pages(spark.read.text(path).withColumnRenamed("value", "envelope"))


def parse_pages(envelopes: DataFrame, text_col: str = "envelope") -> DataFrame:
    """Envelope text -> ``page`` struct column (other columns kept): the item
    list plus each offset spelling, read by its exact (case-sensitive) path
    into fields ``offset_1..3`` (names that differ only in case would be
    ambiguous to Spark's case-insensitive resolver)."""
    t = F.col(text_col)
    page = F.struct(F.from_json(t, KEY_PAGE_ITEMS_DDL)["Items"].alias("Items"),
                    *[F.get_json_object(t, f"$.{k}").alias(f"offset_{i + 1}")
                      for i, k in enumerate(OFFSET_SPELLINGS)])
    return envelopes.withColumn("page", page)


def next_offset(page_col: str = "page"):
    """First truthy offset among the three spellings (in OFFSET_SPELLINGS order)."""
    p = F.col(page_col)
    return truthy_coalesce(*[p[f"offset_{i + 1}"] for i in range(len(OFFSET_SPELLINGS))])


def page_keys(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """All truthy item ids of all pages, with their update instant."""
    return (pages.select(F.explode(F.col(page_col)["Items"]).alias("it"), *[
        c for c in pages.columns if c != page_col])
            .select(F.col("it.Id").alias("Id"), F.col("it.UpdatedAt").alias("UpdatedAt"),
                    *[c for c in pages.columns if c != page_col])
            .where(F.col("Id").isNotNull() & (F.col("Id") != F.lit(""))))


def changed_since(keys: DataFrame, since: str) -> DataFrame:
    """Keys updated at or after ``since`` (ISO text; string order = time order)."""
    return keys.where(F.col("UpdatedAt") >= F.lit(since))


def bronze(keys: DataFrame, load_time: str) -> DataFrame:
    """Bronze key table rows: (Id, load_time)."""
    return keys.select("Id", F.lit(load_time).alias("load_time"))


def bucket_of(id_col, n_buckets: int):
    """Stable bucket from the md5 of the id (the same on every engine)."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n_buckets))


def id_batches(ids: DataFrame, batch_size: int = 1000, n_buckets: int = 64) -> DataFrame:
    """Distinct ids packed into request batches of at most ``batch_size``
    (clamped to 1..1000), in (bucket, Id) order, all batches full but the last.

    No global window: ids are numbered inside hash buckets, and bucket offsets
    come from a per-bucket count (one row per bucket), so every step is
    partitioned."""
    size = max(1, min(int(batch_size), 1000))
    d = ids.select("Id").where(F.col("Id").isNotNull()).distinct() \
        .withColumn("bucket", bucket_of("Id", n_buckets))
    counts = d.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("bucket", (F.sum("n").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("offset"))
    rn = F.row_number().over(Window.partitionBy("bucket").orderBy("Id"))
    return (d.withColumn("rn", rn)
            .join(F.broadcast(offsets), "bucket")
            .select("Id", "bucket",
                    F.floor((F.coalesce(F.col("offset"), F.lit(0)) + F.col("rn") - 1) / size)
                    .cast("bigint").alias("batch_no")))


Fetcher = Callable[[list[str]], list]


def silver_id(raw_json="raw_json"):
    """Silver row id of a raw item: CatalogueItemInfo.Id, else TradeItem.Id,
    else TradeItem.Gtin (truthy order; no root GTIN fallback, D12)."""
    d = F.from_json(F.col(raw_json) if isinstance(raw_json, str) else raw_json,
                    "CatalogueItemInfo struct<Id: string>, TradeItem struct<Id: string, Gtin: string>")
    return truthy_coalesce(d["CatalogueItemInfo"]["Id"], d["TradeItem"]["Id"], d["TradeItem"]["Gtin"])


def fetch_batches(batches: DataFrame, fetch: Fetcher, ingest_ts: str) -> DataFrame:
    """Call ``fetch(ids) -> [item, ...]`` once per batch on the executors
    (batches are grouped by ``batch_no``, at most 1000 ids each). Items may be
    dicts or JSON text; each becomes one silver row (Id, raw_json, ingest_ts)
    with the Id derived from the document itself."""
    import json

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        items = fetch(sorted(pdf["Id"].tolist()))
        texts = [it if isinstance(it, str) else json.dumps(it, ensure_ascii=False) for it in items]
        return pd.DataFrame({"raw_json": texts}, columns=["raw_json"])

    raw = batches.groupBy("batch_no").applyInPandas(run, "raw_json string")
    return raw.select(silver_id().alias("Id"), "raw_json", F.lit(ingest_ts).alias("ingest_ts"))
