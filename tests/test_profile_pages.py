import json

from pyspark.sql import functions as F

from shelfspark.operators import profile as PR
from shelfspark.sources import pages as PG


def silver_codes(spark, pairs):
    docs = [(f"i{i}", json.dumps({"TradeItem": {"GdsnTradeItemClassification":
                                                {"GpcCategoryCode": c, "GpcCategoryName": n}}}), "t")
            for i, (c, n) in enumerate(pairs)]
    return spark.createDataFrame(docs, "Id string, raw_json string, ingest_ts string")


def test_category_name_choice(spark):
    pairs = [("A", "aa"), ("A", "bb"),                          # tie by count: longer/greater
             ("B", "xyz"), ("B", "abc"),                        # same length: greatest text
             ("C", " "), ("C", ""),                             # only blank names
             ("D", "maito"), ("D", "maito"), ("D", "mjölk"),    # nordic minority beats majority
             ("E", "long name"), ("E", "short"), ("E", "short")]
    p = PR.category_names(silver_codes(spark, pairs))
    got = {r["GpcCategoryCode"]: (r["SelectedName"], r["DistinctNames"]) for r in p.collect()}
    assert got["A"] == ("bb", ["aa", "bb"])
    assert got["B"] == ("xyz", ["abc", "xyz"])
    assert got["C"] == (None, ["", " "])
    assert got["D"][0] == "mjölk"
    assert got["E"][0] == "short"
    c = PR.category_name_conflicts(silver_codes(spark, pairs)).collect()[0]
    assert (c["n_codes"], c["n_codes_multi_name"]) == (5, 5)


def _env(items, **off):
    return json.dumps({"Items": [{"Id": i, "UpdatedAt": u} for i, u in items], **off})


def test_pages_offsets_and_keys(spark):
    env = spark.createDataFrame([
        (1, _env([("a", "2024-01-01"), ("", "2024-01-02")], NextOffset="", NextofSet="T2")),
        (2, _env([], NextOfSet="T3")),                 # empty page does not stop the listing
        (3, _env([("b", "2024-02-01"), (None, "x")])),
    ], "n int, envelope string")
    p = PG.parse_pages(env)
    assert {r["n"]: r["o"] for r in p.select("n", PG.next_offset().alias("o")).collect()} == \
        {1: "T2", 2: "T3", 3: None}
    keys = PG.page_keys(p.select("page"))
    assert sorted(r["Id"] for r in keys.collect()) == ["a", "b"]
    assert [r["Id"] for r in PG.changed_since(keys, "2024-01-15").collect()] == ["b"]


def test_id_batches_packing(spark):
    ids = spark.range(2503).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("Id"))
    b = PG.id_batches(ids.union(ids), batch_size=1000, n_buckets=16)
    sizes = sorted((r["batch_no"], r["n"]) for r in b.groupBy("batch_no").agg(F.count("*").alias("n")).collect())
    assert sizes == [(0, 1000), (1, 1000), (2, 503)]
    assert b.select("Id").distinct().count() == 2503


def test_fetch_batches(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "Id string")
    b = PG.id_batches(ids, batch_size=2, n_buckets=4)

    def fetch(batch):
        return [{"CatalogueItemInfo": {"Id": "" if i == "a" else i}, "TradeItem": {"Gtin": i.upper()}}
                for i in batch]

    out = PG.fetch_batches(b, fetch, "2024-01-01")
    assert sorted((r["Id"], json.loads(r["raw_json"])["TradeItem"]["Gtin"]) for r in out.collect()) == \
        [("A", "A"), ("b", "B"), ("c", "C")]
