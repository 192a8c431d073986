import json

import pytest

from shelfspark.operators import curate as cu


def curate_docs(spark, docs, ts="2024-01-01"):
    data = [(f"i{i}", d if (d is None or isinstance(d, str)) else json.dumps(d), ts)
            for i, d in enumerate(docs)]
    return cu.curate(spark.createDataFrame(data, "Id string, raw_json string, ingest_ts string"))


def test_null_malformed_array_empty(spark):
    out = curate_docs(spark, [None, "{bad", '[{"TradeItem":{"Gtin":"1"}}]', {}]).collect()
    assert len(out) == 3  # NULL document dropped
    for r in out:
        assert r["GTIN"] is None and r["UpdatedAt"] == "2024-01-01"


def test_key_fallbacks(spark):
    docs = [
        {"CatalogueItemInfo": {"Id": ""}, "TradeItem": {"Gtin": "g1", "Id": "t1"}},
        {"TradeItem": {"Gtin": "g2"}},
        {"GTIN": "g3"},
        {"TradeItem": {"Gtin": "", "InformationProviderOfTradeItem": {"PartyName": ""},
                       "InformationProvider": {"Name": "N"}}, "GTIN": "g4"},
    ]
    r = curate_docs(spark, docs).select("GTIN", "Id", "InfoProviderName").collect()
    assert [tuple(x) for x in r] == [("g1", "t1", None), ("g2", "g2", None), ("g3", "g3", None),
                                     ("g4", "g4", "N")]


def test_strict_booleans_and_deleted(spark):
    docs = [
        {"TradeItem": {"IsTradeItemAConsumerUnit": True}, "CatalogueItemInfo": {"Deleted": False}},
        {"TradeItem": {"IsTradeItemAConsumerUnit": False}, "Deleted": True},  # root only
        {"TradeItem": {"IsTradeItemAConsumerUnit": "true"}, "CatalogueItemInfo": {"Deleted": "true"},
         "Deleted": True},  # non-boolean CI value blocks the root fallback
        {"TradeItem": {"IsTradeItemAConsumerUnit": 1}, "CatalogueItemInfo": {"Deleted": None},
         "Deleted": True},  # JSON null in CI falls back
        {"TradeItem": {}},
    ]
    r = curate_docs(spark, docs).select("IsConsumerUnit", "Deleted").collect()
    assert [tuple(x) for x in r] == [(True, False), (False, True), (None, None), (None, True),
                                     (None, None)]


def test_duplicate_keys_last_wins(spark):
    r = curate_docs(spark, ['{"TradeItem":{"Gtin":"a","Gtin":"b"}}']).select("GTIN").collect()
    assert r[0]["GTIN"] == "b"


def test_numbers_as_strings_and_child_json(spark):
    doc = {"TradeItem": {"TradeItemMeasurementsModule": {"TradeItemMeasurements": {
        "Depth": {"Value": 12}, "Width": {"Value": 1.50}, "Height": {"Value": "7"}}},
        "NextLowerLevelTradeItemInformation": {"TotalQuantityOfNextLowerLevelTradeItem": 24,
                                               "ChildTradeItem": [{"Gtin": "x", "QuantityOfNextLowerLevelTradeItem": 2}]}}}
    r = curate_docs(spark, [doc]).collect()[0]
    assert (r["Depth_mm"], r["Width_mm"], r["Height_mm"]) == ("12", "1.5", "7")
    assert r["TotalQuantityOfNextLowerLevelTradeItem"] == "24"
    assert json.loads(r["ChildTradeItemJson"]) == [{"Gtin": "x", "QuantityOfNextLowerLevelTradeItem": 2}]


def _start(g, s, ts, lu=None):
    return ({"TradeItem": {"Gtin": g, "DeliveryPurchasingInformationModule": {
        "DeliveryPurchasingInformation": {"StartAvailabilityDateTime": s}},
        "TradeItemDescriptionModule": {"TradeItemDescriptionInformation": {
            "BrandNameInformation": {"BrandName": f"{s}/{ts}"}}}}}, ts)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_latest_per_key(spark, partitions):
    rows = [_start("a", "2020", "t1"), _start("a", "2021", "t0"),      # newer start wins
            _start("b", "2020", "t1"), _start("b", "2020", "t2"),      # equal start: newer ingest
            _start("c", None, "t9"), _start("c", "2019", "t1"),        # NULL start loses
            ("{bad", "t1"), ("{bad", "t2")]                             # NULL GTIN x2 -> one row
    data = [(f"i{i}", d if isinstance(d, str) else json.dumps(d), ts) for i, (d, ts) in enumerate(rows)]
    silver = spark.createDataFrame(data, "Id string, raw_json string, ingest_ts string").repartition(partitions)
    out = {r["GTIN"]: r["BrandName"] for r in cu.latest_per_key(cu.curate(silver)).collect()}
    assert out == {"a": "2021/t0", "b": "2020/t2", "c": "2019/t1", None: None}


def test_segment_filter(spark):
    docs = [{"TradeItem": {"GdsnTradeItemClassification": {"GpcSegmentCode": "50000000"}}},
            {"TradeItem": {"GdsnTradeItemClassification": {"GpcSegmentCode": 50000000}}},
            {"TradeItem": {"GdsnTradeItemClassification": {"GpcSegmentCode": ""}}, "GpcSegmentCode": "50000000"},
            {"GpcSegmentCode": "60000000"}, {}]
    data = [(f"i{i}", json.dumps(d), "t") for i, d in enumerate(docs)]
    s = spark.createDataFrame(data, "Id string, raw_json string, ingest_ts string")
    assert sorted(r["Id"] for r in cu.segment_filter(s, "50000000").collect()) == ["i0", "i1", "i2"]
    assert cu.segment_filter(s, None).count() == 5


def test_quarantine_reasons(spark):
    data = [("a", None, "t"), ("b", "{bad", "t"), ("c", "[1]", "t"),
            ("d", '{"Deleted":"yes"}', "t"), ("e", '{"Deleted":true}', "t")]
    s = spark.createDataFrame(data, "Id string, raw_json string, ingest_ts string")
    got = {r["Id"]: r["reason"] for r in cu.quarantine(s).collect()}
    assert got == {"a": "null_document", "b": "malformed_json", "c": "not_an_object",
                   "d": "type_mismatch"}


def test_latest_drop_null_keys(spark):
    data = [("a", "{bad", "t"), ("b", json.dumps({"TradeItem": {"Gtin": "g"}}), "t")]
    s = spark.createDataFrame(data, "Id string, raw_json string, ingest_ts string")
    assert cu.latest_per_key(cu.curate(s)).count() == 2
    assert [r["GTIN"] for r in cu.latest_per_key(cu.curate(s), drop_null_keys=True).collect()] == ["g"]


def test_localized_single_object_is_not_a_list(spark):
    # D17: a single object where a list is expected gives no value (as in the
    # source system, which only reads lists); the fallback list is then used
    doc = {"TradeItem": {"TradeItemDescriptionModule": {"TradeItemDescriptionInformation": {
        "TradeItemDescription": {"LanguageCode": "fi", "Value": "Yksi"},
        "DescriptionShort": [{"LanguageCode": "en", "Value": "Short"}]}}}}
    r = curate_docs(spark, [doc]).collect()[0]
    assert r["TradeItemDescription_fi"] == "Short"


def test_documents_beyond_the_readers_default_limits(spark):
    import json
    deep = json.dumps({"TradeItem": {"Gtin": "1"}})[:-1] + ', "x": ' + "[" * 1500 + "]" * 1500 + "}"
    long = json.dumps({"TradeItem": {"Gtin": "2", "TradeItemUnitDescriptorCode": {"Value": "v" * 25_000_000}}})
    lost = json.dumps({"TradeItem": {"Gtin": "3"}})[:-1] + ', "url": "http://x/y.png", "x": ' + "[" * 30_000 + "]" * 30_000 + "}"
    kept = '{"TradeItem": {"Gtin": "3", "NextLowerLevelTradeItemInformation": {"ChildTradeItem": ' + "[" * 2000 + "]" * 2000 + "}}}"
    silver = spark.createDataFrame([("a", deep, "t"), ("b", long, "t"), ("c", lost, "t"), ("d", "[" * 30_000, "t"), ("e", kept, "t")],
                                   "Id string, raw_json string, ingest_ts string")
    rows = cu.curate(silver).select("GTIN", "PrimaryImageUrl").collect()
    assert sorted((r["GTIN"] or "", r["PrimaryImageUrl"] or "") for r in rows) == [
        ("", ""), ("1", ""), ("2", ""), ("3", ""), ("3", "http://x/y.png")]
    assert {r["Id"]: r["reason"] for r in cu.quarantine(silver).collect()} == {"d": "malformed_json", "e": "too_deep"}
    from shelfspark.streaming.changes import touched_keys
    assert {r["GTIN"] for r in touched_keys(silver).collect()} == {"1", "2", "3"}


def test_one_odd_list_element_voids_no_other(spark):
    import json
    doc = {"TradeItem": {"Gtin": "1", "TradeItemDescriptionModule": {"TradeItemDescriptionInformation": {
        "TradeItemDescription": ["odd", 7, {"LanguageCode": "fi", "Value": "nimi"}]}}}}
    silver = spark.createDataFrame([("a", json.dumps(doc), "t")], "Id string, raw_json string, ingest_ts string")
    assert cu.curate(silver).head()["TradeItemDescription_fi"] == "nimi"


def test_equal_versions_are_picked_by_the_documents_digest(spark):
    import hashlib
    import json
    docs = [json.dumps({"TradeItem": {"Gtin": "1", "GdsnTradeItemClassification": {"GpcCategoryName": n}}}) for n in "abcdef"]
    silver = spark.createDataFrame([("x", d, "t") for d in docs], "Id string, raw_json string, ingest_ts string")
    best = min(docs, key=lambda d: hashlib.md5(d.encode()).hexdigest())
    want = json.loads(best)["TradeItem"]["GdsnTradeItemClassification"]["GpcCategoryName"]
    for parts in (1, 5):
        assert cu.latest_curated(silver.repartition(parts)).head()["GpcCategoryName"] == want
