import json

from pyspark.sql import functions as F

from shelfspark.functions import assets as A


def walk(doc):
    return [(c["url"], c["filename"], c["media_id"]) for c in A.walk_document(json.dumps(doc))]


def test_walk_nested_lists_preorder():
    doc = {"a": [{"url": "u1", "b": [{"URI": "u2"}]}, {"x": {"Url": "u3"}}], "z": {"FileUrl": "u4"}}
    assert [u for u, _, _ in walk(doc)] == ["u1", "u2", "u3", "u4"]


def test_walk_key_rules():
    doc = [{"Url": "  ", "Uri": " u1 ", "FileName": " f.jpg ", "MediaId": 42},
           {"URL": "a", "url": "b"},          # same key after lower-casing: last one wins
           {"name": "no url here"},
           {"url": 5, "uri": "u4", "mediaitemid": True},
           {"originalfileName": "o.png", "url": "u5"}]
    assert walk(doc) == [("u1", "f.jpg", "42"), ("b", None, None), ("u4", None, "True"),
                         ("u5", "o.png", None)]


def test_walk_malformed_and_none():
    assert A.walk_document(None) is None
    assert A.walk_document("{bad") == []


def test_rank_dedup_and_ties(spark):
    doc = {"i": [{"url": "https://x/a.gif", "name": "first"}, {"url": "https://x/b_C1C1.jpg", "name": "b"},
                 {"url": "https://x/a.gif", "name": "second"}, {"url": "https://x/c.gif"},
                 {"url": "https://x/d"}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "raw_json string")
    df = df.withColumn("c", A.image_candidates("raw_json"))
    r = df.select(A.ranked(F.col("c")).alias("r")).collect()[0]["r"]
    assert [(x["url"], x["filename"], x["score"]) for x in r] == [
        ("https://x/b_C1C1.jpg", "b", 130), ("https://x/a.gif", "first", 2),
        ("https://x/c.gif", None, 2), ("https://x/d", None, 0)]
    top = df.select(*[v.alias(k) for k, v in A.top2(A.ranked(F.col("c"))).items()]).collect()[0]
    assert top["PrimaryImageUrl"] == "https://x/b_C1C1.jpg" and top["SecondaryImageUrl"] == "https://x/a.gif"


def test_no_candidates(spark):
    df = spark.createDataFrame([('{"a":1}',), (None,)], "raw_json string")
    df = df.withColumn("c", A.image_candidates("raw_json"))
    out = df.select(*[v.alias(k) for k, v in A.top2(A.ranked(F.col("c"))).items()]).collect()
    assert all(r["PrimaryImageUrl"] is None for r in out)


def test_any_depth_equals_the_library_and_has_no_limit():
    import pytest
    from hypothesis import given, settings
    from hypothesis import strategies as st
    values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(),
                          lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4), x, max_size=4), max_leaves=20)

    @given(values, st.sampled_from([None, (",", ":"), (" ,\n", "\t: ")]), st.booleans())
    @settings(max_examples=200, deadline=None)
    def same(value, separators, ascii_only):
        text = json.dumps(value, separators=separators, ensure_ascii=ascii_only)
        assert A.loads_any_depth(text) == json.loads(text)
        assert A.loads_any_depth(f" {text}\n") == json.loads(text)
    same()
    for bad in ["", "{", "[", "[1", "[1,]", "{}{}", '{"a"}', '{"a":}', '{"a":1,}', "[1 2]", "nul", "01", '{1:2}', "]", '["a]', "[}"]:
        with pytest.raises(ValueError):
            json.loads(bad)
        with pytest.raises(ValueError):
            A.loads_any_depth(bad)
    for depth in (20_000, 300_000):
        doc = '{"a": [' * depth + '{"Url": "https://x/deep.png"}' + "]}" * depth
        assert [c["url"] for c in A.walk_document(doc)] == ["https://x/deep.png"]
        assert A.walk_document(doc[:-1]) == []


def test_plain_searches_rule_out_no_url_key(spark):
    """Where the regex finds a URL key, the plain searches before it do too, in any spelling; a document without one is ruled out."""
    keys = [k for key in A.URL_KEYS for k in (key, key.upper(), key.title())]
    held = [f'{{"\u0130\u03a3\u212a": "\u00c4", "{k}" : "https://x/a.png"}}' for k in keys]
    free = ['{"GTIN": "1", "Name": "a url, a uri, or none"}', '{"CatalogueItemInfo": {"Id": "C1-1"}}', "", "{bad"]
    rows = spark.createDataFrame([(t,) for t in [*held, *free, None]], "raw_json string")
    got = rows.select("raw_json", A.may_hold_url_key("raw_json").alias("may"), F.col("raw_json").rlike(A.URL_KEY_RX).alias("has")).collect()
    assert all(r["may"] for r in got if r["raw_json"] in held) and all(r["has"] for r in got if r["raw_json"] in held)
    assert not any(r["may"] for r in got if r["raw_json"] in free)
    walked = rows.select(F.size(A.image_candidates("raw_json")).alias("n")).collect()
    assert sorted(r["n"] for r in walked) == [0] * (len(free) + 1) + [1] * len(held)
