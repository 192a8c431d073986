import json
import os
import tempfile

from shelfspark.sources import jdbc as J
from shelfspark.sources import pages as PG
from shelfspark.sources.tables import read_snapshot, stamp, union_merge


def test_read_landed_pages(spark):
    d = tempfile.mkdtemp(prefix="shelf-pages-")
    with open(os.path.join(d, "p1.json"), "w") as f:
        f.write(json.dumps({"Items": [{"Id": "a"}, {"Id": ""}], "NextofSet": "T2"}) + "\n")
        f.write(json.dumps({"Items": [], "NextOfSet": "T3"}) + "\n")
        f.write(json.dumps({"Items": [{"Id": "b"}]}) + "\n")
    p = PG.read_pages(spark, d)
    assert sorted(r[0] or "" for r in p.select(PG.next_offset()).collect()) == ["", "T2", "T3"]
    assert sorted(r["Id"] for r in PG.page_keys(p.select("page")).collect()) == ["a", "b"]


def test_topn_projection(spark):
    df = spark.createDataFrame([(3, "c", 1), (1, "a", 2), (2, "b", 3), (None, "z", 4)],
                               "k int, v string, w int")
    out = J.topn_projection(df, ["k", "v"], top_n=2, order_by=["k DESC"])
    assert [tuple(r) for r in out.collect()] == [(3, "c"), (2, "b")]
    assert out.columns == ["k", "v"]
    asc = J.topn_projection(df, None, top_n=1, order_by=["k"])
    assert asc.collect()[0]["k"] is None  # ascending puts NULL first, as SQL servers do
    assert J.topn_projection(df).count() == 4


def test_snapshot_helpers(spark):
    d = tempfile.mkdtemp(prefix="shelf-snap-")
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").parquet(d)
    assert read_snapshot(spark, d).count() == 1
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert sorted(tuple(r) for r in union_merge(a, b).collect()) == [(1, None), (2, "y")]
    assert stamp(a, "ts", "2024-01-01T00:00:00").collect()[0]["ts"] == "2024-01-01T00:00:00"
    assert stamp(a, "ts", None).collect()[0]["ts"] is not None
