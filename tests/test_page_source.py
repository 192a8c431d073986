import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfspark.plans import queries as Q
from shelfspark.sources import page_source as P
from shelfspark.sources import pages
from small_tables import SF_SMALL


def envelopes(spark, numbers, **more):
    rows = [(n, json.dumps({"Items": [{"Id": f"{n}-{k}", "UpdatedAt": f"20{n:02d}-0{k}"} for k in (1, 2)], **more})) for n in numbers]
    return spark.createDataFrame(rows, "page_no long, envelope string")


def explained(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def path():
    return os.path.join(tempfile.mkdtemp(prefix="shelf-pages-"), "landed")


def test_odd_pages_read_as_the_json_reader_reads_them(spark, path):
    texts = ['{"Items": [{"Id": "a"}, {"Id": ""}, {"Id": null, "UpdatedAt": "x"}, {}, {"Id": 5, "UpdatedAt": 1.5}]}',
             '{"Items": []}', '{"Items": null}', "{}", "not json", "[1]", '{"Items": [{"Id": "é\\u00e9", "UpdatedAt": null}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "page_no long, envelope string")
    P.land(df, path, group_pages=3)
    got = P.read_keys(spark, path).select("Id", "UpdatedAt")
    want = pages.page_keys(pages.parse_pages(df).select("page"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_one_partition_a_group_and_filters_in_the_reader(spark, path):
    P.land(envelopes(spark, range(10)), path, group_pages=4)
    df = P.read_keys(spark, path)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 20
    late = df.where((F.col("UpdatedAt") >= "2007-02") & (F.col("page") < 9))
    assert sorted(r["Id"] for r in late.collect()) == ["7-2", "8-1", "8-2"]
    plan = explained(spark, late)
    assert "PushedFilters: [GreaterThanOrEqual(UpdatedAt,2007-02)]" in plan
    # the reader has taken the comparison over; only the one that it does not know is left to Spark
    left = next(line for line in plan.splitlines() if line.startswith("Condition"))
    assert ">=" not in left and "< 9" in left


def test_query_shows_the_pushed_filter(spark):
    assert "PushedFilters: [GreaterThanOrEqual(UpdatedAt," in explained(spark, Q.QUERIES["ingest_keys_changes"](spark, SF_SMALL))


def test_nothing_landed(spark, path):
    assert P.read_keys(spark, path).collect() == []
    with pytest.raises(Exception, match="needs the path"):
        spark.read.format(P.NAME).load().collect()


def test_stream_goes_on_from_the_stored_page(spark, path):
    out, ck = f"{path}-out", f"{path}-ck"

    def trigger():
        q = (P.stream_keys(spark, path).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return q.lastProgress
    P.land(envelopes(spark, range(6)), path, group_pages=4)
    trigger()
    read = lambda: sorted(r["Id"] for r in spark.read.parquet(out).collect())
    assert read() == sorted(f"{n}-{k}" for n in range(6) for k in (1, 2))
    offsets = sorted(f for f in os.listdir(f"{ck}/offsets") if not f.startswith("."))
    assert '{"page": 5}' in open(f"{ck}/offsets/{offsets[-1]}").read()
    # earlier groups are not opened again: they can be gone
    first = f"{path}/{P.GROUP}=0"
    for f in os.listdir(first):
        os.remove(os.path.join(first, f))
    P.land(envelopes(spark, range(6, 9)), path, group_pages=4)
    trigger()
    assert read() == sorted(f"{n}-{k}" for n in range(9) for k in (1, 2))
    trigger()
    assert len(read()) == 18
