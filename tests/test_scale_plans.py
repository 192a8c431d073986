"""Plan shapes that matter at scale (checked on small data)."""

import json
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import curate as cu
from shelfspark.operators import hierarchy as H
from shelfspark.operators import packaging as P
from shelfspark.plans import fixtures as fx
from shelfspark.plans import queries as Q
from small_tables import SF_SMALL


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_has_partial_top1_before_shuffle(spark):
    p = plan(Q.latest(spark, SF_SMALL))
    # partial limit below the exchange, final limit above it
    assert p.count("WindowGroupLimit") >= 2
    lines = [ln for ln in p.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning(GTIN" in ln]
    kinds = ["X" if "Exchange" in ln else "W" for ln in lines]
    assert "WXW" in "".join(kinds)


def test_case_pick_partial_top1(spark):
    p = plan(P.case_pick(P.case_edges(Q.latest(spark, SF_SMALL))))
    assert p.count("WindowGroupLimit") >= 2


def test_prefix_join_is_equi_join(spark):
    p = plan(Q.recent(spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_many_null_keys_collapse_and_join(spark):
    docs = [(f"i{i}", json.dumps({"TradeItem": {"Id": f"t{i}"}}), f"t{i % 7}") for i in range(500)]
    docs += [("g", json.dumps({"TradeItem": {"Gtin": "00042"}}), "t")]
    silver = spark.createDataFrame(docs, "Id string, raw_json string, ingest_ts string").repartition(9)
    latest = cu.latest_per_key(cu.curate(silver))
    assert latest.where("GTIN IS NULL").count() == 1
    hier = spark.createDataFrame([("42", "20 - D", "200 - S", "2000 - L")],
                                 f"GTIN string, {H.L2} string, {H.L3} string, {H.L4} string")
    recent = spark.createDataFrame([], f"EAN string, {H.L2} string, {H.L3} string, {H.L4} string")
    g = H.category_cascade(cu.curate(silver), hier, recent, [], "x", "p")
    assert g.count() == 501
    assert g.where(F.col(H.L2) == "20 - D").count() == 1


def test_salted_null_keys_spread_and_never_match(spark):
    from shelfspark.functions.columns import salted_join_key
    df = spark.range(5000).select(F.lit(None).cast("string").alias("k"), F.col("id"))
    keys = df.select(salted_join_key("k", "id", buckets=64).alias("jk"))
    assert keys.distinct().count() == 64
    assert keys.where(F.substring("jk", 1, 1) != "\u0000").count() == 0
    real = spark.createDataFrame([("123",)], "k string").select(salted_join_key("k", "k").alias("jk"))
    assert real.collect()[0]["jk"] == "123"


def test_weekly_sales_prunes_columns(spark):
    p = plan(fx.weekly_sales(spark, SF_SMALL))
    # only the columns the weekly rows need reach the lineitem scan
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_no_row_at_a_time_python(spark):
    for name in ["curate_full", "category_cascade", "case_dimensions", "publish_manifest"]:
        assert "BatchEvalPython" not in plan(Q.QUERIES[name](spark, SF_SMALL))


def test_curation_runs_once_per_query(spark, monkeypatch):
    """Queries that consume the curated rows twice (self joins) still parse and
    walk every document once: the shared shuffle stages are reused."""
    import pandas as pd

    import shelfspark.functions.assets as A
    acc = spark.sparkContext.accumulator(0)
    walk = A.walk_document

    @F.pandas_udf(A.CANDIDATE_TYPE)
    def counting(texts: pd.Series) -> pd.Series:
        acc.add(len(texts))
        return texts.map(walk)

    monkeypatch.setattr(A, "_walk_udf", counting)
    n_docs = fx.silver(spark, SF_SMALL).where("raw_json IS NOT NULL").count()
    # only the manifest shows image columns: the others walk no document at all
    for name, walked in {"case_dimensions": 0, "publish_manifest": n_docs, "coverage_metrics": 0}.items():
        acc.value = 0
        Q.QUERIES[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()  # staging counts too
        assert acc.value == walked, name


NO_IMAGES = ["deleted_counts", "unit_split", "known_flag", "tier0_join", "case_edges", "case_pick", "case_metrics",
             "case_dimensions", "case_idempotent", "category_cascade", "own_placeholder", "coverage_metrics", "run_summary"]


def parses(df):
    """The schemas of all document parses in the finished plan, one text each, and the plan."""
    plans = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"from_json\((StructField.*?), \(max", plans), plans


@pytest.mark.parametrize("name", NO_IMAGES)
def test_no_walk_and_pruned_parse_without_image_columns(spark, name, monkeypatch):
    """Whatever a query parses, staged or not, it asks for no field that it does not show, and walks no document."""
    seen = []
    read = cu.parse_fields

    def noted(raw, paths, corrupt=False):
        seen.extend(paths)
        return read(raw, paths, corrupt)

    def no_walk(raw):
        raise AssertionError(f"{name} walks documents")
    monkeypatch.setattr(cu, "parse_fields", noted)
    monkeypatch.setattr(cu.assets, "image_candidates", no_walk)
    schemas, p = parses(Q.QUERIES[name](spark, SF_SMALL))
    assert "ArrowEvalPython" not in p and not any("BrandName" in x or "GpcFamilyCode" in x for x in schemas)
    assert seen and not any("BrandName" in x or "GpcFamilyCode" in x for x in seen)


def test_one_parse_a_document(spark):
    """The finished plans parse a document once: one from_json of its text for each read of the raw table, and one read."""
    for name in ["segment_filter", "segment_skips", "key_fallback", "latest_per_key", "asset_walk"]:
        schemas, p = parses(Q.QUERIES[name](spark, SF_SMALL))
        whole = [x for x in schemas if "LanguageCode" not in x and "Deleted,StringType" not in x]
        assert len(whole) == 1, name
        assert p.count("Relation [Id#") == 1, name


def test_self_joins_read_staged_rows(spark):
    for name in ["case_dimensions", "case_idempotent", "case_metrics", "publish_manifest"]:
        schemas, _ = parses(Q.QUERIES[name](spark, SF_SMALL))
        assert not [x for x in schemas if "CatalogueItemInfo" in x or "TradeItem" in x], name


def test_year_bound_reaches_the_sales_scan(spark, tmp_path):
    fx.weekly_sales(spark, SF_SMALL).write.parquet(str(tmp_path / "sales"))
    sales = spark.read.parquet(str(tmp_path / "sales"))
    p = plan(H.recent_sales_lookup(fx.hierarchy(spark, SF_SMALL), sales, "2001-08-01"))
    assert "GreaterThanOrEqual(year,2001)" in p


@pytest.mark.parametrize("name", ["image_score", "asset_walk", "image_rank"])
def test_documents_are_walked_once(spark, name):
    """One worker a task: the optimizer asks for no second walk before an explode."""
    plan_of = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan_of.split("Initial Plan")[0])) == 1


def test_case_documents_are_dealt_once(spark):
    """The sums of the children and the lists of them come from one shuffle of the order lines."""
    p = fx.case_documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p.split("Initial Plan")[0])) == 1


def test_unit_split_sorts_the_versions_once(spark):
    """Both sides of the split read staged rows: the finished plan holds neither a parse nor a window."""
    schemas, p = parses(Q.QUERIES["unit_split"](spark, SF_SMALL))
    assert not schemas and "Window" not in p


def test_part_documents_are_dealt_before_they_are_built(spark):
    """The part table is one row group here, which one task reads; its documents are built in several."""
    docs = fx.base_documents(spark, SF_SMALL)
    built = docs.select(F.spark_partition_id().alias("p"), "raw_json").groupBy("p").agg(F.count("raw_json")).count()
    assert built >= 8
    parts = fx.table(spark, SF_SMALL, "part")
    assert docs.where("version = 1").count() == parts.count()
    assert docs.where("version = 2").count() == parts.where("p_partkey % 6 = 0").count()
