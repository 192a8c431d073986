"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables (via the fixture
adapter). Output columns are aliased to match the SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import assets
from ..functions.columns import (first_truthy, image_score, is_image_url, normalise_name,
                                 strip_leading_zeros, upper_trim_equals, url_extension,
                                 url_suffix_code)
from ..operators import curate as cu
from ..operators import hierarchy as hi
from ..operators import packaging as pk
from ..operators import profile as pr
from ..operators import publish as pb
from ..schemas import CASE_COLUMNS, CURATED_COLUMNS, PUBLISH_COLUMNS
from ..session import drop_path, scratch_path, staged
from ..sources import jdbc, page_source, pages
from ..sources.tables import TableStore
from ..streaming import changes as ch
from . import fixtures as fx
from . import jobs
from . import rules as R

Query = Callable[[SparkSession, str], DataFrame]
L2, L3, L4 = hi.L2, hi.L3, hi.L4


# ---------------------------------------------------------------- building blocks
def silver(spark, d):
    return fx.silver(spark, d)


def curated(spark, d):
    return cu.curate(silver(spark, d))


def latest(spark, d, columns=None):
    return cu.latest_curated(silver(spark, d), columns)


def recent(spark, d):
    return hi.recent_sales_lookup(fx.hierarchy(spark, d), fx.weekly_sales(spark, d), R.AS_OF)


def gold(spark, d, keep_known=False, base=None, columns=None):
    return hi.category_cascade(base if base is not None else latest(spark, d, columns),
                               fx.hierarchy(spark, d), recent(spark, d), R.EXCLUSION_RULES,
                               R.OWN_PROVIDER, R.PLACEHOLDER, keep_known=keep_known)


def key_pages(spark, d):
    return pages.parse_pages(fx.key_pages(spark, d))


def keys_full(spark, d):
    return pages.page_keys(key_pages(spark, d).select("page"))


def bronze(spark, d):
    return pages.bronze(keys_full(spark, d), R.RUN_START)


def publishable(spark, d):
    return pb.publishable(gold(spark, d, columns=_PUBLISH_IN))


def manifest(spark, d, winners_only=False):
    return pb.manifest(publishable(spark, d), folder="images/", winners_only=winners_only)


# ---------------------------------------------------------------- sources / sinks
def _landed_pages(spark, d):
    """The key pages as a listing's client lands them."""
    path = f"{_fresh_root(spark, 'pages')}/landed"
    page_source.land(fx.key_pages(spark, d), path)
    return path


def q_ingest_keys_full(spark, d):
    return page_source.read_keys(spark, _landed_pages(spark, d)).select("Id", "UpdatedAt")


def q_ingest_keys_changes(spark, d):
    keys = page_source.read_keys(spark, _landed_pages(spark, d))
    return pages.changed_since(keys, R.SINCE).select("Id", "UpdatedAt")


def q_ingest_keys_stream(spark, d):
    """The listing as a stream, in two triggers: the second half of the pages lands after the first has been read,
    and the second trigger goes on from the stored page."""
    root = _fresh_root(spark, "page-stream")
    envelopes = fx.key_pages(spark, d)
    half = envelopes.agg(F.expr("max(page_no) div 2").alias("h")).head()["h"] or 0
    for turn in (F.col("page_no") <= half, F.col("page_no") > half):
        page_source.land(envelopes.where(turn), f"{root}/landed")
        (page_source.stream_keys(spark, f"{root}/landed").writeStream.format("parquet").option("path", f"{root}/keys")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/keys").select("Id", "UpdatedAt")


def q_next_offset(spark, d):
    p = fx.key_pages(spark, d)
    return pages.parse_pages(p).select(F.col("page_no").alias("page"),
                                       pages.next_offset().alias("next_offset"))


def q_id_batches(spark, d):
    return pages.id_batches(bronze(spark, d), batch_size=1000, n_buckets=64)


def q_bronze_snapshot(spark, d):
    store = TableStore(spark, _fresh_root(spark, "bronze"))
    store.write(bronze(spark, d), "bronze", skip_if_empty=True)
    return store.read("bronze")


def q_distinct_keys(spark, d):
    return bronze(spark, d).select("Id").distinct()


def q_silver_append(spark, d):
    store = TableStore(spark, _fresh_root(spark, "silver"))
    docs = silver(spark, d)
    store.write(docs.where(F.col("ingest_ts") < F.lit(R.RUN_START)), "silver")
    store.write(docs.where(F.col("ingest_ts") >= F.lit(R.RUN_START)).withColumn("batch", F.lit("changes")),
                "silver", mode="append")
    return store.read("silver").select("Id", "ingest_ts", "batch")


def q_snapshot_read(spark, d):
    store = TableStore(spark, _fresh_root(spark, "hierarchy"))
    store.write(fx.hierarchy(spark, d), "hierarchy")
    return store.read("hierarchy")


def q_topn_projection(spark, d):
    return jdbc.topn_projection(fx.hierarchy(spark, d), ["GTIN", L2], top_n=100,
                                order_by=["GTIN DESC", L2])


def _fresh_root(spark, name):
    """A new table-store root under the cluster's shared checkpoint folder."""
    return scratch_path(spark, name)


# ---------------------------------------------------------------- projections
def q_json_path_get(spark, d):
    c = cu.curate(silver(spark, d), columns=["GTIN", "Depth_mm"])
    return c.select("GTIN", "Depth_mm", F.coalesce("Depth_mm", F.lit("n/a")).alias("depth_or_default"))


def q_localized_pick(spark, d):
    return cu.curate(silver(spark, d), columns=["GTIN", "TradeItemDescription_fi"]).select("GTIN", "TradeItemDescription_fi")


def q_key_fallback(spark, d):
    wanted = ["GTIN", "Id", "InfoProviderName", "LastUpdatedDateTime"]
    return cu.curate(silver(spark, d), columns=wanted).select(*wanted)


def q_strict_boolean(spark, d):
    wanted = ["GTIN", "Deleted", "IsConsumerUnit", "IsDespatchUnit", "IsOrderableUnit", "IsInvoiceUnit"]
    return cu.curate(silver(spark, d), columns=wanted).select(*wanted)


def q_strip_zeros(spark, d):
    raw = F.expr(f"""CASE p_partkey % 10 WHEN 0 THEN lpad(CAST(p_partkey AS STRING), 14, '0')
        WHEN 1 THEN CAST(p_partkey AS STRING) WHEN 2 THEN '000' WHEN 3 THEN ''
        WHEN 4 THEN NULL WHEN 5 THEN '0' || CAST(p_partkey AS STRING) || 'a0'
        ELSE lpad(CAST(p_partkey AS STRING), 8, '0') END""")
    return (fx.table(spark, d, "part").select(F.col("p_partkey").alias("k"), raw.alias("raw"))
            .select("k", "raw", strip_leading_zeros("raw").alias("stripped")))


def q_curate_full(spark, d):
    return curated(spark, d)


def q_latest_per_key(spark, d):
    return latest(spark, d)


def q_quarantine(spark, d):
    return cu.quarantine(silver(spark, d))


def q_segment_filter(spark, d):
    return cu.segment_filter(silver(spark, d), R.SEGMENT).select("Id", "ingest_ts")


def q_segment_skips(spark, d):
    return cu.segment_outcomes(silver(spark, d), R.SEGMENT, "ingest_ts")


def q_updated_gtins(spark, d):
    s = silver(spark, d).where(F.col("ingest_ts") >= F.lit(R.RUN_START))
    return ch.touched_keys(s)


def q_changes_upsert(spark, d):
    """Changes run: the curated snapshot of everything ingested before the run
    is a stored, bucketed table; the items that arrived in the run are merged into it."""
    s = silver(spark, d)
    snapshot = ch.curated_snapshot(spark, f"{_fresh_root(spark, 'curated')}/curated")
    ch.merge_arrived(snapshot, s.where(F.col("ingest_ts") < F.lit(R.RUN_START)))
    ch.merge_arrived(snapshot, s.where(F.col("ingest_ts") >= F.lit(R.RUN_START)))
    return snapshot.read().select(*CURATED_COLUMNS)


def _landed_in_turns(spark, d, turns, start):
    """The curated table after each part of silver landed as JSON files and ``start`` ran to its end over them.

    The files are compressed (documents repeat their field names) and small, as a task reads whole ones; they are
    dropped when all have been read."""
    root = _fresh_root(spark, "stream")
    landing = f"{root}/landing"
    snapshot = ch.curated_snapshot(spark, f"{root}/curated")
    for part in turns:
        part.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 50_000).json(landing)
        start(spark, landing, snapshot, f"{root}/checkpoint").awaitTermination()
    drop_path(spark, landing)
    return snapshot.read().select(*CURATED_COLUMNS)


def q_changes_stream(spark, d):
    """Structured Streaming form of the changes run: silver rows land as JSON
    files; an availableNow stream merges each trigger's files into the
    curated table. First the rows ingested before the run land and are
    merged, then the rows of the run; the second trigger starts from the
    stream checkpoint, so it only sees the new files."""
    s = silver(spark, d)
    turns = [s.where(F.col("ingest_ts") < F.lit(R.RUN_START)), s.where(F.col("ingest_ts") >= F.lit(R.RUN_START))]
    return _landed_in_turns(spark, d, turns, ch.start_changes_stream)


def q_changes_stateful(spark, d):
    """Stateful form, in three triggers: the rows of the run land *before* most of the older ones, which are
    late for their keys, and the rows of the run land once more at the end. The result is the batch result."""
    s = silver(spark, d)
    early = F.pmod(F.xxhash64("Id"), F.lit(2)) == 0
    old, run = s.where(F.col("ingest_ts") < F.lit(R.RUN_START)), s.where(F.col("ingest_ts") >= F.lit(R.RUN_START))
    turns = [old.where(F.coalesce(early, F.lit(False))).unionByName(run), old.where(~F.coalesce(early, F.lit(False))), run]
    return _landed_in_turns(spark, d, turns, ch.start_newest_stream)


# ---------------------------------------------------------------- assets
def _walk(spark, d):
    docs = silver(spark, d).where("raw_json IS NOT NULL")
    gtin = cu.read_fields("raw_json", cu.SOURCES["GTIN"], first_truthy)
    return docs.select(gtin.alias("GTIN"), "raw_json").withColumn("cands", assets.image_candidates("raw_json"))


def _candidates(spark, d):
    """(GTIN, c): a row for each candidate. For a plain explode the optimizer would ask before it whether there are any,
    by a second walk of each document; no candidate is NULL, so the outer one loses none."""
    return _walk(spark, d).select("GTIN", F.explode_outer("cands").alias("c")).where(F.col("c").isNotNull())


def q_asset_walk(spark, d):
    return (_candidates(spark, d)
            .select("GTIN", "c.ord", "c.url", "c.filename", "c.media_id"))


def q_image_score(spark, d):
    urls = _candidates(spark, d).select(F.col("c.url").alias("url")).distinct()
    return urls.select("url", url_suffix_code("url").alias("suffix_code"),
                       url_extension("url").alias("extension"),
                       image_score("url").alias("score"), is_image_url("url").alias("is_image"))


def q_image_rank(spark, d):
    w = _walk(spark, d)
    top = assets.top2(assets.ranked(F.col("cands")))
    return w.select("GTIN", *[v.alias(k) for k, v in top.items()])


# ---------------------------------------------------------------- hierarchy
def q_strip_and_exclude(spark, d):
    return hi.apply_exclusions(fx.hierarchy(spark, d), R.EXCLUSION_RULES)


def q_hierarchy_dedup(spark, d):
    return hi.dedup_by_key(fx.hierarchy(spark, d), "GTIN")


def q_recent_sales_lookup(spark, d):
    return recent(spark, d)


def q_prefix_join(spark, d):
    groups = fx.weekly_sales(spark, d).select("group_id").distinct()
    return groups.join(hi.category_groups(fx.hierarchy(spark, d)), "group_id") \
        .select("group_id", L2, L3, L4)


def q_known_flag(spark, d):
    lookup = hi.key_lookup(fx.hierarchy(spark, d), recent(spark, d), R.EXCLUSION_RULES)
    return hi.known_flag(latest(spark, d, ["GTIN"]), lookup)


def q_tier0_join(spark, d):
    r = hi.apply_exclusions(hi.dedup_by_key(recent(spark, d), "EAN"), R.EXCLUSION_RULES)
    c = latest(spark, d, ["GTIN"]).withColumn("GTIN_NO_LEADING_ZEROS", strip_leading_zeros("GTIN"))
    return (c.join(r, c["GTIN_NO_LEADING_ZEROS"] == r["EAN"], "left")
            .select("GTIN", F.col(L2).alias("L2_recent"), F.col(L3).alias("L3_recent"),
                    F.col(L4).alias("L4_recent")))


# what the cascade reads of a curated row, and what tells rows without a key apart
_CASCADE_IN = ["GTIN", "Id", "InfoProviderName", "UpdatedAt", "LastUpdatedDateTime"]


# what the manifest shows of a curated row, and what the cascade reads of it
_PUBLISH_IN = [*_CASCADE_IN, *[c for c in PUBLISH_COLUMNS if c != "GTIN"], "TradeItemUnitDescriptor"]


def q_category_cascade(spark, d):
    return gold(spark, d, columns=_CASCADE_IN).select("GTIN", "Id", "GTIN_NO_LEADING_ZEROS", L2, L3, L4, "CATEGORY_SOURCE")


def q_own_placeholder(spark, d):
    g = gold(spark, d, keep_known=True, columns=_CASCADE_IN)
    return g.where(upper_trim_equals("InfoProviderName", R.OWN_PROVIDER)).select(
        "GTIN", "InfoProviderName", "CATEGORY_KNOWN", "CATEGORY_SOURCE", L2)


def q_coverage_metrics(spark, d):
    return hi.coverage_metrics(gold(spark, d, keep_known=True, columns=_CASCADE_IN), R.OWN_PROVIDER)


# ---------------------------------------------------------------- packaging
_CASE_IN = ["GTIN", "Id", "UpdatedAt", "LastUpdatedDateTime", "TradeItemUnitDescriptor", "IsDespatchUnit", "Depth_mm",
            "Width_mm", "Height_mm", "GrossWeight_g", "TotalQuantityOfNextLowerLevelTradeItem", "ChildTradeItemJson"]


def q_unit_split(spark, d):
    # both sides read the latest rows: staged, so that their versions are sorted once
    base, other = pk.unit_split(staged(latest(spark, d, ["TradeItemUnitDescriptor"]), "unit_rows"))
    return (base.select(F.lit("base").alias("unit_class"))
            .unionByName(other.select(F.lit("other").alias("unit_class")))
            .groupBy("unit_class").agg(F.count(F.lit(1)).alias("n")))


def _cases_in(spark, d):
    """The latest rows with what the case operators read: staged, since they are joined with themselves."""
    return staged(latest(spark, d, _CASE_IN), "case_rows")


def q_case_edges(spark, d):
    return pk.case_edges(latest(spark, d, _CASE_IN))


def q_case_pick(spark, d):
    return pk.case_pick(pk.case_edges(latest(spark, d, _CASE_IN)))


_CASE_OUT = ["GTIN", "TradeItemUnitDescriptor", *CASE_COLUMNS]


def q_case_dimensions(spark, d):
    return pk.case_dimensions(_cases_in(spark, d)).select(*_CASE_OUT)


def q_case_idempotent(spark, d):
    once = pk.case_dimensions(_cases_in(spark, d))
    return pk.case_dimensions(staged(once, "case_once")).select(*_CASE_OUT)


def q_case_metrics(spark, d):
    return pk.case_metrics(pk.case_dimensions(_cases_in(spark, d)))


# ---------------------------------------------------------------- publishing
def q_publishable(spark, d):
    return publishable(spark, d)


def q_publishable_changed(spark, d):
    s = silver(spark, d).where(F.col("ingest_ts") >= F.lit(R.RUN_START))
    return pb.restrict_to_keys(publishable(spark, d), ch.touched_keys(s))


def q_publish_sample(spark, d):
    return pb.sample(publishable(spark, d), 25)


def q_publish_manifest(spark, d):
    m = manifest(spark, d)
    return m.select("gtin", "url", "base", "ext", "target", "is_winner",
                    pb.metadata_text("metadata").alias("metadata_text"))


def q_publish_metadata(spark, d):
    m = pb.manifest(publishable(spark, d))
    return m.select("gtin", F.size("metadata").alias("n_fields"),
                    pb.metadata_text("metadata").alias("metadata_text"))


def _content_type(url):
    ext = url_extension(url)
    return (F.when(ext.isin("jpg", "jpeg"), F.lit("image/jpeg"))
            .when(ext == "png", F.lit("image/png; charset=binary"))
            .when(ext == "webp", F.lit("IMAGE/WEBP"))
            .when(ext == "bmp", F.lit("application/octet-stream"))
            .when(ext == "gif", F.lit("")))


def q_resolve_extension(spark, d):
    p = publishable(spark, d).select(F.col("GTIN").alias("gtin"), F.col("PrimaryImageUrl").alias("url"))
    p = p.withColumn("content_type", _content_type(F.col("url")))
    return p.select("gtin", "url", "content_type",
                    pb.resolve_extension("content_type", "url").alias("ext"))


def _display_names(spark, d):
    disp = F.expr("""CASE p_partkey % 4 WHEN 0 THEN p_name
        WHEN 1 THEN replace(p_name, ' ', '\u00a0')
        WHEN 2 THEN '  ' || upper(p_name) || ' '
        ELSE replace(p_name, ' ', ' – ') END""")
    return fx.table(spark, d, "part").select(F.col("p_partkey").alias("k"), disp.alias("display"))


def q_normalise_names(spark, d):
    return _display_names(spark, d).select("k", "display", normalise_name("display").alias("normalised"))


def q_resolve_names(spark, d):
    req = _display_names(spark, d).select("display")
    av = fx.table(spark, d, "part").select(
        F.col("p_name").alias("display"),
        F.concat(F.lit("col_"), F.regexp_replace("p_name", " ", "_")).alias("internal")).distinct()
    return pb.resolve_names(req, av)


def q_nearest_names(spark, d):
    """Names with a wrong or missing letter, and what was available for them."""
    wrong = F.expr("""CASE p_partkey % 3 WHEN 0 THEN substring(p_name, 1, length(p_name) - 1)
        WHEN 1 THEN upper(p_name) || 'x' ELSE replace(p_name, 'e', 'i') END""")
    part = fx.table(spark, d, "part")
    av = part.select(F.col("p_name").alias("display"),
                     F.concat(F.lit("col_"), F.regexp_replace("p_name", " ", "_")).alias("internal")).distinct()
    return pb.nearest_names(part.select(wrong.alias("display")), av)


def _previous_manifest(spark, d, current):
    """Previous snapshot: current targets of parts with key % 3 <> 0 (URL
    changed when key % 5 = 0), plus targets of parts that are no longer
    publishable (unit descriptor missing)."""
    k = F.col("gtin").cast("bigint")
    kept = current.where(k % 3 != 0).select(
        "target", F.when(k % 5 == 0, F.concat("url", F.lit("?v=0"))).otherwise(F.col("url")).alias("url"),
        "meta")
    gone = fx.table(spark, d, "part").where(F.expr(f"NOT ({R.PART['unit']} IS NOT NULL)")).select(
        F.concat(F.lit("images/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("target"),
        F.lit("https://img.example.com/old").alias("url"), F.lit("").alias("meta"))
    return kept.unionByName(gone)


def q_manifest_diff(spark, d):
    cur = staged(manifest(spark, d, winners_only=True).select(
        "target", "url", "gtin", pb.metadata_text("metadata").alias("meta")), "manifest_now")
    prev = _previous_manifest(spark, d, cur)
    return pb.manifest_diff(prev, cur.select("target", "url", "meta"))


def _job_inputs(spark, d):
    cfg = jobs.CategoryConfig(R.EXCLUSION_RULES, R.OWN_PROVIDER, R.PLACEHOLDER, R.AS_OF)
    return fx.hierarchy(spark, d), fx.weekly_sales(spark, d), cfg


def q_full_manifest_plan(spark, d):
    """K4: the full refresh with manifest; its first plan adds every target."""
    store = TableStore(spark, _fresh_root(spark, "full-manifest"))
    jobs.full_with_manifest(spark, store, silver(spark, d), *_job_inputs(spark, d), run_ts=R.RUN_START)
    return store.read("manifest_plan").select("target", "action", "url")


def q_changes_manifest(spark, d):
    """K3: a full refresh with manifest over what was ingested before the run, then the changes run with the
    manifest of its keys; the stored manifest is that of all items."""
    store = TableStore(spark, _fresh_root(spark, "changes-manifest"))
    s, rest = silver(spark, d), _job_inputs(spark, d)
    jobs.full_with_manifest(spark, store, s.where(F.col("ingest_ts") < F.lit(R.RUN_START)), *rest, run_ts=R.RUN_START)
    jobs.changes_with_manifest(spark, store, s.where(F.col("ingest_ts") >= F.lit(R.RUN_START)), *rest, run_ts=R.RUN_START)
    return store.read("manifest").select("target", "url", "gtin", "meta")


def q_publish_outcomes(spark, d):
    return pb.outcome_counts(pb.publish(manifest(spark, d, winners_only=True)))


# ---------------------------------------------------------------- profile / probes
def q_category_names(spark, d):
    p = pr.category_names(silver(spark, d))
    return p.select("GpcCategoryCode", "SelectedName",
                    F.array_join("DistinctNames", "|").alias("DistinctNames"))


def q_category_name_conflicts(spark, d):
    return pr.category_name_conflicts(silver(spark, d))


def q_deleted_counts(spark, d):
    return pr.deleted_counts(latest(spark, d, ["Deleted"]))


def q_json_isin(spark, d):
    keys = fx.table(spark, d, "part").where("p_partkey % 50 = 0").select(
        F.expr(R.PART["gtin"]).alias("GTIN"))
    return pr.json_isin(silver(spark, d), keys)


def q_missing_keys(spark, d):
    ids = silver(spark, d).select("Id").where(F.col("Id").isNotNull()).distinct()
    return pr.missing_keys(ids, bronze(spark, d))


def q_run_summary(spark, d):
    """One row of run metrics, taken while the tables of the run are written: no table is read again to count it."""
    store, m = TableStore(spark, _fresh_root(spark, "run")), {}
    jobs.observed_write(store, bronze(spark, d).select("Id").distinct(), "keys", m, "keys")
    jobs.observed_write(store, silver(spark, d), "silver", m, "silver")
    rows = latest(spark, d, sorted({*_CASCADE_IN, *_CASE_IN}))
    hierarchy, weekly, cfg = _job_inputs(spark, d)
    jobs.write_gold(store, rows, hierarchy, weekly, cfg, m)
    names = {"n_keys": "keys_rows", "n_silver": "silver_rows", "n_gold": "gold_rows", "n_categorised": "gold_categorised",
             "n_with_case_dims": "gold_with_case_dims"}
    return spark.createDataFrame([tuple(int(m[v]) for v in names.values())], ", ".join(f"{n} long" for n in names))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "ingest_keys_full": q_ingest_keys_full,
    "ingest_keys_changes": q_ingest_keys_changes,
    "ingest_keys_stream": q_ingest_keys_stream,
    "next_offset": q_next_offset,
    "id_batches": q_id_batches,
    "bronze_snapshot": q_bronze_snapshot,
    "distinct_keys": q_distinct_keys,
    "silver_append": q_silver_append,
    "snapshot_read": q_snapshot_read,
    "topn_projection": q_topn_projection,
    # projections / curation
    "json_path_get": q_json_path_get,
    "localized_pick": q_localized_pick,
    "key_fallback": q_key_fallback,
    "strict_boolean": q_strict_boolean,
    "strip_zeros": q_strip_zeros,
    "curate_full": q_curate_full,
    "latest_per_key": q_latest_per_key,
    "quarantine": q_quarantine,
    "segment_filter": q_segment_filter,
    "segment_skips": q_segment_skips,
    "updated_gtins": q_updated_gtins,
    "changes_upsert": q_changes_upsert,
    "changes_stream": q_changes_stream,
    "changes_stateful": q_changes_stateful,
    # assets
    "asset_walk": q_asset_walk,
    "image_score": q_image_score,
    "image_rank": q_image_rank,
    # hierarchy
    "category_exclusions": q_strip_and_exclude,
    "hierarchy_dedup": q_hierarchy_dedup,
    "recent_sales_lookup": q_recent_sales_lookup,
    "prefix_join": q_prefix_join,
    "known_flag": q_known_flag,
    "tier0_join": q_tier0_join,
    "category_cascade": q_category_cascade,
    "own_placeholder": q_own_placeholder,
    "coverage_metrics": q_coverage_metrics,
    # packaging
    "unit_split": q_unit_split,
    "case_edges": q_case_edges,
    "case_pick": q_case_pick,
    "case_dimensions": q_case_dimensions,
    "case_idempotent": q_case_idempotent,
    "case_metrics": q_case_metrics,
    # publishing
    "publishable": q_publishable,
    "publishable_changed": q_publishable_changed,
    "publish_sample": q_publish_sample,
    "publish_manifest": q_publish_manifest,
    "publish_metadata": q_publish_metadata,
    "resolve_extension": q_resolve_extension,
    "normalise_names": q_normalise_names,
    "resolve_names": q_resolve_names,
    "nearest_names": q_nearest_names,
    "manifest_diff": q_manifest_diff,
    "full_manifest_plan": q_full_manifest_plan,
    "changes_manifest": q_changes_manifest,
    "publish_outcomes": q_publish_outcomes,
    # profile and probes
    "category_names": q_category_names,
    "category_name_conflicts": q_category_name_conflicts,
    "deleted_counts": q_deleted_counts,
    "json_isin": q_json_isin,
    "missing_keys": q_missing_keys,
    "run_summary": q_run_summary,
}
