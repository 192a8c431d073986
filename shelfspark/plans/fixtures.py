"""Fixture adapter: driver tables -> catalogue-shaped DataFrames (lazy).

Everything here is derived by Spark from the driver's parquet tables, so the
work grows with them. Rules live in :mod:`rules`; this module only assembles
JSON documents, key pages, hierarchy and sales rows from them.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import year_week
from ..schemas import SILVER_SCHEMA
from ..session import path_exists, save, scratch_path
from . import rules as R

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Typed-value markers: a string "B:true" / "N:12" in the generated struct is
# rewritten to the bare JSON literal, so one struct type can carry a boolean
# in one row and a string in another (needed for type-mismatch cases).
_MARKER_RX = r'"[BN]:([^"]*)"'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _json(struct_sql: str) -> F.Column:
    return F.regexp_replace(F.to_json(F.expr(struct_sql)), _MARKER_RX, "$1")


def _loc(lang: str, value: str) -> str:
    return f"named_struct('LanguageCode', '{lang}', 'Value', {value})"


_EMPTY_LOC = "filter(array(named_struct('LanguageCode', 'x', 'Value', 'x')), e -> false)"


def _base_struct(start: str, brand: str) -> str:
    p = R.PART
    desc = (f"CASE {p['desc_mode']} "
            f"WHEN 'empty' THEN {_EMPTY_LOC} "
            f"WHEN 'fi_null' THEN array({_loc('fi', 'CAST(NULL AS STRING)')}, {_loc('en', 'p_name')}) "
            f"WHEN 'fi_second' THEN array({_loc('en', 'p_name')}, {_loc('fi', chr(39) + 'fi ' + chr(39) + ' || p_name')}) "
            f"WHEN 'fi_blank' THEN array({_loc('fi', chr(39) * 2)}, {_loc('en', 'p_name')}) "
            f"ELSE array({_loc('en', 'p_name')}) END")
    short = (f"CASE {p['desc_mode']} "
             f"WHEN 'empty' THEN array({_loc('fi', chr(39) + 'lyhyt ' + chr(39) + ' || p_name')}) "
             f"WHEN 'fi_null' THEN array({_loc('sv', chr(39) + 'kort ' + chr(39) + ' || p_name')}) END")
    img_obj = ("named_struct('Url', {url_}, 'Uri', {uri_}, 'UniformResourceIdentifier', {uri2_}, "
               "'URI', {uri3_}, 'FileName', {fn_}, 'fileName', {fn2_}, 'MediaItemId', {mid_}, "
               "'mediaId', {mid2_})")
    null = "CAST(NULL AS STRING)"
    slot1 = img_obj.format(
        url_=f"CASE WHEN p_partkey % 10 = 1 THEN '  ' END",
        uri_=f"CASE WHEN p_partkey % 10 = 1 THEN {p['u1']} END",
        uri2_=f"CASE WHEN p_partkey % 10 = 1 THEN NULL ELSE {p['u1']} END",
        uri3_=null, fn_=p["f1"], fn2_=null, mid_=p["m1"], mid2_=null)
    slot2 = img_obj.format(url_=null, uri_=null, uri2_=null, uri3_=p["u2"], fn_=null,
                           fn2_=p["f2"], mid_=null, mid2_=f"'N:' || {p['m2']}")
    header = (f"CASE WHEN {p['n_img']} >= 2 THEN array({slot1}, {slot2}) "
              f"WHEN {p['n_img']} = 1 THEN array({slot1}) END")
    meas = (f"CASE WHEN {p['has_meas']} THEN named_struct('TradeItemMeasurements', named_struct("
            f"'Depth', named_struct('Value', 'N:' || {p['depth']}), "
            f"'Width', named_struct('Value', 'N:' || {p['width']}), "
            f"'Height', named_struct('Value', {p['height']}), "
            f"'TradeItemWeight', named_struct('GrossWeight', named_struct('Value', 'N:' || {p['weight']})))) END")
    return f"""named_struct(
      'GTIN', {p['gtin_root']},
      'Deleted', CASE WHEN p_partkey % 5 IN (2, 3) THEN 'B:true' END,
      'LastUpdatedDateTime', {p['root_lu']},
      'GpcSegmentCode', {p['root_seg']},
      'CatalogueItemInfo', named_struct('Id', {p['ci_id']}, 'LastUpdatedDateTime', {p['ci_lu']},
          'Deleted', CASE p_partkey % 5 WHEN 0 THEN 'B:true' WHEN 1 THEN 'B:false' WHEN 3 THEN 'true' END),
      'TradeItem', named_struct(
          'Gtin', {p['gtin_ti']}, 'Id', {p['ti_id']},
          'IsTradeItemAConsumerUnit', CASE p_partkey % 4 WHEN 0 THEN 'B:true' WHEN 1 THEN 'B:false' WHEN 2 THEN 'true' END,
          'IsTradeItemADespatchUnit', CASE WHEN p_partkey % 6 = 0 THEN 'B:true' ELSE 'B:false' END,
          'IsTradeItemAnOrderableUnit', CASE p_partkey % 3 WHEN 0 THEN 'B:true' WHEN 1 THEN 'N:1' END,
          'IsTradeItemAnInvoiceUnit', CASE WHEN p_partkey % 2 = 0 THEN 'B:true' ELSE 'B:false' END,
          'TradeItemUnitDescriptorCode', named_struct('Value', {p['unit']}),
          'InformationProviderOfTradeItem', named_struct('PartyName', {p['party']}),
          'InformationProvider', named_struct('Name', {p['ip_name']}),
          'TradeItemSynchronisationDates', named_struct('LastChangeDateTime', {p['ti_lu']}),
          'DeliveryPurchasingInformationModule', named_struct('DeliveryPurchasingInformation',
              named_struct('StartAvailabilityDateTime', {start})),
          'TradeItemDescriptionModule', named_struct('TradeItemDescriptionInformation', named_struct(
              'BrandNameInformation', named_struct('BrandName', {brand}),
              'TradeItemDescription', {desc}, 'DescriptionShort', {short})),
          'GdsnTradeItemClassification', named_struct('GpcCategoryCode', {p['cat_code']},
              'GpcCategoryName', {p['cat_name']}, 'GpcSegmentCode', {p['seg']},
              'GpcFamilyCode', {p['family']}, 'GpcClassCode', {p['class']}),
          'TradeItemMeasurementsModule', {meas},
          'ReferencedFileDetailInformationModule', CASE WHEN {p['n_img']} >= 1 THEN
              named_struct('ReferencedFileHeader', {header}) END,
          'MarketingInformationModule', CASE WHEN {p['n_img']} = 3 THEN named_struct('Assets',
              array(named_struct('Asset', named_struct('url', {p['u3']}, 'name', {p['f3']})))) END),
      'Links', CASE WHEN p_partkey % 9 = 0 THEN array(named_struct('Url', {p['u4']})) END)"""


def base_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw document per part (v1) plus a later version for some parts.

    The versions are dealt evenly before their documents are built: a document is many times the text of its part, and
    the whole table may lie in one row group, which one task reads. The number of parts grows with the table."""
    part = table(spark, sf_dir, "part")
    versions = (part.withColumn("version", F.explode(F.when(F.expr(R.HAS_V2), F.array(F.lit(1), F.lit(2)))
                                                     .otherwise(F.array(F.lit(1)))))
                .repartition(8 * part.rdd.getNumPartitions()))

    def of_version(v1: str, v2: str) -> str:
        return f"(CASE version WHEN 1 THEN {R.PART[v1]} ELSE {R.PART[v2]} END)"
    doc = _base_struct(of_version("start", "start_v2"), of_version("brand", "brand_v2"))
    return versions.select(F.col("p_partkey").alias("k"), "version", F.expr(R.SILVER_ID_BASE).alias("Id"),
                           _json(doc).alias("raw_json"),
                           F.expr(f"CASE version WHEN 1 THEN {R.INGEST_V1} ELSE {R.INGEST_V2} END").alias("ingest_ts"))


def bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed, NULL and root-array documents derived from part keys."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    mal = part.where(F.expr(R.IS_MALFORMED)).select(
        F.concat(F.lit("X"), k).alias("Id"), F.lit("{bad").alias("raw_json"),
        F.expr(R.INGEST_V1).alias("ingest_ts"))
    nul = part.where(F.expr(R.IS_NULL_DOC)).select(
        F.concat(F.lit("N"), k).alias("Id"), F.lit(None).cast("string").alias("raw_json"),
        F.expr(R.INGEST_V1).alias("ingest_ts"))
    arr = part.where(F.expr(R.IS_ROOT_ARRAY)).select(
        F.concat(F.lit("A"), k).alias("Id"),
        F.concat(F.lit('[{"TradeItem":{"Gtin":"'), k, F.lit('"}}]')).alias("raw_json"),
        F.expr(R.INGEST_V1).alias("ingest_ts"))
    return mal.unionByName(nul).unionByName(arr)


def case_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, child gtin, quantity): summed per child before any list is built.

    The rows are dealt by (order, line) once: the sums and the lists of a line are both made where they then lie. The
    number of parts grows with the table, so that none outgrows its task's memory."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * li.rdd.getNumPartitions())
    return (li.repartition(n, "l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber", "l_partkey")
            .agg(F.sum("l_quantity").cast("bigint").alias("qty"))
            .withColumn("child_gtin", F.lpad(F.col("l_partkey").cast("string"), 14, "0")))


def case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packaging (case) document per order line; children are the
    distinct parts of that line with their summed quantity, sorted by GTIN.

    Field types are real (numbers, booleans) so ``to_json`` writes the JSON
    literals directly; only the total quantity changes type between rows
    (number or decimal text), which is a CASE over two struct variants."""
    c = R.CASE_DOC
    grouped = (case_children(spark, sf_dir)
               .groupBy("l_orderkey", "l_linenumber")
               .agg(F.array_sort(F.collect_list(F.struct(
                   F.col("child_gtin").alias("Gtin"),
                   F.col("qty").alias("QuantityOfNextLowerLevelTradeItem")))).alias("children"),
                    F.sum("qty").alias("total")))

    def doc(total_sql: str) -> str:
        return f"""to_json(named_struct(
          'CatalogueItemInfo', named_struct('Id', {c['ci_id']}, 'LastUpdatedDateTime', {c['ci_lu']}),
          'TradeItem', named_struct(
              'Gtin', {c['gtin']},
              'IsTradeItemADespatchUnit', {c['despatch']},
              'TradeItemUnitDescriptorCode', named_struct('Value', {c['unit']}),
              'DeliveryPurchasingInformationModule', named_struct('DeliveryPurchasingInformation',
                  named_struct('StartAvailabilityDateTime', {c['start']})),
              'TradeItemMeasurementsModule', named_struct('TradeItemMeasurements', named_struct(
                  'Depth', named_struct('Value', CAST({c['depth']} AS BIGINT)),
                  'Width', named_struct('Value', CAST({c['width']} AS BIGINT)),
                  'Height', named_struct('Value', CAST({c['height']} AS BIGINT)),
                  'TradeItemWeight', named_struct('GrossWeight', named_struct('Value',
                      CAST({c['weight']} AS BIGINT))))),
              'NextLowerLevelTradeItemInformation', named_struct(
                  'TotalQuantityOfNextLowerLevelTradeItem', {total_sql},
                  'ChildTradeItem', children))))"""

    raw = F.expr(f"""CASE {c['total_mode']}
        WHEN 'text' THEN {doc("CAST(total AS STRING) || '.0'")}
        WHEN 'number' THEN {doc("total")}
        ELSE {doc("CAST(NULL AS BIGINT)")} END""")
    return grouped.select(F.expr(c["ci_id"]).alias("Id"), raw.alias("raw_json"),
                          F.expr(R.INGEST_V1).alias("ingest_ts"))


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw items: (Id, raw_json, ingest_ts), built from the driver's tables."""
    base = base_documents(spark, sf_dir).select("Id", "raw_json", "ingest_ts")
    return (base.unionByName(bad_documents(spark, sf_dir))
            .unionByName(case_documents(spark, sf_dir)))


_LANDED: dict[tuple[str, str], str] = {}
_LANDING = threading.Lock()


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver raw-item table: (Id, raw_json, ingest_ts).

    The documents are landed once for each application and folder, in full, and read from there: the
    optimizer would otherwise build each document's text anew for every field that a query asks of it.
    """
    key = spark.sparkContext.applicationId, sf_dir.rstrip("/")
    with _LANDING:
        path = _LANDED.get(key)
        if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
            path = _LANDED[key] = scratch_path(spark, "silver-landing")
            save(silver_documents(spark, sf_dir), path)
    return spark.read.schema(SILVER_SCHEMA).parquet(path)


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail hierarchy rows (GTIN, L2, L3, L4), duplicates included."""
    part = table(spark, sf_dir, "part")
    h = R.HIER
    real = part.where(F.expr(h["present"])).select(
        F.expr(h["key"]).alias("GTIN"), F.expr(h["l2"]).alias("PRODUCT_HIERARCHY_LEVEL_2"),
        F.expr(h["l3"]).alias("PRODUCT_HIERARCHY_LEVEL_3"),
        F.expr(h["l4"]).alias("PRODUCT_HIERARCHY_LEVEL_4"))
    dup = part.where(F.expr(h["present"]) & F.expr(h["dup"])).select(
        F.expr(h["key"]).alias("GTIN"), F.expr(h["l2_dup"]).alias("PRODUCT_HIERARCHY_LEVEL_2"),
        F.expr(h["l3_dup"]).alias("PRODUCT_HIERARCHY_LEVEL_3"),
        F.expr(h["l4_dup"]).alias("PRODUCT_HIERARCHY_LEVEL_4"))
    return real.unionByName(dup)


def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales per EAN (part key text) and sales group: lineitem summed
    per (part, year, week) map-side first, then joined to part for the group."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    d = F.to_date("l_shipdate")
    weekly = (li.select("l_partkey", F.year(d).alias("year"),
                        (year_week(d) % 100).alias("week"), "l_quantity")
              .groupBy("l_partkey", "year", "week")
              .agg(F.sum("l_quantity").alias("qty")))
    return (weekly.join(part, weekly.l_partkey == part.p_partkey)
            .select(F.col("l_partkey").cast("string").alias("ean"),
                    F.expr(R.SALES_GROUP).alias("group_id"), "year", "week"))


def key_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-listing page envelopes as JSON text, one row per page (<= 90 ids),
    as a paged REST listing would land them. Offsets use the three spellings."""
    ev = table(spark, sf_dir, "events")
    items = ev.select(F.expr(R.EVENTS["page"]).alias("page"), "event_id",
                      F.expr(R.EVENTS["id"]).alias("Id"),
                      F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("UpdatedAt"))
    pages = (items.groupBy("page")
             .agg(F.sort_array(F.collect_list(F.struct("event_id", "Id", "UpdatedAt"))).alias("it")))
    nxt = pages.select((F.col("page") - 1).alias("page"), F.lit(True).alias("has_next"))
    tok = F.concat(F.lit("P"), (F.col("page") + 1).cast("string"))
    hn = F.coalesce(F.col("has_next"), F.lit(False))
    env = F.struct(
        F.transform("it", lambda x: F.struct(x["Id"].alias("Id"), x["UpdatedAt"].alias("UpdatedAt")))
         .alias("Items"),
        F.when(hn & (F.col("page") % 3 == 0), tok).when(hn & (F.col("page") % 3 == 1), F.lit(""))
         .alias("NextOffset"),
        F.when(hn & (F.col("page") % 3 == 1), tok).alias("NextofSet"),
        F.when(hn & (F.col("page") % 3 == 2), tok).alias("NextOfSet"))
    return (pages.join(nxt, "page", "left")
            .select(F.col("page").alias("page_no"), F.to_json(env).alias("envelope")))
