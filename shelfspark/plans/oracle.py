"""Independent SQL oracle (DuckDB dialect) for every registered query.

Expected rows are computed from the base tables through the flat fixture
rules, never by parsing the JSON documents the Spark side generates, so the
JSON operators are checked independently. The prefix join is written with
LIKE here (the Spark side uses an equi-join rewrite).
"""

from __future__ import annotations

import mimetypes

from ..functions.columns import EXTENSION_POINTS, SUFFIX_POINTS
from ..schemas import CURATED_FIELDS
from . import rules as R

P, C, H = R.PART, R.CASE_DOC, R.HIER

_BOOL = {n for n, t in CURATED_FIELDS if t.typeName() == "boolean"}


def _null(col: str) -> str:
    return f"CAST(NULL AS {'BOOLEAN' if col in _BOOL else 'VARCHAR'}) AS {col}"


def _select(exprs: dict[str, str], extra: list[str] | None = None) -> str:
    cols = [f"{exprs[n]} AS {n}" if n in exprs else _null(n) for n, _ in CURATED_FIELDS]
    return ", ".join((extra or []) + cols)


SUFFIX_SQL = ("CASE upper(regexp_extract(url, '_([A-Za-z0-9]{4})\\.', 1)) "
              + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SUFFIX_POINTS.items()) + " ELSE 0 END")
EXT_SQL_RAW = ("CASE WHEN strpos(lower(trim(url)), '.') > 0 "
               "THEN regexp_extract(lower(trim(url)), '([^.]*)$', 1) END")
EXT_SQL = (f"CASE {EXT_SQL_RAW} "
           + " ".join(f"WHEN '{k}' THEN {v}" for k, v in EXTENSION_POINTS.items()) + " ELSE 0 END")


def _excl(l2: str = "L2", l3: str = "L3") -> str:
    whole = ", ".join(f"'{a}'" for a, b in R.EXCLUSION_RULES if b is None)
    parts = [f"NOT ({l2} IN ({whole}))"] if whole else []
    by: dict[str, list[str]] = {}
    for a, b in R.EXCLUSION_RULES:
        if b is not None:
            by.setdefault(a, []).append(b)
    for a, bs in by.items():
        parts.append(f"NOT ({l2} = '{a}' AND {l3} IN ({', '.join(repr(x) for x in bs)}))")
    return " AND ".join(parts) or "true"


CTES: dict[str, str] = {}

CTES["exp_img_c"] = f"""
  SELECT p_partkey AS k, 1 AS slot, {P['u1']} AS url, {P['f1']} AS filename, {P['m1']} AS media_id
    FROM part WHERE p_partkey % 4 >= 1
  UNION ALL SELECT p_partkey, 2, {P['u2']}, {P['f2']}, {P['m2']} FROM part WHERE p_partkey % 4 >= 2
  UNION ALL SELECT p_partkey, 3, {P['u3']}, {P['f3']}, NULL FROM part WHERE p_partkey % 4 = 3
  UNION ALL SELECT p_partkey, 4, {P['u4']}, NULL, NULL FROM part WHERE p_partkey % 9 = 0"""
CTES["exp_img"] = """
  SELECT k, slot, url, filename, media_id,
         CAST(row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS INTEGER) AS ord
  FROM exp_img_c"""
CTES["exp_img_scored"] = f"""
  SELECT k, ord, url, filename, media_id, {SUFFIX_SQL} + {EXT_SQL} AS score FROM exp_img
  QUALIFY row_number() OVER (PARTITION BY k, url ORDER BY ord) = 1"""
CTES["exp_img_top"] = """
  SELECT k,
    max(CASE WHEN rn = 1 THEN url END) AS PrimaryImageUrl,
    max(CASE WHEN rn = 1 THEN filename END) AS PrimaryImageFileName,
    max(CASE WHEN rn = 1 THEN media_id END) AS PrimaryImageMediaItemId,
    max(CASE WHEN rn = 2 THEN url END) AS SecondaryImageUrl
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, ord) AS rn
        FROM exp_img_scored) t GROUP BY k"""

_IMG = {c: f"i.{c}" for c in ("PrimaryImageUrl", "PrimaryImageFileName",
                               "PrimaryImageMediaItemId", "SecondaryImageUrl")}


def _base_exprs(version: int) -> dict[str, str]:
    e = dict(R.EXPECTED_BASE)
    e["StartAvailabilityDateTime"] = P["start"] if version == 1 else P["start_v2"]
    e["BrandName"] = P["brand"] if version == 1 else P["brand_v2"]
    e["UpdatedAt"] = R.INGEST_V1 if version == 1 else R.INGEST_V2
    e.update(_IMG)
    return e


CTES["exp_base"] = f"""
  SELECT {_select(_base_exprs(1), ['p_partkey AS k', '1 AS version'])}
    FROM part LEFT JOIN exp_img_top i ON i.k = part.p_partkey
  UNION ALL
  SELECT {_select(_base_exprs(2), ['p_partkey AS k', '2 AS version'])}
    FROM part LEFT JOIN exp_img_top i ON i.k = part.p_partkey WHERE {R.HAS_V2}"""

CTES["exp_case_child"] = """
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey"""
CTES["exp_case_doc"] = """
  SELECT l_orderkey, l_linenumber, CAST(sum(qty) AS BIGINT) AS total,
    '[' || string_agg('{"Gtin":"' || lpad(CAST(l_partkey AS STRING), 14, '0')
        || '","QuantityOfNextLowerLevelTradeItem":' || CAST(qty AS STRING) || '}', ','
        ORDER BY lpad(CAST(l_partkey AS STRING), 14, '0')) || ']' AS child_json
  FROM exp_case_child GROUP BY l_orderkey, l_linenumber"""
_CASE_EXPR = {
    "StartAvailabilityDateTime": C["start"], "Depth_mm": C["depth"], "Width_mm": C["width"],
    "Height_mm": C["height"], "GrossWeight_g": C["weight"], "TradeItemUnitDescriptor": C["unit"],
    "GTIN": C["gtin"], "Id": C["ci_id"], "LastUpdatedDateTime": C["ci_lu"],
    "IsDespatchUnit": C["despatch"],
    "TotalQuantityOfNextLowerLevelTradeItem": (
        f"CASE {C['total_mode']} WHEN 'absent' THEN NULL WHEN 'text' THEN CAST(total AS STRING) "
        f"|| '.0' ELSE CAST(total AS STRING) END"),
    "ChildTradeItemJson": "child_json", "UpdatedAt": R.INGEST_V1,
}
CTES["exp_case"] = f"SELECT {_select(_CASE_EXPR)} FROM exp_case_doc"
CTES["exp_bad"] = (f"SELECT {_select({'UpdatedAt': R.INGEST_V1})} FROM part WHERE {R.IS_MALFORMED} "
                   f"UNION ALL SELECT {_select({'UpdatedAt': R.INGEST_V1})} FROM part "
                   f"WHERE {R.IS_ROOT_ARRAY}")
_COLS = ", ".join(n for n, _ in CURATED_FIELDS)
CTES["exp_curated"] = f"""
  SELECT {_COLS} FROM exp_base UNION ALL SELECT {_COLS} FROM exp_case
  UNION ALL SELECT {_COLS} FROM exp_bad"""
_FIRST3 = ["StartAvailabilityDateTime", "UpdatedAt", "LastUpdatedDateTime"]
_REST = ["Id"] + [n for n, _ in CURATED_FIELDS if n not in _FIRST3 and n not in ("GTIN", "Id")]
_LATEST_ORDER = ", ".join([f"{c} DESC NULLS LAST" for c in _FIRST3] + [f"{c} ASC NULLS LAST" for c in _REST])
CTES["exp_latest"] = f"""
  SELECT {_COLS} FROM exp_curated
  QUALIFY row_number() OVER (PARTITION BY GTIN ORDER BY {_LATEST_ORDER}) = 1"""

# ---- hierarchy
CTES["exp_hier"] = f"""
  SELECT {H['key']} AS GTIN, {H['l2']} AS L2, {H['l3']} AS L3, {H['l4']} AS L4
    FROM part WHERE {H['present']}
  UNION ALL SELECT {H['key']}, {H['l2_dup']}, {H['l3_dup']}, {H['l4_dup']}
    FROM part WHERE {H['present']} AND {H['dup']}"""
CTES["exp_hier_dedup"] = """
  SELECT * FROM exp_hier WHERE GTIN IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY GTIN ORDER BY L2 NULLS LAST, L3 NULLS LAST, L4 NULLS LAST) = 1"""
_WEEK = "CAST(ceil((dayofyear(d) + dayofweek(date_trunc('year', d))) / 7) AS INTEGER)"
_THRESHOLD = (f"(SELECT year(d) * 100 + {_WEEK} FROM "
              f"(SELECT CAST(DATE '{R.AS_OF}' - INTERVAL 4 MONTH AS DATE) AS d) t)")
CTES["exp_sales"] = f"""
  SELECT CAST(l_partkey AS STRING) AS EAN, {R.SALES_GROUP} AS group_id,
         year(d) AS year, {_WEEK} AS week
  FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem) li
  JOIN part ON p_partkey = l_partkey"""
CTES["exp_recent"] = f"""
  SELECT DISTINCT s.EAN, h.L2, h.L3, h.L4
  FROM (SELECT DISTINCT EAN, group_id FROM exp_sales WHERE year * 100 + week >= {_THRESHOLD}) s
  LEFT JOIN exp_hier h ON h.L4 LIKE s.group_id || ' - %'
  WHERE h.L2 IS NOT NULL"""
CTES["exp_recent_dedup"] = """
  SELECT * FROM exp_recent
  QUALIFY row_number() OVER (PARTITION BY EAN ORDER BY L2 NULLS LAST, L3 NULLS LAST, L4 NULLS LAST) = 1"""
CTES["exp_hkeep"] = f"""
  SELECT GTIN AS key, CASE WHEN {_excl()} THEN L2 END AS h2, CASE WHEN {_excl()} THEN L3 END AS h3,
         CASE WHEN {_excl()} THEN L4 END AS h4 FROM exp_hier_dedup"""
CTES["exp_rkeep"] = f"""
  SELECT EAN AS key, CASE WHEN {_excl()} THEN L2 END AS r2, CASE WHEN {_excl()} THEN L3 END AS r3,
         CASE WHEN {_excl()} THEN L4 END AS r4 FROM exp_recent_dedup"""
CTES["exp_keys"] = "SELECT key FROM exp_hkeep UNION SELECT key FROM exp_rkeep"
_OWN = f"coalesce(upper(trim(c.InfoProviderName)) = '{R.OWN_PROVIDER.upper()}', false)"
CTES["exp_tiers"] = f"""
  SELECT c.*, c.nlz AS GTIN_NO_LEADING_ZEROS,
    r0.r2 AS t0_2, r0.r3 AS t0_3, r0.r4 AS t0_4, h1.h2 AS t1_2, h1.h3 AS t1_3, h1.h4 AS t1_4,
    h2.h2 AS t2_2, h2.h3 AS t2_3, h2.h4 AS t2_4,
    (c.GTIN IN (SELECT key FROM exp_keys) OR c.nlz IN (SELECT key FROM exp_keys)) IS TRUE AS known,
    {_OWN} AS own
  FROM (SELECT *, NULLIF(ltrim(GTIN, '0'), '') AS nlz FROM exp_latest) c
  LEFT JOIN exp_hkeep h1 ON h1.key = c.GTIN
  LEFT JOIN exp_rkeep r0 ON r0.key = c.nlz
  LEFT JOIN exp_hkeep h2 ON h2.key = c.nlz"""
_NOMATCH = ("(t0_2 IS NULL AND t0_3 IS NULL AND t0_4 IS NULL AND t1_2 IS NULL AND t1_3 IS NULL "
            "AND t1_4 IS NULL)")
CTES["exp_lv"] = f"""
  SELECT *, coalesce(t0_2, t1_2, CASE WHEN {_NOMATCH} THEN t2_2 END) AS lv2,
            coalesce(t0_3, t1_3, CASE WHEN {_NOMATCH} THEN t2_3 END) AS lv3,
            coalesce(t0_4, t1_4, CASE WHEN {_NOMATCH} THEN t2_4 END) AS lv4,
            CASE WHEN {_NOMATCH} THEN t2_2 END AS t2x_2
  FROM exp_tiers"""
CTES["exp_gold"] = f"""
  SELECT *, CASE WHEN ph THEN '{R.PLACEHOLDER}' ELSE lv2 END AS PRODUCT_HIERARCHY_LEVEL_2,
    CASE WHEN ph THEN '{R.PLACEHOLDER}' ELSE lv3 END AS PRODUCT_HIERARCHY_LEVEL_3,
    CASE WHEN ph THEN '{R.PLACEHOLDER}' ELSE lv4 END AS PRODUCT_HIERARCHY_LEVEL_4,
    CASE WHEN t0_2 IS NOT NULL THEN 'recent_sales' WHEN t1_2 IS NOT NULL THEN 'hierarchy_direct'
         WHEN t2x_2 IS NOT NULL THEN 'hierarchy_stripped' WHEN ph THEN 'own_placeholder' END
      AS CATEGORY_SOURCE
  FROM (SELECT *, (own AND lv2 IS NULL AND NOT known) AS ph FROM exp_lv) t"""

# ---- packaging
CTES["exp_edges"] = f"""
  SELECT lpad(CAST(cc.l_partkey AS STRING), 14, '0') AS BaseGTIN, c.GTIN AS Case_GTIN,
    c.Depth_mm AS Case_Depth_mm, c.Width_mm AS Case_Width_mm, c.Height_mm AS Case_Height_mm,
    c.GrossWeight_g AS Case_GrossWeight_g,
    CASE WHEN {C['total_mode']} = 'absent' THEN NULL ELSE d.total END AS UnitsPerCase,
    cc.qty AS ChildQuantity
  FROM exp_case_child cc JOIN exp_case_doc d USING (l_orderkey, l_linenumber)
  JOIN exp_latest c ON c.GTIN = {C['gtin']}
  WHERE c.TradeItemUnitDescriptor = 'CASE' AND c.IsDespatchUnit"""
CTES["exp_pick"] = """
  SELECT BaseGTIN, Case_GTIN, Case_Depth_mm, Case_Width_mm, Case_Height_mm, Case_GrossWeight_g,
         UnitsPerCase FROM exp_edges
  QUALIFY row_number() OVER (PARTITION BY BaseGTIN ORDER BY UnitsPerCase NULLS LAST, Case_GTIN) = 1"""
_SELF = "coalesce(b.IsDespatchUnit, false)"
CTES["exp_casedims"] = f"""
  SELECT b.GTIN, b.TradeItemUnitDescriptor,
    coalesce(p.Case_GTIN, CASE WHEN {_SELF} THEN b.GTIN END) AS Case_GTIN,
    coalesce(p.Case_Depth_mm, CASE WHEN {_SELF} THEN b.Depth_mm END) AS Case_Depth_mm,
    coalesce(p.Case_Width_mm, CASE WHEN {_SELF} THEN b.Width_mm END) AS Case_Width_mm,
    coalesce(p.Case_Height_mm, CASE WHEN {_SELF} THEN b.Height_mm END) AS Case_Height_mm,
    coalesce(p.Case_GrossWeight_g, CASE WHEN {_SELF} THEN b.GrossWeight_g END) AS Case_GrossWeight_g,
    coalesce(p.UnitsPerCase, CASE WHEN {_SELF} THEN CAST(1 AS BIGINT) END) AS UnitsPerCase
  FROM exp_latest b LEFT JOIN exp_pick p ON p.BaseGTIN = b.GTIN
  WHERE b.TradeItemUnitDescriptor = 'BASE_UNIT_OR_EACH'
  UNION ALL
  SELECT GTIN, TradeItemUnitDescriptor, NULL, NULL, NULL, NULL, NULL, CAST(NULL AS BIGINT)
  FROM exp_latest WHERE TradeItemUnitDescriptor IS NULL OR TradeItemUnitDescriptor <> 'BASE_UNIT_OR_EACH'"""

# ---- keys
CTES["exp_keys_all"] = f"""
  SELECT {R.EVENTS['id']} AS Id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS UpdatedAt,
         {R.EVENTS['page']} AS page, event_id FROM events"""
CTES["exp_bronze"] = "SELECT Id, UpdatedAt FROM exp_keys_all WHERE Id IS NOT NULL AND Id <> ''"

# ---- publishing
_PUB = ["PrimaryImageUrl", "TradeItemDescription_fi", "PrimaryImageFileName", "GpcFamilyCode",
        "GpcClassCode", "BrandName", "GTIN", "GTIN_NO_LEADING_ZEROS", "PRODUCT_HIERARCHY_LEVEL_2",
        "PRODUCT_HIERARCHY_LEVEL_3", "PRODUCT_HIERARCHY_LEVEL_4"]
CTES["exp_pub"] = f"""
  SELECT {', '.join(_PUB)} FROM exp_gold
  WHERE TradeItemUnitDescriptor = 'BASE_UNIT_OR_EACH'
    AND PrimaryImageUrl IS NOT NULL AND length(trim(PrimaryImageUrl)) > 0
    AND PRODUCT_HIERARCHY_LEVEL_2 IS NOT NULL AND length(trim(PRODUCT_HIERARCHY_LEVEL_2)) > 0"""


def _s(c: str) -> str:
    return f"coalesce(trim(CAST({c} AS VARCHAR)), '')"


_PATH_EXT = ("CASE " + " ".join(
    f"WHEN ends_with(lower(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')), "
    f"'{e}') THEN '{e}'" for e in [".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".tif", ".tiff"])
    + " END")
_BASE = (f"CASE WHEN {_s('GTIN_NO_LEADING_ZEROS')} <> '' THEN {_s('GTIN_NO_LEADING_ZEROS')} "
         f"WHEN {_s('PrimaryImageFileName')} <> '' THEN "
         f"trim(regexp_replace({_s('PrimaryImageFileName')}, '\\.[^.]+$', '')) "
         f"WHEN {_s('GpcFamilyCode')} <> '' THEN {_s('GpcFamilyCode')} ELSE 'unknown' END")
_META_FIELDS = [("ean", "base"), ("family", _s("GpcFamilyCode")), ("class", _s("GpcClassCode")),
                ("brand", _s("BrandName")), ("level2", _s("PRODUCT_HIERARCHY_LEVEL_2")),
                ("level3", _s("PRODUCT_HIERARCHY_LEVEL_3")), ("level4", _s("PRODUCT_HIERARCHY_LEVEL_4")),
                ("product", _s("TradeItemDescription_fi"))]
_META_TEXT = ("concat_ws('|', " + ", ".join(
    f"CASE WHEN {v} <> '' THEN '{k}=' || {v} END" for k, v in sorted(_META_FIELDS)) + ")")
_META_N = "(" + " + ".join(f"CASE WHEN {v} <> '' THEN 1 ELSE 0 END" for _, v in _META_FIELDS) + ")"
CTES["exp_manifest0"] = f"""
  SELECT GTIN AS gtin, {_s('PrimaryImageUrl')} AS url, {_BASE} AS base, *
  FROM exp_pub"""
CTES["exp_manifest"] = f"""
  SELECT gtin, url, base, coalesce({_PATH_EXT}, '.jpg') AS ext,
    'images/' || base || coalesce({_PATH_EXT}, '.jpg') AS target,
    {_META_TEXT} AS metadata_text, {_META_N} AS n_fields
  FROM exp_manifest0"""
CTES["exp_manifest_w"] = """
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY gtin NULLS LAST, url) = 1 AS is_winner
  FROM exp_manifest"""


def _ct_case() -> str:
    mt = mimetypes.MimeTypes(filenames=())
    types = sorted(set(mt.types_map[1].values()) | set(mt.types_map[0].values()))
    arms = [f"WHEN '{t}' THEN '{mt.guess_extension(t)}'" for t in types if mt.guess_extension(t)]
    return "CASE lower(trim(split_part(coalesce(content_type, ''), ';', 1))) " + " ".join(arms) + " END"


def with_(ctes: list[str], body: str) -> str:
    """Assemble the needed CTEs (with their dependencies, in order) + body."""
    order = list(CTES)
    need: set[str] = set()

    def add(name: str) -> None:
        if name in need:
            return
        need.add(name)
        for other in order:
            if other != name and other in CTES[name]:
                add(other)

    for c in ctes:
        add(c)
    parts = [f"{n} AS ({CTES[n]})" for n in order if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _content_type_sql() -> str:
    ext = EXT_SQL_RAW
    return (f"CASE WHEN {ext} IN ('jpg', 'jpeg') THEN 'image/jpeg' "
            f"WHEN {ext} = 'png' THEN 'image/png; charset=binary' WHEN {ext} = 'webp' THEN 'IMAGE/WEBP' "
            f"WHEN {ext} = 'bmp' THEN 'application/octet-stream' WHEN {ext} = 'gif' THEN '' END")


_DISPLAY = ("CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', chr(160)) "
            "WHEN 2 THEN '  ' || upper(p_name) || ' ' ELSE replace(p_name, ' ', ' – ') END")
_NORM = ("lower(trim(regexp_replace(translate(coalesce(display, ''), chr(160) || '‐‑‒–—−­', ' -------'), "
         "'\\s+', ' ', 'g')))")

_CAT = """
  SELECT GpcCategoryCode, GpcCategoryName, count(*) AS n FROM (
    SELECT p_type AS GpcCategoryCode, {name} AS GpcCategoryName FROM part
    UNION ALL SELECT p_type, {name} FROM part WHERE {v2}) t
  GROUP BY GpcCategoryCode, GpcCategoryName""".format(name=P["cat_name"], v2=R.HAS_V2)
CTES["exp_catnames"] = f"""
  SELECT c.GpcCategoryCode, b.GpcCategoryName AS SelectedName,
         string_agg(c.GpcCategoryName, '|' ORDER BY c.GpcCategoryName) AS DistinctNames
  FROM ({_CAT}) c LEFT JOIN (
    SELECT GpcCategoryCode, GpcCategoryName FROM ({_CAT}) x
    WHERE GpcCategoryName IS NOT NULL AND trim(GpcCategoryName) <> ''
    QUALIFY row_number() OVER (PARTITION BY GpcCategoryCode ORDER BY
      regexp_matches(GpcCategoryName, '[åäöÅÄÖ]') DESC, n DESC, length(GpcCategoryName) DESC,
      GpcCategoryName DESC) = 1) b USING (GpcCategoryCode)
  GROUP BY c.GpcCategoryCode, b.GpcCategoryName"""

_SILVER_IDS = f"""
  SELECT {R.SILVER_ID_BASE} AS Id FROM part
  UNION ALL SELECT {R.SILVER_ID_BASE} FROM part WHERE {R.HAS_V2}
  UNION ALL SELECT 'X' || CAST(p_partkey AS STRING) FROM part WHERE {R.IS_MALFORMED}
  UNION ALL SELECT 'N' || CAST(p_partkey AS STRING) FROM part WHERE {R.IS_NULL_DOC}
  UNION ALL SELECT 'A' || CAST(p_partkey AS STRING) FROM part WHERE {R.IS_ROOT_ARRAY}
  UNION ALL SELECT {C['ci_id']} FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t"""

_TYPE_MISMATCH = "(p_partkey % 5 = 3 OR p_partkey % 4 = 2 OR p_partkey % 3 = 1)"
_SEG = f"coalesce(NULLIF({P['seg']}, ''), {P['root_seg']})"


def _silver_rows(cols: str, where: str = "true") -> str:
    """Base (v1, v2) document rows of silver as flat rule rows."""
    return (f"SELECT {cols}, {R.INGEST_V1} AS ingest_ts FROM part WHERE {where} "
            f"UNION ALL SELECT {cols}, {R.INGEST_V2} AS ingest_ts FROM part WHERE {R.HAS_V2} AND {where}")


ORACLE: dict[str, str] = {}
Q = ORACLE

Q["ingest_keys_full"] = with_(["exp_bronze"], "SELECT Id, UpdatedAt FROM exp_bronze")
Q["ingest_keys_changes"] = with_(["exp_bronze"],
                                 f"SELECT Id, UpdatedAt FROM exp_bronze WHERE UpdatedAt >= '{R.SINCE}'")
Q["ingest_keys_stream"] = Q["ingest_keys_full"]
Q["next_offset"] = with_(["exp_keys_all"], """
  SELECT p.page, CASE WHEN n.page IS NOT NULL THEN 'P' || CAST(p.page + 1 AS STRING) END AS next_offset
  FROM (SELECT DISTINCT page FROM exp_keys_all) p
  LEFT JOIN (SELECT DISTINCT page FROM exp_keys_all) n ON n.page = p.page + 1""")
Q["id_batches"] = with_(["exp_bronze"], """
  SELECT Id, bucket, CAST(floor((row_number() OVER (ORDER BY bucket, Id) - 1) / 1000) AS BIGINT) AS batch_no
  FROM (SELECT DISTINCT Id, (('0x' || substr(md5(Id), 1, 8))::BIGINT) % 64 AS bucket FROM exp_bronze) t""")
Q["bronze_snapshot"] = with_(["exp_bronze"], f"SELECT Id, '{R.RUN_START}' AS load_time FROM exp_bronze")
Q["distinct_keys"] = with_(["exp_bronze"], "SELECT DISTINCT Id FROM exp_bronze")
Q["silver_append"] = (f"SELECT Id, {R.INGEST_V1} AS ingest_ts, CAST(NULL AS VARCHAR) AS batch FROM "
                      f"({_SILVER_IDS.replace(f'UNION ALL SELECT {R.SILVER_ID_BASE} FROM part WHERE {R.HAS_V2}', '')}) s "
                      f"UNION ALL SELECT {R.SILVER_ID_BASE}, {R.INGEST_V2}, 'changes' FROM part WHERE {R.HAS_V2}")
Q["snapshot_read"] = with_(["exp_hier"], """
  SELECT GTIN, L2 AS PRODUCT_HIERARCHY_LEVEL_2, L3 AS PRODUCT_HIERARCHY_LEVEL_3,
         L4 AS PRODUCT_HIERARCHY_LEVEL_4 FROM exp_hier""")
Q["topn_projection"] = with_(["exp_hier"], """
  SELECT GTIN, L2 AS PRODUCT_HIERARCHY_LEVEL_2 FROM exp_hier
  ORDER BY GTIN DESC NULLS LAST, L2 ASC NULLS FIRST LIMIT 100""")

Q["json_path_get"] = with_(["exp_curated"], """
  SELECT GTIN, Depth_mm, coalesce(Depth_mm, 'n/a') AS depth_or_default FROM exp_curated""")
Q["localized_pick"] = with_(["exp_curated"], "SELECT GTIN, TradeItemDescription_fi FROM exp_curated")
Q["key_fallback"] = with_(["exp_curated"], "SELECT GTIN, Id, InfoProviderName, LastUpdatedDateTime FROM exp_curated")
Q["strict_boolean"] = with_(["exp_curated"], """
  SELECT GTIN, Deleted, IsConsumerUnit, IsDespatchUnit, IsOrderableUnit, IsInvoiceUnit FROM exp_curated""")
Q["strip_zeros"] = """
  SELECT k, raw, NULLIF(ltrim(raw, '0'), '') AS stripped FROM (
    SELECT p_partkey AS k, CASE p_partkey % 10 WHEN 0 THEN lpad(CAST(p_partkey AS STRING), 14, '0')
      WHEN 1 THEN CAST(p_partkey AS STRING) WHEN 2 THEN '000' WHEN 3 THEN '' WHEN 4 THEN NULL
      WHEN 5 THEN '0' || CAST(p_partkey AS STRING) || 'a0'
      ELSE lpad(CAST(p_partkey AS STRING), 8, '0') END AS raw FROM part) t"""
Q["curate_full"] = with_(["exp_curated"], "SELECT * FROM exp_curated")
Q["latest_per_key"] = with_(["exp_latest"], "SELECT * FROM exp_latest")
Q["quarantine"] = f"""
  {_silver_rows(f"{R.SILVER_ID_BASE} AS Id, 'type_mismatch' AS reason", _TYPE_MISMATCH)}
  UNION ALL SELECT 'X' || CAST(p_partkey AS STRING), 'malformed_json', {R.INGEST_V1} FROM part WHERE {R.IS_MALFORMED}
  UNION ALL SELECT 'N' || CAST(p_partkey AS STRING), 'null_document', {R.INGEST_V1} FROM part WHERE {R.IS_NULL_DOC}
  UNION ALL SELECT 'A' || CAST(p_partkey AS STRING), 'not_an_object', {R.INGEST_V1} FROM part WHERE {R.IS_ROOT_ARRAY}"""
Q["segment_filter"] = _silver_rows(f"{R.SILVER_ID_BASE} AS Id", f"{_SEG} = '{R.SEGMENT}'")
Q["segment_skips"] = f"""
  SELECT ingest_ts AS batch, outcome, count(*) AS n FROM (
    {_silver_rows(f"CASE WHEN {_SEG} = '{R.SEGMENT}' THEN 'written' ELSE 'skipped' END AS outcome")}
    UNION ALL SELECT 'skipped', {R.INGEST_V1} FROM part WHERE {R.IS_MALFORMED}
    UNION ALL SELECT 'skipped', {R.INGEST_V1} FROM part WHERE {R.IS_NULL_DOC}
    UNION ALL SELECT 'skipped', {R.INGEST_V1} FROM part WHERE {R.IS_ROOT_ARRAY}
    UNION ALL SELECT 'skipped', {R.INGEST_V1} FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t
  ) s GROUP BY ingest_ts, outcome"""
Q["updated_gtins"] = f"SELECT DISTINCT {P['gtin']} AS GTIN FROM part WHERE {R.HAS_V2}"
Q["changes_upsert"] = Q["latest_per_key"]
Q["changes_stream"] = Q["latest_per_key"]
Q["changes_stateful"] = Q["latest_per_key"]

Q["asset_walk"] = with_(["exp_img"], f"""
  SELECT {P['gtin']} AS GTIN, ord, url, filename, media_id FROM exp_img JOIN part ON p_partkey = k
  UNION ALL
  SELECT {P['gtin']}, ord, url, filename, media_id FROM exp_img JOIN part ON p_partkey = k WHERE {R.HAS_V2}""")
Q["image_score"] = with_(["exp_img"], f"""
  SELECT url, CASE WHEN regexp_extract(url, '_([A-Za-z0-9]{{4}})\\.', 1) = '' THEN 'NONE'
                   ELSE upper(regexp_extract(url, '_([A-Za-z0-9]{{4}})\\.', 1)) END AS suffix_code,
         {EXT_SQL_RAW} AS extension, {SUFFIX_SQL} + {EXT_SQL} AS score,
         coalesce({EXT_SQL_RAW} IN ({', '.join(repr(e) for e in EXTENSION_POINTS)}), false) AS is_image
  FROM (SELECT DISTINCT url FROM exp_img) t""")
Q["image_rank"] = with_(["exp_curated"], """
  SELECT GTIN, PrimaryImageUrl, PrimaryImageFileName, PrimaryImageMediaItemId, SecondaryImageUrl
  FROM exp_curated""")

_LV = "L2 AS PRODUCT_HIERARCHY_LEVEL_2, L3 AS PRODUCT_HIERARCHY_LEVEL_3, L4 AS PRODUCT_HIERARCHY_LEVEL_4"
Q["category_exclusions"] = with_(["exp_hier"], f"SELECT GTIN, {_LV} FROM exp_hier WHERE {_excl()}")
Q["hierarchy_dedup"] = with_(["exp_hier_dedup"], f"SELECT GTIN, {_LV} FROM exp_hier_dedup")
Q["recent_sales_lookup"] = with_(["exp_recent"], f"SELECT EAN, {_LV} FROM exp_recent")
Q["prefix_join"] = with_(["exp_sales", "exp_hier"], f"""
  SELECT DISTINCT s.group_id, h.L2 AS PRODUCT_HIERARCHY_LEVEL_2, h.L3 AS PRODUCT_HIERARCHY_LEVEL_3,
         h.L4 AS PRODUCT_HIERARCHY_LEVEL_4
  FROM (SELECT DISTINCT group_id FROM exp_sales) s
  JOIN exp_hier h ON h.L4 LIKE s.group_id || ' - %' WHERE h.L2 IS NOT NULL""")
Q["known_flag"] = with_(["exp_tiers"], "SELECT GTIN, known AS CATEGORY_KNOWN FROM exp_tiers")
Q["tier0_join"] = with_(["exp_latest", "exp_recent_dedup"], f"""
  SELECT c.GTIN, r.L2 AS L2_recent, r.L3 AS L3_recent, r.L4 AS L4_recent
  FROM exp_latest c LEFT JOIN (SELECT * FROM exp_recent_dedup WHERE {_excl()}) r
    ON r.EAN = NULLIF(ltrim(c.GTIN, '0'), '')""")
Q["category_cascade"] = with_(["exp_gold"], """
  SELECT GTIN, Id, GTIN_NO_LEADING_ZEROS, PRODUCT_HIERARCHY_LEVEL_2, PRODUCT_HIERARCHY_LEVEL_3,
         PRODUCT_HIERARCHY_LEVEL_4, CATEGORY_SOURCE FROM exp_gold""")
Q["own_placeholder"] = with_(["exp_gold"], """
  SELECT GTIN, InfoProviderName, known AS CATEGORY_KNOWN, CATEGORY_SOURCE, PRODUCT_HIERARCHY_LEVEL_2
  FROM exp_gold WHERE own""")
Q["coverage_metrics"] = with_(["exp_gold"], f"""
  SELECT rows_written, rows_categorized, rows_via_recent, rows_via_own_placeholder, rows_own_suppressed,
    round(coalesce(100.0 * rows_categorized / NULLIF(rows_written, 0), 0.0), 6) AS pct_categorized
  FROM (SELECT count(*) AS rows_written,
    count(*) FILTER (WHERE (PRODUCT_HIERARCHY_LEVEL_2 IS NOT NULL OR PRODUCT_HIERARCHY_LEVEL_3 IS NOT NULL
      OR PRODUCT_HIERARCHY_LEVEL_4 IS NOT NULL) AND NOT coalesce(CATEGORY_SOURCE = 'own_placeholder', false))
      AS rows_categorized,
    count(*) FILTER (WHERE CATEGORY_SOURCE = 'recent_sales') AS rows_via_recent,
    count(*) FILTER (WHERE CATEGORY_SOURCE = 'own_placeholder') AS rows_via_own_placeholder,
    count(*) FILTER (WHERE own AND CATEGORY_SOURCE IS NULL AND known) AS rows_own_suppressed
  FROM exp_gold) t""")

Q["unit_split"] = with_(["exp_latest"], """
  SELECT CASE WHEN TradeItemUnitDescriptor = 'BASE_UNIT_OR_EACH' THEN 'base' ELSE 'other' END AS unit_class,
         count(*) AS n FROM exp_latest GROUP BY 1""")
Q["case_edges"] = with_(["exp_edges"], "SELECT * FROM exp_edges")
Q["case_pick"] = with_(["exp_pick"], "SELECT * FROM exp_pick")
Q["case_dimensions"] = with_(["exp_casedims"], "SELECT * FROM exp_casedims")
Q["case_idempotent"] = Q["case_dimensions"]
Q["case_metrics"] = with_(["exp_casedims"], """
  SELECT count(*) AS rows_written, count(Case_GTIN) AS rows_with_case_dims FROM exp_casedims""")

Q["publishable"] = with_(["exp_pub"], "SELECT * FROM exp_pub")
Q["publishable_changed"] = with_(["exp_pub"], f"""
  SELECT * FROM exp_pub WHERE GTIN IN (SELECT {P['gtin']} FROM part WHERE {R.HAS_V2})""")
Q["publish_sample"] = with_(["exp_pub"], "SELECT * FROM exp_pub ORDER BY GTIN NULLS LAST LIMIT 25")
Q["publish_manifest"] = with_(["exp_manifest_w"], """
  SELECT gtin, url, base, ext, target, is_winner, metadata_text FROM exp_manifest_w""")
Q["publish_metadata"] = with_(["exp_manifest"], "SELECT gtin, n_fields, metadata_text FROM exp_manifest")
Q["resolve_extension"] = with_(["exp_pub"], f"""
  SELECT gtin, url, content_type, coalesce({_ct_case()},
      CASE {" ".join(f"WHEN ends_with(lower(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')), '{e}') THEN '{e}'" for e in [".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".tif", ".tiff"])} END,
      '.jpg') AS ext
  FROM (SELECT GTIN AS gtin, PrimaryImageUrl AS url, {_content_type_sql().replace('url', 'PrimaryImageUrl')}
        AS content_type FROM exp_pub) t""")
Q["normalise_names"] = f"SELECT k, display, {_NORM} AS normalised FROM (SELECT p_partkey AS k, {_DISPLAY} AS display FROM part) t"
Q["resolve_names"] = f"""
  WITH req AS (SELECT DISTINCT {_DISPLAY} AS display FROM part),
  av AS (SELECT display, min(internal) AS internal FROM (SELECT p_name AS display,
         'col_' || replace(p_name, ' ', '_') AS internal FROM part) t GROUP BY display),
  nav AS (SELECT {_NORM} AS nkey, min(internal) AS internal FROM av GROUP BY 1)
  SELECT r.display AS required, coalesce(a.internal, n.internal) AS internal,
    CASE WHEN a.internal IS NOT NULL THEN 'exact' WHEN n.internal IS NOT NULL THEN 'normalised'
         ELSE 'missing' END AS match
  FROM req r LEFT JOIN av a ON a.display = r.display
  LEFT JOIN nav n ON n.nkey = {_NORM.replace('display', 'r.display')}"""
Q["nearest_names"] = f"""
  WITH av AS (SELECT display, min(internal) AS internal FROM (SELECT p_name AS display,
         'col_' || replace(p_name, ' ', '_') AS internal FROM part) t GROUP BY display),
  offered AS (SELECT display, internal, {_NORM} AS other FROM av),
  req AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN substring(p_name, 1, length(p_name) - 1)
          WHEN 1 THEN upper(p_name) || 'x' ELSE replace(p_name, 'e', 'i') END AS display FROM part),
  missing AS (SELECT r.display AS required, {_NORM.replace('display', 'r.display')} AS key FROM req r
    WHERE NOT EXISTS (SELECT 1 FROM av a WHERE a.display = r.display)
      AND NOT EXISTS (SELECT 1 FROM offered o WHERE o.other = {_NORM.replace('display', 'r.display')})),
  ranked AS (SELECT required, display, internal, levenshtein(key, other) AS distance,
      row_number() OVER (PARTITION BY required ORDER BY levenshtein(key, other), display) AS rank
    FROM missing JOIN offered ON substring(key, 1, 3) = substring(other, 1, 3) AND abs(length(key) - length(other)) <= 2)
  SELECT m.required, r.rank, r.display, r.internal, r.distance FROM missing m
  LEFT JOIN (SELECT * FROM ranked WHERE rank <= 3) r ON r.required = m.required"""
Q["manifest_diff"] = with_(["exp_manifest_w"], f"""
  , cur AS (SELECT target, url, metadata_text AS meta, gtin FROM exp_manifest_w WHERE is_winner),
  prev AS (SELECT target, CASE WHEN CAST(gtin AS BIGINT) % 5 = 0 THEN url || '?v=0' ELSE url END AS url, meta
           FROM cur WHERE CAST(gtin AS BIGINT) % 3 <> 0
           UNION ALL SELECT 'images/' || CAST(p_partkey AS STRING) || '.jpg', 'https://img.example.com/old', ''
           FROM part WHERE NOT ({P['unit']} IS NOT NULL))
  SELECT coalesce(c.target, p.target) AS target,
    CASE WHEN p.url IS NULL AND p.meta IS NULL THEN 'add' WHEN c.url IS NULL AND c.meta IS NULL THEN 'remove'
         WHEN p.url IS NOT DISTINCT FROM c.url AND p.meta IS NOT DISTINCT FROM c.meta THEN 'keep'
         ELSE 'update' END AS action,
    coalesce(c.url, p.url) AS url
  FROM prev p FULL OUTER JOIN cur c ON c.target = p.target""".replace("\n  , cur AS", ", cur AS", 1))
Q["full_manifest_plan"] = with_(["exp_manifest_w"], """
  SELECT target, 'add' AS action, url FROM exp_manifest_w WHERE is_winner AND target IS NOT NULL""")
Q["changes_manifest"] = with_(["exp_manifest_w"], """
  SELECT target, url, gtin, metadata_text AS meta FROM exp_manifest_w WHERE is_winner AND target IS NOT NULL""")
Q["publish_outcomes"] = with_(["exp_manifest_w"], """
  SELECT count(*) AS seen,
    count(*) FILTER (WHERE url LIKE 'http://%' OR url LIKE 'https://%') AS ok,
    count(*) FILTER (WHERE NOT (url LIKE 'http://%' OR url LIKE 'https://%')) AS fail
  FROM exp_manifest_w WHERE is_winner""")

Q["category_names"] = with_(["exp_catnames"], "SELECT * FROM exp_catnames")
Q["category_name_conflicts"] = with_(["exp_catnames"], """
  SELECT count(*) AS n_codes, count(*) FILTER (WHERE DistinctNames LIKE '%|%') AS n_codes_multi_name
  FROM exp_catnames""")
Q["deleted_counts"] = with_(["exp_latest"], "SELECT Deleted, count(*) AS n FROM exp_latest GROUP BY Deleted")
Q["json_isin"] = _silver_rows(f"{R.SILVER_ID_BASE} AS Id, {P['gtin']} AS GTIN",
                              f"p_partkey % 50 = 0 AND {P['gtin_ti']} IS NOT NULL").replace(
    f", {R.INGEST_V1} AS ingest_ts", "").replace(f", {R.INGEST_V2} AS ingest_ts", "")
Q["missing_keys"] = with_(["exp_bronze"], f"""
  SELECT DISTINCT Id FROM ({_SILVER_IDS}) s WHERE Id IS NOT NULL AND Id NOT IN (SELECT Id FROM exp_bronze)""")
Q["run_summary"] = with_(["exp_bronze", "exp_gold", "exp_casedims"], f"""
  SELECT (SELECT count(DISTINCT Id) FROM exp_bronze) AS n_keys,
         (SELECT count(*) FROM ({_SILVER_IDS}) s) AS n_silver,
         (SELECT count(*) FROM exp_gold) AS n_gold,
         (SELECT count(*) FROM exp_gold WHERE CATEGORY_SOURCE IS NOT NULL) AS n_categorised,
         (SELECT count(Case_GTIN) FROM exp_casedims) AS n_with_case_dims""")
