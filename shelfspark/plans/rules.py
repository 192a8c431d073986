"""Deterministic fixture rules: how catalogue inputs are derived from the
driver's TPC-H-like tables.

Each rule is a scalar SQL expression written in the subset that both Spark
SQL and DuckDB accept (CASE, %, ||, lpad, CAST ... AS STRING), so the Spark
fixture builder and the independent SQL oracle derive identical inputs.
The oracle never parses the JSON we generate: it computes the expected
curated values directly from these flat rules.
"""

from __future__ import annotations

from ..functions.columns import EXTENSION_POINTS, SUFFIX_POINTS

K = "p_partkey"


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def pick(index_expr: str, values: list[str]) -> str:
    """Portable ``values[index_expr]``."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {index_expr} {arms} END)"


# Suffix codes used by the fixture: every scored code plus one lower-case one.
SUFFIX_SLOTS = list(SUFFIX_POINTS) + ["c1n1"]
EXT_SLOTS = list(EXTENSION_POINTS) + ["bmp"]

GTIN = f"lpad({s(K)}, 14, '0')"
START = (f"CASE WHEN {K} % 53 = 0 THEN NULL ELSE '2020-' || lpad({s(f'{K} % 12 + 1')}, 2, '0') "
         f"|| '-' || lpad({s(f'{K} % 28 + 1')}, 2, '0') || 'T00:00:00' END")
# some addresses hold characters and parameters that strict URL readers refuse
U1 = (f"CASE WHEN {K} % 59 = 0 THEN 'https://img.example.com/p/a b[' || {s(K)} || ']_C1C1.png;v=2' "
      f"ELSE 'https://img.example.com/p/' || {s(K)} || '_' || {pick(f'{K} % 16', SUFFIX_SLOTS)} "
      f"|| '.' || {pick(f'{K} % 8', EXT_SLOTS)} END")
U2 = (f"'https://img.example.com/q/' || {s(K)} || CASE WHEN {K} % 8 = 2 THEN '' ELSE '_' || "
      f"{pick(f'({K} * 7) % 16', SUFFIX_SLOTS)} END || '.' || {pick(f'({K} * 3) % 8', EXT_SLOTS)} "
      f"|| CASE WHEN {K} % 8 = 6 THEN '?x=1' ELSE '' END")
U3 = (f"CASE WHEN {K} % 12 = 3 THEN {U1} ELSE 'https://img.example.com/m/' || {s(K)} || '_' || "
      f"{pick(f'({K} * 5) % 16', SUFFIX_SLOTS)} || '.png' END")

PART = {
    "k": K,
    "gtin": GTIN,
    "gtin_ti": f"CASE WHEN {K} % 31 = 0 THEN NULL ELSE {GTIN} END",
    "gtin_root": f"CASE WHEN {K} % 31 = 0 THEN {GTIN} END",
    "ci_id": f"CASE WHEN {K} % 13 = 0 THEN NULL WHEN {K} % 29 = 0 THEN '' ELSE 'B' || {s(K)} END",
    "ti_id": f"CASE WHEN {K} % 26 = 0 THEN 'T' || {s(K)} END",
    "start": START,
    "start_v2": (f"CASE WHEN {K} % 12 = 0 THEN '2021-01-01T00:00:00' "
                 f"WHEN {K} % 24 = 18 THEN '2019-06-01T00:00:00' ELSE {START} END"),
    "brand": "p_brand",
    "brand_v2": "p_brand || ' v2'",
    "party": (f"CASE WHEN {K} % 14 = 0 THEN NULL WHEN {K} % 7 = 0 THEN '  own oy ' "
              f"WHEN {K} % 47 = 0 THEN '' ELSE p_brand || ' Ltd' END"),
    "ip_name": f"CASE WHEN {K} % 14 = 0 THEN 'Own Oy' WHEN {K} % 47 = 0 THEN 'Fallback Provider' END",
    "ci_lu": (f"CASE WHEN {K} % 9 = 0 THEN NULL ELSE '2024-02-' || lpad({s(f'{K} % 28 + 1')}, 2, '0') "
              f"|| 'T10:00:00Z' END"),
    "root_lu": (f"CASE WHEN {K} % 9 = 0 AND {K} % 27 <> 0 THEN '2024-01-' || "
                f"lpad({s(f'{K} % 28 + 1')}, 2, '0') || 'T08:00:00Z' END"),
    "ti_lu": f"'2023-12-' || lpad({s(f'{K} % 28 + 1')}, 2, '0') || 'T00:00:00Z'",
    "desc_mode": (f"CASE WHEN {K} % 11 = 0 THEN 'empty' WHEN {K} % 17 = 0 THEN 'fi_null' "
                  f"WHEN {K} % 3 = 0 THEN 'fi_second' WHEN {K} % 5 = 0 THEN 'fi_blank' ELSE 'first' END"),
    "cat_code": "p_type",
    "cat_name": (f"CASE WHEN {K} % 37 = 0 THEN '' WHEN {K} % 10 = 0 THEN p_name || ' ä' "
                 f"ELSE p_name END"),
    "seg": f"CASE WHEN {K} % 23 = 0 THEN NULL WHEN p_size <= 40 THEN '50000000' ELSE '60000000' END",
    "root_seg": f"CASE WHEN {K} % 46 = 0 THEN '60000000' WHEN {K} % 23 = 0 THEN '50000000' END",
    "family": f"CASE WHEN {K} % 41 = 0 THEN NULL ELSE 'F' || {s('p_size % 7')} END",
    "class": f"'C' || {s('p_size')}",
    "unit": f"CASE WHEN {K} % 43 = 0 THEN NULL ELSE 'BASE_UNIT_OR_EACH' END",
    "has_meas": f"({K} % 19 <> 0)",
    "depth": s("p_size"),
    "width": s("p_size * 2"),
    "height": s("p_size + 3"),
    "weight": s(f"{K} % 500 + 50"),
    "n_img": f"{K} % 4",
    "u1": U1,
    "f1": f"{s(K)} || '_front.' || {pick(f'{K} % 8', EXT_SLOTS)}",
    "m1": f"'M' || {s(K)}",
    "u2": U2,
    "f2": f"'side_' || {s(K)} || '.png'",
    "m2": s(f"{K} + 7000"),
    "u3": U3,
    "f3": f"'asset_' || {s(K)}",
    "u4": f"'https://example.org/spec/' || {s(K)}",
}

# Expected curated values for a base (part) document, straight from the rules.
P = PART
EXPECTED_BASE = {
    "TradeItemDescription_fi": (
        f"CASE WHEN {K} % 11 = 0 THEN 'lyhyt ' || p_name WHEN {K} % 17 = 0 THEN 'kort ' || p_name "
        f"WHEN {K} % 3 = 0 THEN 'fi ' || p_name WHEN {K} % 5 = 0 THEN NULL ELSE p_name END"),
    "GpcCategoryCode": P["cat_code"],
    "GpcCategoryName": P["cat_name"],
    "GpcSegmentCode": P["seg"],
    "GpcFamilyCode": P["family"],
    "GpcClassCode": P["class"],
    "Depth_mm": f"CASE WHEN {P['has_meas']} THEN {P['depth']} END",
    "Width_mm": f"CASE WHEN {P['has_meas']} THEN {P['width']} END",
    "Height_mm": f"CASE WHEN {P['has_meas']} THEN {P['height']} END",
    "GrossWeight_g": f"CASE WHEN {P['has_meas']} THEN {P['weight']} END",
    "TradeItemUnitDescriptor": P["unit"],
    "InfoProviderName": f"coalesce(NULLIF({P['party']}, ''), {P['ip_name']})",
    "GTIN": GTIN,
    "Id": (f"CASE WHEN {K} % 13 <> 0 AND {K} % 29 <> 0 THEN 'B' || {s(K)} "
           f"WHEN {K} % 26 = 0 THEN 'T' || {s(K)} ELSE {GTIN} END"),
    "LastUpdatedDateTime": (f"CASE WHEN {K} % 9 <> 0 THEN {P['ci_lu']} "
                            f"WHEN {K} % 27 <> 0 THEN {P['root_lu']} ELSE {P['ti_lu']} END"),
    "Deleted": f"CASE {K} % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END",
    "IsConsumerUnit": f"CASE {K} % 4 WHEN 0 THEN true WHEN 1 THEN false END",
    "IsDespatchUnit": f"({K} % 6 = 0)",
    "IsOrderableUnit": f"CASE WHEN {K} % 3 = 0 THEN true END",
    "IsInvoiceUnit": f"({K} % 2 = 0)",
}

# Silver ids (no root-GTIN fallback, D12).
SILVER_ID_BASE = (f"CASE WHEN {K} % 13 <> 0 AND {K} % 29 <> 0 THEN 'B' || {s(K)} "
                  f"WHEN {K} % 26 = 0 THEN 'T' || {s(K)} ELSE {P['gtin_ti']} END")

INGEST_V1 = "'2024-03-01T00:00:00'"
INGEST_V2 = "'2024-03-02T00:00:00'"
HAS_V2 = f"({K} % 6 = 0)"
IS_MALFORMED = f"({K} % 97 = 0)"
IS_NULL_DOC = f"({K} % 101 = 0)"
IS_ROOT_ARRAY = f"({K} % 89 = 0)"

# Case (packaging) documents: one per (l_orderkey, l_linenumber).
O, LN = "l_orderkey", "l_linenumber"
CASE_DOC = {
    "gtin": f"'9' || lpad({s(O)}, 9, '0') || lpad({s(LN)}, 4, '0')",
    "ci_id": f"'C' || {s(O)} || '-' || {s(LN)}",
    "unit": f"CASE WHEN {O} % 29 = 0 THEN 'PALLET' ELSE 'CASE' END",
    "despatch": f"({O} % 5 <> 0)",
    "depth": f"CASE WHEN {O} % 23 = 0 THEN NULL ELSE {s(f'100 + {O} % 50')} END",
    "width": s(f"200 + {LN}"),
    "height": "'300'",
    "weight": s(f"1000 + {O} % 700"),
    "start": "'2019-01-01T00:00:00'",
    "ci_lu": "'2024-01-15T00:00:00Z'",
    # total quantity: absent / decimal text / JSON number
    "total_mode": f"CASE WHEN {O} % 17 = 0 THEN 'absent' WHEN {O} % 19 = 0 THEN 'text' ELSE 'number' END",
}

# Retail hierarchy (one row per part, a second row for some, none for some).
HIER = {
    "present": f"({K} % 9 <> 4)",
    "dup": f"({K} % 8 = 0)",
    "key": f"CASE WHEN {K} % 2 = 0 THEN {s(K)} ELSE {GTIN} END",
    "l2": (f"CASE WHEN {K} % 61 = 0 THEN NULL ELSE {s('10 + p_size % 10')} || ' - Dept ' "
           f"|| {s('p_size % 10')} END"),
    "l3": f"CASE WHEN {K} % 15 = 0 THEN NULL ELSE {s('100 + p_size')} || ' - Size ' || {s('p_size')} END",
    "l4": (f"{s(f'1000 + p_size * 10 + {K} % 3')} || ' - Line ' || {s(f'{K} % 3')} || ' - ' "
           f"|| {s('p_size')}"),
    # the duplicate row of a key sorts after the real one only sometimes
    "l2_dup": f"CASE WHEN {K} % 16 = 0 THEN '09 - Archive' ELSE '19 - Other' END",
    "l3_dup": "'190 - Other'",
    "l4_dup": f"{s(f'1000 + p_size * 10 + {K} % 3')} || ' - Old line'",
}

# Sales group id of a part: the id part of its level-4 text.
# For some parts the id itself holds ' - ', as ids may.
SALES_GROUP = (f"CASE WHEN {K} % 7 = 0 THEN {s(f'1000 + p_size * 10 + {K} % 3')} || ' - Line ' || {s(f'{K} % 3')} "
               f"ELSE {s(f'1000 + p_size * 10 + {K} % 3')} END")

# Exclusion rules (level_2, level_3 or NULL for the whole level 2).
EXCLUSION_RULES = [
    ("13 - Dept 3", None),
    ("17 - Dept 7", None),
    ("19 - Other", None),
    ("12 - Dept 2", "102 - Size 2"),
    ("12 - Dept 2", "112 - Size 12"),
]

OWN_PROVIDER = "Own Oy"
PLACEHOLDER = "99 - Unclassified (own product)"
AS_OF = "2001-08-01"
RUN_START = "2024-03-02T00:00:00"
SINCE = "2024-01-15T00:00:00"
SEGMENT = "50000000"

# Key feed from events.
EV = "event_id"
EVENTS = {
    "id": (f"CASE WHEN {EV} % 50 = 7 THEN '' WHEN {EV} % 50 = 13 THEN NULL "
           f"ELSE 'B' || {s(f'CAST(floor({EV} / 2) AS BIGINT)')} END"),
    "page": f"CAST(floor({EV} / 90) AS BIGINT)",
}
