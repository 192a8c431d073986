"""Raw JSON items -> 29-column curated rows; latest version per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import assets
from ..functions.columns import bound, first_truthy, localized_elements, localized_pick, truthy_coalesce
from ..schemas import CURATED_COLUMNS, DOCUMENT_FIELDS, document_ddl

#: The JSON reader's limits (1,000 levels, 20 million characters by default) are lifted.
LIMITS = {"maxNestingDepth": str(2**31 - 1), "maxStringLen": str(2**31 - 1)}
#: Levels that the reader can still write back as text (a field that is read as text but holds more is NULL).
TEXT_DEPTH = 1000
_CORRUPT = {**LIMITS, "columnNameOfCorruptRecord": "_corrupt_record"}

IMAGE_COLUMNS = ["PrimaryImageUrl", "PrimaryImageFileName", "PrimaryImageMediaItemId", "SecondaryImageUrl"]
#: The instants that order the versions of a key, newest first.
VERSION_ORDER = ["StartAvailabilityDateTime", "UpdatedAt", "LastUpdatedDateTime"]
#: Hidden column: 128-bit digest of the document, the last tie-break between versions.
DOC_DIGEST = "_doc_digest"

_DESC = "TradeItem.TradeItemDescriptionModule.TradeItemDescriptionInformation."
_GPC = "TradeItem.GdsnTradeItemClassification."
_MEAS = "TradeItem.TradeItemMeasurementsModule.TradeItemMeasurements."
_NEXT = "TradeItem.NextLowerLevelTradeItemInformation."

# Curated column -> the document fields it is made of, tried in order.
SOURCES: dict[str, list[str]] = {
    "StartAvailabilityDateTime": [
        "TradeItem.DeliveryPurchasingInformationModule.DeliveryPurchasingInformation.StartAvailabilityDateTime"],
    "BrandName": [_DESC + "BrandNameInformation.BrandName"],
    "TradeItemDescription_fi": [_DESC + "TradeItemDescription", _DESC + "DescriptionShort"],
    "GpcCategoryCode": [_GPC + "GpcCategoryCode"],
    "GpcCategoryName": [_GPC + "GpcCategoryName"],
    "GpcSegmentCode": [_GPC + "GpcSegmentCode"],
    "GpcFamilyCode": [_GPC + "GpcFamilyCode"],
    "GpcClassCode": [_GPC + "GpcClassCode"],
    "Depth_mm": [_MEAS + "Depth.Value"],
    "Width_mm": [_MEAS + "Width.Value"],
    "Height_mm": [_MEAS + "Height.Value"],
    "GrossWeight_g": [_MEAS + "TradeItemWeight.GrossWeight.Value"],
    "TradeItemUnitDescriptor": ["TradeItem.TradeItemUnitDescriptorCode.Value"],
    "InfoProviderName": ["TradeItem.InformationProviderOfTradeItem.PartyName", "TradeItem.InformationProvider.Name"],
    "GTIN": ["TradeItem.Gtin", "GTIN"],
    "Id": ["CatalogueItemInfo.Id", "TradeItem.Id", "TradeItem.Gtin", "GTIN"],
    "LastUpdatedDateTime": ["CatalogueItemInfo.LastUpdatedDateTime", "LastUpdatedDateTime",
                            "TradeItem.TradeItemSynchronisationDates.LastChangeDateTime"],
    "Deleted": ["CatalogueItemInfo.Deleted", "Deleted"],
    "IsConsumerUnit": ["TradeItem.IsTradeItemAConsumerUnit"],
    "IsDespatchUnit": ["TradeItem.IsTradeItemADespatchUnit"],
    "IsOrderableUnit": ["TradeItem.IsTradeItemAnOrderableUnit"],
    "IsInvoiceUnit": ["TradeItem.IsTradeItemAnInvoiceUnit"],
    "TotalQuantityOfNextLowerLevelTradeItem": [_NEXT + "TotalQuantityOfNextLowerLevelTradeItem"],
    "ChildTradeItemJson": [_NEXT + "ChildTradeItem"],
}


def parse_fields(raw_json, paths: Iterable[str], corrupt: bool = False) -> Column:
    """One typed parse of the fields at ``paths`` only, beyond the reader's default limits."""
    raw = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    ddl = document_ddl(paths)
    return F.from_json(raw, f"{ddl}, _corrupt_record string" if corrupt else ddl, _CORRUPT if corrupt else LIMITS)


def field(doc: str, path: str) -> Column:
    return F.col(f"{doc}.{path}")


def read_fields(raw_json, paths: list[str], use) -> Column:
    """``use(field, ...)`` of the fields at ``paths``: one parse, wherever the optimizer puts the column."""
    def at(doc, path):
        for name in path.split("."):
            doc = doc[name]
        return doc
    return bound(parse_fields(raw_json, paths), lambda d: use(*[at(d, p) for p in paths]))


def _deleted(raw: Column, doc: str) -> Column:
    """CatalogueItemInfo.Deleted if present (even if not a boolean, which then
    yields NULL), else the root Deleted. Whether it is present is asked of the
    text only for the rare rows where its typed value is NULL but a root one exists."""
    nested, root = (field(doc, p) for p in SOURCES["Deleted"])
    shown = F.from_json(raw, "CatalogueItemInfo struct<Deleted: string>", LIMITS)["CatalogueItemInfo"]["Deleted"]
    return F.coalesce(nested, F.when(root.isNotNull() & shown.isNull(), root))


def _column(name: str, doc: str) -> Column:
    fields = [field(doc, p) for p in SOURCES[name]]
    if name == "Deleted":
        return _deleted(F.col("raw_json"), doc)
    if name == "TradeItemDescription_fi":
        return localized_pick(*[localized_elements(f) for f in fields])
    return truthy_coalesce(*fields) if len(fields) > 1 else fields[0]


def _digest(raw) -> Column:
    """The md5 of a document as 16 bytes, which order as its hexadecimal text does: the rows that carry it are shuffled."""
    return F.unhex(F.md5(raw))


def curate(silver: DataFrame, with_images: bool = True, columns: Iterable[str] | None = None,
           digest: bool = False) -> DataFrame:
    """Silver (Id, raw_json, ingest_ts) -> curated rows (one per non-NULL raw_json).

    ``columns`` names the curated columns that are wanted: only their fields
    are parsed, and documents are walked for images only if an image column is
    among them. Malformed JSON gives an all-NULL row that keeps ``UpdatedAt``.
    ``digest`` adds the document's digest for :func:`latest_per_key`.
    """
    wanted = [c for c in CURATED_COLUMNS if columns is None or c in set(columns)]
    parsed_cols = [c for c in wanted if c in SOURCES]
    src = silver.where(F.col("raw_json").isNotNull()).select("raw_json", "ingest_ts")
    paths = {p for c in parsed_cols for p in SOURCES[c]}
    if paths:
        src = src.withColumn("d", parse_fields("raw_json", paths))
    cols = {c: _column(c, "d") for c in parsed_cols}
    cols["UpdatedAt"] = F.col("ingest_ts")
    images = [c for c in IMAGE_COLUMNS if c in wanted]
    if images and with_images:
        # the walk's output is a column of its own: higher-order functions
        # may not wrap a Python UDF call
        src = src.withColumn("_cands", assets.image_candidates(F.col("raw_json")))
        cols.update(assets.top2(assets.ranked(F.col("_cands"))))
    else:
        cols.update({c: F.lit(None).cast("string") for c in images})
    out = [cols[n].alias(n) for n in wanted]
    if digest:
        out.append(_digest("raw_json").alias(DOC_DIGEST))
    return src.select(*out)


def latest_per_key(curated: DataFrame, key: str = "GTIN", drop_null_keys: bool = False,
                   then: Iterable[str] = ()) -> DataFrame:
    """One row per key: newest StartAvailabilityDateTime, then newest ingest,
    then newest LastUpdatedDateTime, then Id, then the document's digest: equal
    digests are equal documents, so the order is total (D1). A frame without
    digests is ordered by its other columns instead. Rows with a NULL key
    collapse into one row, as the source system does (D7).

    Spark plans this as a partial top-1 per key inside each map task
    (WindowGroupLimit) before the shuffle, so a hot key -- NULL included --
    ships at most one row per map partition. ``drop_null_keys`` drops the
    keyless rows instead of collapsing them. The digest stays, if it came. ``then``
    names columns that decide between rows equal in all else, smallest first.
    """
    if drop_null_keys:
        curated = curated.where(F.col(key).isNotNull())
    rest = ["Id", *([DOC_DIGEST] if DOC_DIGEST in curated.columns else
                    [c for c in curated.columns if c not in (*VERSION_ORDER, key, "Id", *then)]), *then]
    order = [F.col(c).desc_nulls_last() for c in VERSION_ORDER] + [F.col(c).asc_nulls_last() for c in rest]
    w = Window.partitionBy(key).orderBy(*order)
    return curated.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_curated(silver: DataFrame, columns: Iterable[str] | None = None, keep_digest: bool = False) -> DataFrame:
    """Curate and keep the latest version of each key, reading no more of the documents than
    the wanted columns and the version order need."""
    wanted = [c for c in CURATED_COLUMNS if columns is None or c in set(columns)]
    need = {*wanted, "GTIN", "Id", *VERSION_ORDER}
    rows = latest_per_key(curate(silver, columns=need, digest=True))
    return rows.select(*wanted, *([DOC_DIGEST] if keep_digest else []))


SEGMENT_PATHS = [_GPC + "GpcSegmentCode", "GpcSegmentCode"]


def with_segment(silver: DataFrame, name: str = "_segment") -> DataFrame:
    """Adds the nested classification segment, else the root one (truthy fallback): one parse a document."""
    return silver.withColumn(name, read_fields("raw_json", SEGMENT_PATHS, first_truthy))


def segment_filter(silver: DataFrame, wanted: str | None) -> DataFrame:
    """Keep raw items of one classification segment; ``None`` keeps all.
    Missing segment never matches."""
    if wanted is None:
        return silver
    return with_segment(silver).where(F.col("_segment") == F.lit(str(wanted))).select(*silver.columns)


def segment_outcomes(silver: DataFrame, wanted: str | None, batch_col: str) -> DataFrame:
    """Counts of written / skipped items per batch for the segment filter."""
    keep = F.lit(True) if wanted is None else F.coalesce(F.col("_segment") == F.lit(str(wanted)), F.lit(False))
    return (with_segment(silver).select(F.col(batch_col).alias("batch"),
                                        F.when(keep, "written").otherwise("skipped").alias("outcome"))
            .groupBy("batch", "outcome").agg(F.count(F.lit(1)).alias("n")))


def _reason(raw: Column, corrupt: Column) -> Column:
    """Why a document cannot be curated cleanly; ``corrupt`` is the parse's corrupt record."""
    # brackets say how deep a text can be at most; whether it is JSON at all is asked again without a limit only there
    brackets = F.length(raw) - F.length(F.translate(raw, "[{", ""))
    sound = F.from_json(raw, "_any string, _corrupt_record string", _CORRUPT)["_corrupt_record"].isNull()
    is_object = F.substring(F.ltrim(raw), 1, 1) == F.lit("{")
    return (F.when(raw.isNull(), "null_document")
            .when(corrupt.isNull(), F.lit(None))
            .when(is_object & (brackets > TEXT_DEPTH), F.when(sound, "too_deep").otherwise("malformed_json"))
            .when(F.try_parse_json(raw).isNull(), "malformed_json")
            .when(~is_object, "not_an_object")
            .otherwise("type_mismatch"))


def quarantine(silver: DataFrame) -> DataFrame:
    """Rows that cannot be curated cleanly, with a reason (F2, D10).

    ``null_document``: raw_json is NULL; ``too_deep``: a field that is kept as text is nested
    beyond what can be written as text; ``malformed_json``: not JSON at all;
    ``not_an_object``: JSON whose root is not an object; ``type_mismatch``:
    a field had an unexpected type (that field becomes NULL).
    """
    raw = F.col("raw_json")
    src = silver.select("Id", "ingest_ts", "raw_json", parse_fields(raw, DOCUMENT_FIELDS, corrupt=True)["_corrupt_record"]
                        .alias("corrupt"))
    return (src.select("Id", "ingest_ts", _reason(raw, F.col("corrupt")).alias("reason"))
            .where(F.col("reason").isNotNull()))


#: Names of the columns beside the curated ones in :func:`curate_checked`.
SILVER_ID, REASON = "_silver_id", "_reason"


def curate_checked(silver: DataFrame, with_images: bool = True) -> DataFrame:
    """One parse for both outputs (F2): every silver row with all curated columns, its digest, its silver Id and
    the reason that sets it apart, if any. Store it, then read :func:`clean_rows` and :func:`rejected_rows`
    of it: each prunes to the columns that it shows.
    """
    raw = F.col("raw_json")
    src = silver.withColumn("d", parse_fields(raw, DOCUMENT_FIELDS, corrupt=True))
    cols = {c: _column(c, "d") for c in CURATED_COLUMNS if c in SOURCES}
    cols["UpdatedAt"] = F.col("ingest_ts")
    if with_images:
        src = src.withColumn("_cands", assets.image_candidates(raw))
        cols.update(assets.top2(assets.ranked(F.col("_cands"))))
    else:
        cols.update({c: F.lit(None).cast("string") for c in IMAGE_COLUMNS})
    return src.select(*[cols[n].alias(n) for n in CURATED_COLUMNS], _digest(raw).alias(DOC_DIGEST),
                      F.col("Id").alias(SILVER_ID), _reason(raw, F.col("d._corrupt_record")).alias(REASON))


def clean_rows(checked: DataFrame, digest: bool = False) -> DataFrame:
    """The rows of :func:`curate`."""
    return (checked.where(F.coalesce(F.col(REASON) != "null_document", F.lit(True)))
            .select(*CURATED_COLUMNS, *([DOC_DIGEST] if digest else [])))


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The rows of :func:`quarantine`."""
    return (checked.where(F.col(REASON).isNotNull())
            .select(F.col(SILVER_ID).alias("Id"), F.col("UpdatedAt").alias("ingest_ts"), F.col(REASON).alias("reason")))
