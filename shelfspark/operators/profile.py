"""Category-name profile and data-quality probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import trim_unicode
from .curate import field, parse_fields

CODE_PATH = "TradeItem.GdsnTradeItemClassification.GpcCategoryCode"
NAME_PATH = "TradeItem.GdsnTradeItemClassification.GpcCategoryName"
NORDIC_RX = "[åäöÅÄÖ]"


def category_name_counts(silver: DataFrame) -> DataFrame:
    """(code, name, n), both fields from one small parse; a partial aggregate before the
    shuffle, so a popular code never ships one row per item."""
    src = (silver.select(parse_fields("raw_json", [CODE_PATH, NAME_PATH]).alias("d"))
           .select(field("d", CODE_PATH).alias("GpcCategoryCode"), field("d", NAME_PATH).alias("GpcCategoryName")))
    return (src.where(F.col("GpcCategoryCode").isNotNull())
            .groupBy("GpcCategoryCode", "GpcCategoryName").agg(F.count(F.lit(1)).alias("n")))


def category_names(silver: DataFrame) -> DataFrame:
    """Best name per code: most frequent name containing å/ä/ö if any, else the
    most frequent name; ties go to the longest, then the greatest text.
    Blank names are not candidates; a code with only blank names gets NULL.
    Also the sorted distinct names (blanks kept, NULLs not)."""
    counts = category_name_counts(silver)
    cand = counts.where(F.col("GpcCategoryName").isNotNull()
                        & (trim_unicode("GpcCategoryName") != F.lit("")))
    w = Window.partitionBy("GpcCategoryCode").orderBy(
        F.col("GpcCategoryName").rlike(NORDIC_RX).desc(), F.col("n").desc(),
        F.length("GpcCategoryName").desc(), F.col("GpcCategoryName").desc())
    best = (cand.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("GpcCategoryCode", F.col("GpcCategoryName").alias("SelectedName")))
    names = (counts.groupBy("GpcCategoryCode")
             .agg(F.sort_array(F.collect_list("GpcCategoryName")).alias("DistinctNames")))
    return names.join(best, "GpcCategoryCode", "left").select(
        "GpcCategoryCode", "SelectedName", "DistinctNames")


def category_name_conflicts(silver: DataFrame) -> DataFrame:
    """Number of codes and number of codes with more than one distinct name: only counted, no list is built."""
    per_code = category_name_counts(silver).groupBy("GpcCategoryCode").agg(F.count("GpcCategoryName").alias("names"))
    return per_code.agg(F.count(F.lit(1)).alias("n_codes"), F.count_if(F.col("names") > 1).alias("n_codes_multi_name"))


def deleted_counts(curated: DataFrame) -> DataFrame:
    return curated.groupBy("Deleted").agg(F.count(F.lit(1)).alias("n"))


def json_isin(silver: DataFrame, keys: DataFrame, path: str = "TradeItem.Gtin") -> DataFrame:
    """Raw items whose JSON path value is one of ``keys.GTIN`` (semi join)."""
    df = silver.select("Id", parse_fields("raw_json", [path]).alias("d")).select("Id", field("d", path).alias("GTIN"))
    return df.join(keys.select("GTIN").distinct(), "GTIN", "left_semi")


def missing_keys(silver_ids: DataFrame, bronze: DataFrame) -> DataFrame:
    """Ids present in silver but missing from the key listing."""
    return silver_ids.join(bronze.select("Id"), "Id", "left_anti")
