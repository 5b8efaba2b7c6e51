"""Region document -> flat region table -> matched address table.

    flatten(document)                       one row per subdistrict
    exact_split(region, master)             mapped / region-only / master-only
    fuzzy_best_match(region-only, master-only, rules)
    merge_matches(...)                      19 output columns, score 1 for exact rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenflow.operators import hierarchy as H
from lumenflow.operators import matching as MT
from lumenflow.session import intermediates, materialize
from lumenflow.sources.files import read_delimited

OUTPUT_SCHEMA = (
    "province_code string, province_name string, ISLAND_NAME string, city_code string, "
    "city_name string, TYPE_LABEL string, district_code string, district_name string, "
    "subdistrict_code string, URBAN_ID bigint, subdistrict_name string, POSTAL_CODE string, "
    "CODE_SICEPAT string, IS_COD_SICEPAT string, CODE_JNE_DESTINATION string, CODE_JNE string, "
    "CODE_JNE_ORIGIN string, CODE_TIKI string, similarity_score double")


def match_addresses(region: DataFrame, master: DataFrame,
                    rules: tuple[MT.BlockRule, ...] = MT.DEFAULT_RULES,
                    only_codes: tuple[str, ...] | None = None) -> DataFrame:
    """``only_codes`` restricts the fuzzy part to some subdistrict codes."""
    mapped, left_only, master_only = MT.exact_split(region, master)
    fuzzy = MT.fuzzy_best_match(left_only, master_only, rules, only_codes=only_codes)
    return MT.merge_matches(mapped, fuzzy, region, master)


def read_master(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The address master as a CSV with a header and its declared columns
    (codes keep their leading zeros)."""
    return read_delimited(spark, path, schema=schema)


def export_region(spark: SparkSession, document_path: str, output_path: str, whole_file: bool = False) -> str:
    """The flattened region table alone, as CSV with a header."""
    region = H.flatten(H.read_document(spark, document_path, whole_file))
    region.write.mode("overwrite").option("header", True).csv(output_path)
    return output_path


def run(spark: SparkSession, document_path: str, master: DataFrame, output_path: str,
        rules: tuple[MT.BlockRule, ...] = MT.DEFAULT_RULES, whole_file: bool = False,
        only_codes: tuple[str, ...] | None = None) -> str:
    """Read the document, match, and export the table as CSV with a header.
    The tables written on the way are removed at the end."""
    with intermediates(spark):
        region = materialize(H.flatten(H.read_document(spark, document_path, whole_file)), "region_flat")
        out = match_addresses(region, master, rules, only_codes)
        out.write.mode("overwrite").option("header", True).csv(output_path)
    return output_path


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """The exported table, read with its declared types (codes keep their
    leading zeros)."""
    return spark.read.option("header", True).schema(OUTPUT_SCHEMA).csv(path)
