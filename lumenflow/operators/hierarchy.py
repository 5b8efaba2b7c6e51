"""Flatten a four-level region document into one row per subdistrict.

The document holds four maps (``provinsi``: code -> name; ``kabupaten``,
``kecamatan``, ``kelurahan``: parent code -> {code -> name}, where a parent
code is the concatenation of its ancestors' codes).  It may come as one
whole document or as JSON lines that each hold a fragment of the maps.

Every level is exploded and the levels are chained with inner equi-joins on
the parent code, so an entry whose parent is missing disappears with its
whole subtree.  The large level (subdistricts) is joined last, against the
small joined upper levels, which AQE broadcasts when they measure small.
A key repeated inside one map keeps its last value, as a JSON object decoded
into a dictionary does: entries are exploded with their position and the
last one of a (document, parent, code) stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The level names of the document.
LEVELS = ("provinsi", "kabupaten", "kecamatan", "kelurahan")
DOC_SCHEMA = ("provinsi map<string,string>, kabupaten map<string,map<string,string>>, "
              "kecamatan map<string,map<string,string>>, kelurahan map<string,map<string,string>>")
FLAT_COLUMNS = ("province_code", "province_name", "city_code", "city_name",
                "district_code", "district_name", "subdistrict_code", "subdistrict_name")


DOC_ID = "_doc"


def _documents(parsed: DataFrame) -> DataFrame:
    """The four maps of each document; repeated keys are told apart by document."""
    return parsed.select(F.monotonically_increasing_id().alias(DOC_ID), *LEVELS)


def read_document(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """JSON lines (one fragment per line) or whole files (one document each:
    a single JSON value is one row, its entries are dealt out once exploded)."""
    if whole_file:
        text = spark.read.text(path, wholetext=True)
        return _documents(text.select(F.from_json("value", DOC_SCHEMA).alias("d")).select("d.*"))
    return _documents(spark.read.schema(DOC_SCHEMA).json(path))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Document fragments given as a ``value`` text column."""
    return _documents(lines.select(F.from_json("value", DOC_SCHEMA).alias("d")).select("d.*"))


def _entries(doc: DataFrame, level: str, key: list[str], value: str) -> DataFrame:
    """Entries of a map column; of a repeated key the last one."""
    rows = doc.select(DOC_ID, *key, F.posexplode(level).alias("_at", "code", value))
    return rows.groupBy(DOC_ID, *key, "code").agg(F.max_by(value, "_at").alias(value))


def _children(doc: DataFrame, level: str) -> DataFrame:
    outer = _entries(doc, level, [], "children").withColumnRenamed("code", "parent")
    return _entries(outer, "children", ["parent"], "name").select("parent", "code", "name")


def flatten(doc: DataFrame) -> DataFrame:
    prov = _entries(doc, "provinsi", [], "province_name").select(F.col("code").alias("province_code"), "province_name")
    cities = _children(doc, "kabupaten").select(
        F.col("parent").alias("province_code"),
        F.concat("parent", "code").alias("city_code"), F.col("name").alias("city_name"))
    districts = _children(doc, "kecamatan").select(
        F.col("parent").alias("city_code"),
        F.concat("parent", "code").alias("district_code"), F.col("name").alias("district_name"))
    subs = _children(doc, "kelurahan").select(
        F.col("parent").alias("district_code"),
        F.concat("parent", "code").alias("subdistrict_code"), F.col("name").alias("subdistrict_name"))
    upper = prov.join(cities, "province_code").join(districts, "city_code")
    return subs.join(upper, "district_code").select(*FLAT_COLUMNS)
