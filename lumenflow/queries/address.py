"""Region-document and address-matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenflow.functions import jaro_winkler as JWF
from lumenflow.functions import strings as STR
from lumenflow.functions.strings import join_names as _join
from lumenflow.operators import hierarchy as H
from lumenflow.operators import matching as MT
from lumenflow.plans import address_match as AM
from lumenflow.queries import query
from lumenflow.session import fresh_path, materialize
from lumenflow.sources import bindings as B

# Block rules of the binding: the defaults, plus the two renamed provinces of
# the derived document.
BINDING_RULES = MT.DEFAULT_RULES + (
    MT.BlockRule(("ASIA PACIFIC",), "A", prefix=True),
    MT.BlockRule(("EUROPA",), "EUROPE"),
)


def _document_path(spark, sf_dir):
    path = fresh_path(spark, "region_document")
    B.region_document_lines(spark, sf_dir).write.text(path)
    return path


def _region(spark, sf_dir):
    """The flattened region table, written once (it feeds the exact split,
    the fuzzy part and the merge)."""
    return materialize(H.flatten(H.read_document(spark, _document_path(spark, sf_dir))), "region_flat")


def _master(spark, sf_dir):
    """The address master (a stored table in production), written once."""
    return materialize(B.address_master(spark, sf_dir), "address_master")


@query("hierarchy_flatten")
def q_hierarchy_flatten(spark, sf_dir):
    return _region(spark, sf_dir)


@query("exact_match_split")
def q_exact_match_split(spark, sf_dir):
    mapped, left_only, master_only = MT.exact_split(_region(spark, sf_dir), _master(spark, sf_dir))
    return (mapped.select(F.lit("mapped").alias("side"), "subdistrict_code", MT.MASTER_ID)
            .unionByName(left_only.select(F.lit("left_only").alias("side"), "subdistrict_code",
                                          F.lit(None).cast("bigint").alias(MT.MASTER_ID)))
            .unionByName(master_only.select(F.lit("master_only").alias("side"),
                                            F.lit(None).cast("string").alias("subdistrict_code"),
                                            MT.MASTER_ID)))


@query("block_alias_join")
def q_block_alias_join(spark, sf_dir):
    _, left_only, master_only = MT.exact_split(_region(spark, sf_dir), _master(spark, sf_dir))
    lp = left_only.groupBy("province_name").agg(F.count(F.lit(1)).alias("left_rows"))
    mp = master_only.groupBy("m_province").agg(F.count(F.lit(1)).alias("master_rows"))
    blocks = MT.block_map(lp.select("province_name"), mp.select("m_province"), BINDING_RULES)
    return (blocks.join(lp, "province_name")
            .join(mp.withColumnRenamed("m_province", "block"), "block")
            .select("province_name", "block", "left_rows", "master_rows"))


@query("jaro_winkler_score")
def q_jaro_winkler_score(spark, sf_dir):
    """Each region row scored against the master row of the same customer."""
    region = _region(spark, sf_dir)
    names = MT.master_names(_master(spark, sf_dir))
    a = _join(*MT.LEFT_NAMES)
    b = _join("m_province", "m_city", "m_district", STR.strip_parenthesised("m_subdistrict"))
    owner = (F.substring("subdistrict_code", 7, 64).cast("bigint") + 100000)
    pairs = region.select("subdistrict_code", a.alias("a"), owner.alias(MT.MASTER_ID)) \
        .join(names.select(MT.MASTER_ID, b.alias("b")), MT.MASTER_ID)
    return pairs.select("subdistrict_code", MT.MASTER_ID,
                        JWF.jaro_winkler_udf("a", "b").alias("similarity_score"))


def _fuzzy(spark, sf_dir):
    region = _region(spark, sf_dir)
    master = _master(spark, sf_dir)
    mapped, left_only, master_only = MT.exact_split(region, master)
    return region, master, mapped, MT.fuzzy_best_match(left_only, master_only, BINDING_RULES)


@query("fuzzy_best_match")
def q_fuzzy_best_match(spark, sf_dir):
    return _fuzzy(spark, sf_dir)[3]


@query("address_unmatched")
def q_address_unmatched(spark, sf_dir):
    """Region rows that end without a match: every 50th has no subdistrict name."""
    region = _region(spark, sf_dir)
    hole = F.substring("subdistrict_code", 7, 64).cast("bigint") % 50 == 0
    region = materialize(region.withColumn("subdistrict_name", F.when(~hole, F.col("subdistrict_name"))), "region_holes")
    _, left_only, master_only = MT.exact_split(region, _master(spark, sf_dir))
    return MT.unmatched(left_only, MT.fuzzy_best_match(left_only, master_only, BINDING_RULES, names=True))


@query("region_export")
def q_region_export(spark, sf_dir):
    """The flattened region table exported as CSV, read back as text."""
    out = AM.export_region(spark, _document_path(spark, sf_dir), fresh_path(spark, "region_export"))
    schema = ", ".join(f"{c} string" for c in H.FLAT_COLUMNS)
    return spark.read.option("header", True).schema(schema).csv(out)


@query("address_merge")
def q_address_merge(spark, sf_dir):
    region, master, mapped, fuzzy = _fuzzy(spark, sf_dir)
    return MT.merge_matches(mapped, fuzzy, region, master)


@query("address_match_pipeline")
def q_address_match_pipeline(spark, sf_dir):
    out = fresh_path(spark, "locality_detail")
    AM.run(spark, _document_path(spark, sf_dir), _master(spark, sf_dir), out,
           BINDING_RULES)
    return AM.read_output(spark, out)
