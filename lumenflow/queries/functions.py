"""Scalar-function queries over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenflow.functions import dates as D
from lumenflow.functions import strings as STR
from lumenflow.queries import query
from lumenflow.sources.tables import read_table

@query("fn_concat_key")
def q_fn_concat_key(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return li.select("l_orderkey", "l_linenumber",
                     STR.concat_key("l_suppkey", D.month_label("l_shipdate")).alias("pos_month_key"),
                     STR.concat_key(flag, "l_linestatus").alias("flag_status_key"))


@query("fn_month_start")
def q_fn_month_start(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    label = D.month_label("l_shipdate")
    return li.select("l_orderkey", "l_linenumber", label.alias("month_year"),
                     D.month_start(label).alias("month_year_date"))


@query("fn_month_label")
def q_fn_month_label(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", D.month_label("o_orderdate").alias("month_year"))


@query("fn_month_shift")
def q_fn_month_shift(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", D.month_shift(d, -1).alias("month_before"),
                    D.month_shift(d, 3).alias("quarter_after"),
                    D.month_label(D.month_shift(D.month_start(D.month_label(d)), -1)).alias("previous_month"))


@query("fn_quarter_label")
def q_fn_quarter_label(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", D.quarter_label(d).alias("quarter_real"),
                    D.quarter_label(d, 1).alias("quarter_next"))


@query("fn_clean_name")
def q_fn_clean_name(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    raw = F.when(F.col("p_size") <= 48,
                 F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") "), "p_type"))
    return p.select("p_partkey", STR.clean_name(raw).alias("clean_name"))


@query("name_prefix_ilike")
def q_name_prefix_ilike(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    STR.prefix_ilike("c_mktsegment", "auto_").alias("auto_prefixed"),
                    STR.prefix_ilike("c_mktsegment", "ho_se").alias("house_prefixed"),
                    STR.prefix_ilike("c_name", "customer#").alias("name_prefixed"))
