"""Outlet segmentation queries (binding: outlet = supplier and part group, run 2000-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenflow.functions.dates import shift_label
from lumenflow.functions.strings import concat_key
from lumenflow.operators import tiering as T
from lumenflow.plans import segmentation as S
from lumenflow.queries import query
from lumenflow.session import fresh_path, materialize
from lumenflow.sinks import months as MT
from lumenflow.sinks import storage
from lumenflow.sources import bindings as B
from lumenflow.sources.files import read_seed

M = B.RUN_MONTH
PREVIOUS = shift_label(M, -1)


def _inputs(spark, sf_dir):
    """Feed, ages and history of the run.  In production these are stored
    tables; here they are derived, so the aggregated feed and the history,
    partitioned by month, are written once to the shared folder instead of
    being re-derived from lineitem by every branch of the plan."""
    sales = materialize(B.pos_sales(spark, sf_dir))
    aging = B.pos_aging(spark, sf_dir)
    root = fresh_path(spark, "history")
    B.segmentation_history(spark, sf_dir, M, sales, aging).write.partitionBy("month_year").parquet(root)
    return sales, aging, storage.read_months(spark, root, S.table_schema(base=True))


def _seed(spark):
    """The month seed, as the CSV file that it is."""
    path = fresh_path(spark, "seeds") + "/filter_month.csv"
    B.seed_months(spark, M).write.option("header", True).csv(path)
    return read_seed(spark, path)


def _stage(spark, sf_dir):
    sales, aging, history = _inputs(spark, sf_dir)
    calc = S.calculation(B.month_feed(sales, M), aging)
    return S.union_stage(history, calc, M), aging, history


@query("revenue_tiering")
def q_revenue_tiering(spark, sf_dir):
    sales = B.pos_sales(spark, sf_dir)
    return sales.select("pos_code", "month_year", "revenue",
                        T.revenue_tier().alias("revenue_tiering"))


@query("real_pos_tiering")
def q_real_pos_tiering(spark, sf_dir):
    sales = B.pos_sales(spark, sf_dir)
    return sales.select("pos_code", "month_year", "revenue",
                        T.real_pos_tier().alias("real_pos_tiering"))


@query("pos_tiering")
def q_pos_tiering(spark, sf_dir):
    return S.calculation(B.pos_sales(spark, sf_dir), B.pos_aging(spark, sf_dir))


@query("previous_month_slice")
def q_previous_month_slice(spark, sf_dir):
    _, _, history = _inputs(spark, sf_dir)
    return S.previous_month_slice(history, M)


@query("pos_union_stage")
def q_pos_union_stage(spark, sf_dir):
    stage, _, _ = _stage(spark, sf_dir)
    return stage


@query("latest_per_pos")
def q_latest_per_pos(spark, sf_dir):
    stage, _, _ = _stage(spark, sf_dir)
    return S.latest_per_pos(stage).select("pos_code", "month_year", "revenue", "pos_tiering")


@query("no_trx_pos")
def q_no_trx_pos(spark, sf_dir):
    stage, aging, _ = _stage(spark, sf_dir)
    return S.no_trx(stage, aging, M)


@query("pos_lag")
def q_pos_lag(spark, sf_dir):
    stage, aging, _ = _stage(spark, sf_dir)
    return S.with_lags(stage.unionByName(S.no_trx(stage, aging, M)))


@query("tiering_transition")
def q_tiering_transition(spark, sf_dir):
    stage, aging, _ = _stage(spark, sf_dir)
    lagged = S.with_lags(stage.unionByName(S.no_trx(stage, aging, M)))
    return lagged.select("pos_code", "month_year", "previous_tiering", "pos_tiering",
                         T.transition().alias("tiering_changes"))


@query("seed_month_filter")
def q_seed_month_filter(spark, sf_dir):
    from lumenflow.functions.dates import month_label
    _, _, history = _inputs(spark, sf_dir)
    keyed = history.withColumn("_m", month_label("month_year_date"))
    return keyed.join(_seed(spark).withColumnRenamed("month_year", "_m"), "_m", "left_semi").drop("_m")


@query("diamond_check")
def q_diamond_check(spark, sf_dir):
    _, _, history = _inputs(spark, sf_dir)
    return T.diamond_check(history, _seed(spark), "month_year")


@query("diamond_promotion")
def q_diamond_promotion(spark, sf_dir):
    """Promotion rule over every month of the history: each outlet-month is
    joined to the flag earned in the quarter before it."""
    from lumenflow.functions.dates import quarter_label
    _, _, history = _inputs(spark, sf_dir)
    check = T.diamond_check(history, _seed(spark), "month_year")
    flags = check.select(F.col("pos_code").alias("_p"), F.col("quarter_next").alias("_q"),
                         "is_diamond")
    joined = history.join(flags, (history["pos_code"] == flags["_p"])
                          & (quarter_label(history["month_year_date"]) == flags["_q"]), "left")
    return joined.select("pos_code", "month_year", "revenue_tiering", "is_diamond",
                         T.promoted_tier().alias("new_tiering"))


@query("pos_final")
def q_pos_final(spark, sf_dir):
    stage, aging, _ = _stage(spark, sf_dir)
    final = S.final_stage(stage, S.no_trx(stage, aging, M), M)
    return final.drop("etl_date")


def _segment(spark, sf_dir):
    sales, aging, history = _inputs(spark, sf_dir)
    return S.segment_month(B.month_feed(sales, M), aging, history,
                           _seed(spark), M)


@query("pos_segmentation_month")
def q_pos_segmentation_month(spark, sf_dir):
    return _segment(spark, sf_dir).drop("etl_date")


@query("duplicate_check")
def q_duplicate_check(spark, sf_dir):
    stage, aging, _ = _stage(spark, sf_dir)
    final = S.final_stage(stage, S.no_trx(stage, aging, M), M)
    return S.duplicate_check(final, concat_key("pos_code", "month_year"))


OLDEST_MONTH = "1995-01"   # month deleted by an empty replacement in the demo write


@query("month_partition_replace")
def q_month_partition_replace(spark, sf_dir):
    """History written month-partitioned; the run month is computed *from
    that table* and written back into it; one old month is replaced by an
    empty result (and so disappears)."""
    root = fresh_path(spark, "lp_segmentation")
    sales = materialize(B.pos_sales(spark, sf_dir))
    aging = B.pos_aging(spark, sf_dir)
    (B.segmentation_history_full(spark, sf_dir, M, sales, aging)
     .write.partitionBy("month_year").parquet(root))
    S.run_month(B.month_feed(sales, M), aging, root, _seed(spark), M)
    table = storage.read_months(spark, root, S.table_schema())
    storage.replace_month(table.where(F.lit(False)), root, OLDEST_MONTH, S.OUTPUT_COLUMNS)
    return storage.read_months(spark, root, S.table_schema()).drop("etl_date")


BACKFILL_FROM = "1999-11"   # months to the run month, over a quarter's end


@query("pos_segmentation_backfill")
def q_pos_segmentation_backfill(spark, sf_dir):
    """Six run months in one plan, on a table that ends before the first of them."""
    sales = materialize(B.pos_sales(spark, sf_dir))
    aging = B.pos_aging(spark, sf_dir)
    history = S.calculation(sales.where(F.col("month_year") < BACKFILL_FROM), aging)
    return S.segment_months(sales, aging, history, BACKFILL_FROM, M).drop("etl_date")


@query("month_write_audit_publish")
def q_month_write_audit_publish(spark, sf_dir):
    """A published table.  The run month is refused while outlets have two age records (its
    audit finds the repeated rows) and the table stays as it was; with one record each, two
    months are published by one switch."""
    root = fresh_path(spark, "published")
    sales = materialize(B.pos_sales(spark, sf_dir))
    aging = B.pos_aging(spark, sf_dir)
    one_record = aging.groupBy("pos_code").agg(F.min("pos_aging").alias("pos_aging"))
    past = S.calculation(sales.where(F.col("month_year") < PREVIOUS), one_record)
    empty = spark.createDataFrame([], S.table_schema())
    past = empty.unionByName(past, allowMissingColumns=True)
    MT.publish(past, root, [r["month_year"] for r in past.select("month_year").distinct().collect()])
    try:
        S.publish_months(sales, aging, root, PREVIOUS, M)
    except MT.AuditError:
        pass
    S.publish_months(sales, one_record, root, PREVIOUS, M)
    return MT.read(spark, root, S.table_schema()).drop("etl_date")
