"""Monthly outlet (POS) segmentation.

One function per step; each takes and returns DataFrames.  The chain for a
run month ``m`` is::

    calculation(raw, aging)                       tiers of this month's feed
    stage = previous_month_slice(history, m) U calculation
    no_trx = latest row per outlet in stage, when it is not month m
    final = (stage U no_trx) + lag over months + transition label, month m
    promoted = final LEFT JOIN diamond_check(history, seed) on next quarter

Partitioning: every window and join is keyed on ``pos_code`` and every
input holds at most two months per outlet, so each shuffle moves
(outlets x 2) rows; the history scan is reduced to two month partitions
by static filters (the month literals are computed in the driver).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions.dates import month_label, month_start, previous_quarter_months, quarter_label, shift_label
from lumenflow.operators import tiering as T
from lumenflow.session import materialize
from lumenflow.sinks import months as month_table

BASE_COLUMNS = (
    "month_year", "month_year_date", "pos_code", "revenue", "pos_aging",
    "pos_tiering", "real_pos_tiering", "revenue_tiering",
)
LAG_COLUMNS = ("previous_tiering", "previous_real_tiering", "previous_revenue")
OUTPUT_COLUMNS = (
    *BASE_COLUMNS, *LAG_COLUMNS, "tiering_changes", "etl_date", "is_diamond",
    "new_tiering",
)
# Declared types of the stored table; money as the feed gives it.
BASE_SCHEMA = ("month_year string, month_year_date date, pos_code string, revenue {money}, pos_aging int, "
               "pos_tiering string, real_pos_tiering string, revenue_tiering string")
OUTPUT_SCHEMA = BASE_SCHEMA + (", previous_tiering string, previous_real_tiering string, previous_revenue {money}, "
                               "tiering_changes string, etl_date timestamp, is_diamond string, new_tiering string")


def table_schema(money: str = "bigint", base: bool = False) -> str:
    """DDL of the 15 stored columns (``base``: of the first 8)."""
    return (BASE_SCHEMA if base else OUTPUT_SCHEMA).format(money=money)


def _month_order(descending: bool = False) -> list[Column]:
    """Month first; the rest only makes the order total when an outlet has
    several rows in one month (a non-unique aging table multiplies rows)."""
    keys = ["month_year_date", "pos_aging", "pos_tiering", "real_pos_tiering",
            "revenue"]
    if descending:
        return [F.col(k).desc_nulls_last() for k in keys]
    return [F.col(k).asc_nulls_first() for k in keys]


def calculation(raw: DataFrame, aging: DataFrame) -> DataFrame:
    """Feed LEFT JOIN aging (may fan out), then the three tier ladders."""
    joined = raw.join(aging.select("pos_code", "pos_aging"), "pos_code", "left")
    return T.with_revenue_tiers(joined).select(*BASE_COLUMNS)


def previous_month_slice(history: DataFrame, month: str) -> DataFrame:
    prev = shift_label(month, -1)
    return history.where(F.col("month_year") == prev).select(*BASE_COLUMNS)


def union_stage(history: DataFrame, calc: DataFrame, month: str) -> DataFrame:
    return previous_month_slice(history, month).unionByName(calc.select(*BASE_COLUMNS))


def latest_per_pos(stage: DataFrame) -> DataFrame:
    """Newest row per outlet (``row_number() = 1``); Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so only one row per outlet and
    map task is moved."""
    w = Window.partitionBy("pos_code").orderBy(*_month_order(descending=True))
    return (stage.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def no_trx(stage: DataFrame, aging: DataFrame, month: str) -> DataFrame:
    """Outlets whose newest row is not the run month get a 'No Trx' row."""
    latest = latest_per_pos(stage).where(F.col("month_year") != F.lit(month))
    revenue_type = dict(stage.dtypes)["revenue"]
    rows = latest.select(
        F.lit(month).alias("month_year"),
        month_start(F.lit(month)).alias("month_year_date"),
        "pos_code",
        F.lit(0).cast(revenue_type).alias("revenue"),
        F.lit(T.NO_TRX).alias("pos_tiering"),
        F.lit(T.UNDEFINED).alias("real_pos_tiering"),
        F.lit(T.UNDEFINED).alias("revenue_tiering"),
    )
    joined = rows.join(aging.select("pos_code", "pos_aging"), "pos_code", "left")
    return joined.select(*BASE_COLUMNS)


def with_lags(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("pos_code").orderBy(*_month_order())
    return rows.withColumns({
        "previous_tiering": F.lag("pos_tiering", 1).over(w),
        "previous_real_tiering": F.lag("real_pos_tiering", 1).over(w),
        "previous_revenue": F.lag("revenue", 1).over(w),
    })


def with_transitions(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tiering_changes", T.transition())


def final_stage(stage: DataFrame, no_trx_rows: DataFrame, month: str,
                etl_date: Column | None = None) -> DataFrame:
    """Lag over both months first, then keep the run month (the filter must
    stay above the window; Catalyst does not push it below)."""
    unioned = stage.unionByName(no_trx_rows)
    lagged = with_transitions(with_lags(unioned))
    stamped = lagged.withColumn(
        "etl_date", etl_date if etl_date is not None else F.current_timestamp())
    return stamped.where(F.col("month_year") == F.lit(month))


def promote(final: DataFrame, check: DataFrame, month: str) -> DataFrame:
    """LEFT JOIN the Diamond flag of the quarter, then promote or demote."""
    flags = check.select(
        F.col("pos_code").alias("_d_pos"),
        F.col("quarter_next").alias("_d_quarter"),
        "is_diamond",
    )
    joined = final.join(
        flags,
        (final["pos_code"] == flags["_d_pos"])
        & (quarter_label(final["month_year_date"]) == flags["_d_quarter"]),
        "left",
    )
    out = joined.withColumn("new_tiering", T.promoted_tier())
    return out.where(F.col("month_year") == F.lit(month)).select(*OUTPUT_COLUMNS)


def segment_month(raw: DataFrame, aging: DataFrame, history: DataFrame,
                  seed_months: DataFrame, month: str,
                  etl_date: Column | None = None,
                  history_partition: str | None = "month_year") -> DataFrame:
    """The whole monthly step; returns the 15 output columns for ``month``.

    ``history_partition`` names the history's month-label column (the
    partition column of the stored table, equal to the label of
    ``month_year_date``); it lets the Diamond check read only the seed
    months.  Pass None for a history without that invariant."""
    calc = calculation(raw, aging)
    stage = union_stage(history, calc, month)
    final = final_stage(stage, no_trx(stage, aging, month), month, etl_date)
    check = T.diamond_check(history, seed_months, history_partition)
    return promote(final, check, month)


def month_range(first: str, last: str) -> list[str]:
    out = [first]
    while out[-1] < last:
        out.append(shift_label(out[-1], 1))
    return out


def quarter_seeds(spark, months: list[str]) -> DataFrame:
    """(run, month_year): each run month with the months of the quarter before it."""
    return spark.createDataFrame([(m, s) for m in months for s in previous_quarter_months(m)], "run string, month_year string")


def segment_months(feed: DataFrame, aging: DataFrame, history: DataFrame, first: str, last: str,
                   seeds: DataFrame | None = None, etl_date: Column | None = None) -> DataFrame:
    """The 15 output columns of the months ``first`` to ``last`` in one plan: what running
    ``segment_month`` for each in turn, on the table with the months before it, would give.
    ``history`` is the table before ``first``; ``seeds(run, month_year)`` the seed months
    of each run (the quarter before it).

    An outlet that was once seen has rows in every later month, as a month without a feed
    is carried as 'No Trx', which the next run sees as its previous month.  So the calendar
    of each outlet is made dense from its first month on (at most one entry a month in a
    group), and one ``lag`` over all months finds the same rows as the runs' two-month
    windows.  The flags of all runs come from one aggregate over the seed months' Diamond
    rows, those of the history and those of the months computed here.
    """
    spark = feed.sparkSession
    months = month_range(first, last)
    before = shift_label(first, -1)
    seeds = quarter_seeds(spark, months) if seeds is None else seeds
    calc = calculation(feed.where(F.col("month_year").between(first, last)), aging)
    calc = materialize(calc, "backfill_feed")           # the tiers, the calendar and the flags read it
    previous = history.where(F.col("month_year") == before).select(*BASE_COLUMNS)

    # months of each outlet, counted from the one before the first
    start = month_start(F.lit(before))
    nth = F.months_between("month_year_date", start).cast("int").alias("nth")
    seen = calc.select("pos_code", nth).unionByName(previous.select("pos_code", F.lit(0).alias("nth")))
    gaps = (seen.groupBy("pos_code").agg(F.min("nth").alias("since"), F.collect_set("nth").alias("held"))
            .select("pos_code", F.explode(F.array_except(F.sequence("since", F.lit(len(months))), "held")).alias("nth"))
            .where("nth > 0"))
    date = F.add_months(start, F.col("nth"))
    carried = gaps.select(
        month_label(date).alias("month_year"), date.alias("month_year_date"), "pos_code",
        F.lit(0).cast(dict(calc.dtypes)["revenue"]).alias("revenue"), F.lit(T.NO_TRX).alias("pos_tiering"),
        F.lit(T.UNDEFINED).alias("real_pos_tiering"), F.lit(T.UNDEFINED).alias("revenue_tiering"))
    carried = carried.join(aging.select("pos_code", "pos_aging"), "pos_code", "left").select(*BASE_COLUMNS)

    rows = with_transitions(with_lags(previous.unionByName(calc).unionByName(carried)))
    rows = rows.withColumn("etl_date", etl_date if etl_date is not None else F.current_timestamp())
    rows = rows.where(F.col("month_year").between(first, last))

    earliest = seeds.agg(F.min("month_year")).first()[0]
    peaks = history.where((F.col("revenue_tiering") == T.DIAMOND) & (F.col("month_year") < first) & (F.col("month_year") >= earliest))
    peaks = peaks.select("pos_code", "month_year", "month_year_date").unionByName(
        calc.where(F.col("revenue_tiering") == T.DIAMOND).select("pos_code", "month_year", "month_year_date"))
    # a run sees the months before it only
    flags = (peaks.join(seeds, "month_year").where(F.col("month_year") < F.col("run"))
             .groupBy(F.col("run").alias("_d_run"), F.col("pos_code").alias("_d_pos"),
                      quarter_label("month_year_date", 1).alias("_d_quarter"))
             .agg(F.countDistinct("month_year").alias("total_diamond"))
             .withColumn("is_diamond", T.diamond_flag()).drop("total_diamond"))
    joined = rows.join(flags, (rows["month_year"] == flags["_d_run"]) & (rows["pos_code"] == flags["_d_pos"])
                       & (quarter_label(rows["month_year_date"]) == flags["_d_quarter"]), "left")
    return joined.withColumn("new_tiering", T.promoted_tier()).select(*OUTPUT_COLUMNS)


def duplicate_check(df: DataFrame, key: Column) -> DataFrame:
    """Values of ``key`` seen more than once (null is a value here)."""
    return (df.groupBy(key.alias("unique_field")).count()
            .where(F.col("count") > 1).select("unique_field"))


def run_month(feed: DataFrame, aging: DataFrame, table_root: str,
              seed_months: DataFrame, month: str) -> int:
    """One monthly run against the stored, month-partitioned table.

    Reads the history from the table itself (only the previous month and
    the seed months are scanned, by partition filters), computes ``month``
    and replaces that month's partition with the result (an empty result
    removes it).  Re-running a month gives the same table.  Returns the
    number of rows written.  A table that doesn't exist yet is empty.
    """
    from lumenflow.sinks import storage

    spark = feed.sparkSession
    table = storage.read_months(spark, table_root, table_schema(dict(feed.dtypes)["revenue"]))
    result = segment_month(feed, aging, table, seed_months, month)
    return storage.replace_month(result, table_root, month, OUTPUT_COLUMNS)


def output_audits() -> dict[str, month_table.Audit]:
    """What a month must fulfil to be published: one row per outlet and month, a
    key in each, and tiers of the ladders."""
    tiers = (*T.REVENUE_TIERS, T.UNDEFINED)
    return {"one row per outlet and month": month_table.unique(F.struct("pos_code", "month_year")),
            "month and date": month_table.not_null("month_year", "month_year_date"),
            "revenue tiers": month_table.accepted_values("revenue_tiering", tiers)}


def publish_months(feed: DataFrame, aging: DataFrame, table_root: str, first: str, last: str | None = None,
                   seeds: DataFrame | None = None, audits: dict[str, month_table.Audit] | None = None) -> dict[str, int]:
    """Run the months ``first`` to ``last`` (one month by default) against a published
    table (``sinks.months``): all are staged, audited and published by one switch, or none
    is.  Returns the rows of each month."""
    last = last or first
    table = month_table.read(feed.sparkSession, table_root, table_schema(dict(feed.dtypes)["revenue"]))
    result = segment_months(feed, aging, table, first, last, seeds)
    return month_table.publish(result, table_root, month_range(first, last), output_audits() if audits is None else audits)
