"""Revenue ladders, tier transitions and the Diamond rule.

Every rule is a chain of ``CASE WHEN`` branches (``F.when``) so it stays in
whole-stage codegen; none needs a join or a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.functions.dates import quarter_label

# ---------------------------------------------------------------------------
# These must equal the rules being reproduced.
#
# Revenue ladder bounds (lower bound closed except the first, which is
# "revenue > 0"; upper bound open; the last tier is unbounded):
#   0 < r < 10,000,000            Bronze    Regular
#   10,000,000 <= r < 25,000,000  Silver    Regular
#   25,000,000 <= r < 50,000,000  Gold      G/P
#   50,000,000 <= r < 150,000,000 Platinum  G/P
#   r >= 150,000,000              Diamond   G/P
#   anything else (null, <= 0)    Undefined Undefined
# An outlet younger than 3 months is NEW whatever its revenue.
# Transition labels, (previous tier, current tier) -> label:
#   G/P, G/P -> Active G/P
#   G/P, Regular -> Downgrade to Regular
#   G/P, No Trx -> No Trx G/P
#   NEW, G/P -> New G/P
#   Regular, G/P -> Upgrade to G/P
#   No Trx, G/P -> Back Active to G/P
#   Regular, Regular -> Active Regular
#   Regular, No Trx -> No Trx Regular
#   NEW, Regular -> New Regular
#   No Trx, Regular -> Back Active to Regular
#   No Trx, No Trx -> Churn
#   any other pair -> null
# Diamond flag: more than 2 distinct Diamond months in a quarter.
# ---------------------------------------------------------------------------
LADDER_BOUNDS = (10_000_000, 25_000_000, 50_000_000, 150_000_000)
REVENUE_TIERS = ("Bronze", "Silver", "Gold", "Platinum", "Diamond")
REAL_POS_TIERS = ("Regular", "Regular", "G/P", "G/P", "G/P")
UNDEFINED = "Undefined"
NEW = "NEW"
NO_TRX = "No Trx"
NEW_OUTLET_MONTHS = 3
TRANSITIONS = (
    ("G/P", "G/P", "Active G/P"),
    ("G/P", "Regular", "Downgrade to Regular"),
    ("G/P", "No Trx", "No Trx G/P"),
    ("NEW", "G/P", "New G/P"),
    ("Regular", "G/P", "Upgrade to G/P"),
    ("No Trx", "G/P", "Back Active to G/P"),
    ("Regular", "Regular", "Active Regular"),
    ("Regular", "No Trx", "No Trx Regular"),
    ("NEW", "Regular", "New Regular"),
    ("No Trx", "Regular", "Back Active to Regular"),
    ("No Trx", "No Trx", "Churn"),
)
DIAMOND = "Diamond"
NOT_DIAMOND = "Not Diamond"
DIAMOND_MIN_MONTHS = 3
DEMOTED_TIER = "Platinum"


def _ladder(revenue: Column, labels: tuple[str, ...]) -> Column:
    lo = [None, *LADDER_BOUNDS]
    hi = [*LADDER_BOUNDS, None]
    expr = None
    for low, high, label in zip(lo, hi, labels):
        cond = (revenue > 0) if low is None else (revenue >= low)
        if high is not None:
            cond = cond & (revenue < high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(UNDEFINED)


def revenue_tier(revenue: Column | str = "revenue") -> Column:
    r = F.col(revenue) if isinstance(revenue, str) else revenue
    return _ladder(r, REVENUE_TIERS)


def real_pos_tier(revenue: Column | str = "revenue") -> Column:
    r = F.col(revenue) if isinstance(revenue, str) else revenue
    return _ladder(r, REAL_POS_TIERS)


def pos_tier(revenue: Column | str = "revenue", aging: Column | str = "pos_aging") -> Column:
    """NEW beats revenue; a null age falls through to the revenue ladder."""
    a = F.col(aging) if isinstance(aging, str) else aging
    return F.when(a < NEW_OUTLET_MONTHS, NEW).otherwise(real_pos_tier(revenue))


def transition(previous: Column | str = "previous_tiering",
               current: Column | str = "pos_tiering") -> Column:
    p = F.col(previous) if isinstance(previous, str) else previous
    c = F.col(current) if isinstance(current, str) else current
    expr = None
    for before, after, label in TRANSITIONS:
        cond = (p == before) & (c == after)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(None).cast("string"))


def diamond_flag(total: Column | str = "total_diamond") -> Column:
    t = F.col(total) if isinstance(total, str) else total
    return F.when(t >= DIAMOND_MIN_MONTHS, DIAMOND).otherwise(NOT_DIAMOND)


def promoted_tier(is_diamond: Column | str = "is_diamond",
                  revenue_tiering: Column | str = "revenue_tiering") -> Column:
    flag = F.col(is_diamond) if isinstance(is_diamond, str) else is_diamond
    tier = F.col(revenue_tiering) if isinstance(revenue_tiering, str) else revenue_tiering
    return (F.when(flag == DIAMOND, DIAMOND)
            .when(tier == DIAMOND, DEMOTED_TIER)
            .otherwise(tier))


# --- DataFrame-level operators ---------------------------------------------

def with_revenue_tiers(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "pos_tiering": pos_tier(),
        "real_pos_tiering": real_pos_tier(),
        "revenue_tiering": revenue_tier(),
    })


def diamond_check(history: DataFrame, seed_months: DataFrame,
                  partition_column: str | None = None) -> DataFrame:
    """Distinct Diamond months per outlet and quarter, counted only for
    months listed in the seed; the flag applies to the *next* quarter.

    The seed is applied as a semi join, planned by its measured size.  Its
    first and last month (one row) also bound ``month_year_date``, which the
    Parquet reader gets, and, when the history is partitioned by its month
    label (``partition_column``), the partitions that are listed.
    """
    from lumenflow.functions.dates import month_label, month_start

    first, last = seed_months.agg(F.min("month_year"), F.max("month_year")).first()
    rows = history.where(F.col("revenue_tiering") == DIAMOND)
    if first is not None:
        rows = rows.where((F.col("month_year_date") >= month_start(F.lit(first)))
                          & (F.col("month_year_date") <= F.last_day(month_start(F.lit(last)))))
        if partition_column:
            rows = rows.where(F.col(partition_column).between(first, last))
    rows = (
        rows.withColumn("_month_key", month_label("month_year_date"))
        .join(seed_months.select(F.col("month_year").alias("_month_key")), "_month_key", "left_semi")
    )
    return (
        rows.groupBy(
            "pos_code",
            quarter_label("month_year_date").alias("quarter_real"),
            quarter_label("month_year_date", 1).alias("quarter_next"),
        )
        .agg(F.countDistinct("month_year").alias("total_diamond"))
        .withColumn("is_diamond", diamond_flag())
    )
