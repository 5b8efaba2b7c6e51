"""Ladder bounds, NEW override, transition matrix, Diamond rule."""
import pytest
from pyspark.sql import functions as F

from lumenflow.operators import tiering as T

CASES = [  # revenue, revenue tier, real tier
    (None, "Undefined", "Undefined"), (-5, "Undefined", "Undefined"), (0, "Undefined", "Undefined"),
    (1, "Bronze", "Regular"), (9_999_999, "Bronze", "Regular"),
    (10_000_000, "Silver", "Regular"), (24_999_999, "Silver", "Regular"),
    (25_000_000, "Gold", "G/P"), (49_999_999, "Gold", "G/P"),
    (50_000_000, "Platinum", "G/P"), (149_999_999, "Platinum", "G/P"),
    (150_000_000, "Diamond", "G/P"), (10 ** 12, "Diamond", "G/P"),
]


def test_revenue_ladders(spark):
    df = spark.createDataFrame([(r,) for r, _, _ in CASES], "revenue bigint")
    got = df.select("revenue", T.revenue_tier().alias("t"), T.real_pos_tier().alias("r")).collect()
    assert [(x.revenue, x.t, x.r) for x in got] == CASES


@pytest.mark.parametrize("aging,revenue,expected", [
    (0, 200_000_000, "NEW"), (2, None, "NEW"), (3, 1, "Regular"),
    (None, 30_000_000, "G/P"), (None, None, "Undefined")])
def test_new_outlet_beats_revenue(spark, aging, revenue, expected):
    df = spark.createDataFrame([(aging, revenue)], "pos_aging int, revenue bigint")
    assert df.select(T.pos_tier()).first()[0] == expected


def test_transition_matrix(spark):
    tiers = ["G/P", "Regular", "No Trx", "NEW", "Undefined", None]
    rows = [(p, c) for p in tiers for c in tiers]
    df = spark.createDataFrame(rows, "previous_tiering string, pos_tiering string")
    got = {(r[0], r[1]): r[2] for r in df.select("previous_tiering", "pos_tiering", T.transition()).collect()}
    table = {(p, c): label for p, c, label in T.TRANSITIONS}
    for key, value in got.items():
        assert value == table.get(key), key
    assert sum(v is not None for v in got.values()) == 11


def test_diamond_check_counts_distinct_seed_months(spark):
    rows = [  # pos, month, tier
        ("a", "2023-10", "Diamond"), ("a", "2023-11", "Diamond"), ("a", "2023-12", "Diamond"),
        ("a", "2023-12", "Diamond"),                      # same month twice counts once
        ("b", "2023-10", "Diamond"), ("b", "2023-11", "Diamond"), ("b", "2023-12", "Gold"),
        ("c", "2023-09", "Diamond"), ("c", "2023-10", "Diamond"), ("c", "2023-11", "Diamond"),
    ]
    hist = spark.createDataFrame(rows, "pos_code string, month_year string, revenue_tiering string") \
        .withColumn("month_year_date", F.to_date(F.concat("month_year", F.lit("-01"))))
    seed = spark.createDataFrame([("2023-10",), ("2023-11",), ("2023-12",)], "month_year string")
    got = {(r.pos_code, r.quarter_real): (r.quarter_next, r.total_diamond, r.is_diamond)
           for r in T.diamond_check(hist, seed).collect()}
    assert got[("a", "2023-4")] == ("2024-1", 3, "Diamond")
    assert got[("b", "2023-4")] == ("2024-1", 2, "Not Diamond")
    assert got[("c", "2023-4")] == ("2024-1", 2, "Not Diamond")   # September is not a seed month
    assert ("c", "2023-3") not in got


@pytest.mark.parametrize("flag,tier,expected", [
    ("Diamond", "Gold", "Diamond"), ("Not Diamond", "Diamond", "Platinum"),
    (None, "Diamond", "Platinum"), (None, "Silver", "Silver"), ("Not Diamond", None, None)])
def test_promotion(spark, flag, tier, expected):
    df = spark.createDataFrame([(flag, tier)], "is_diamond string, revenue_tiering string")
    assert df.select(T.promoted_tier()).first()[0] == expected
