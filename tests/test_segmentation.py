"""Monthly chain: sequence of months, fan-out, duplicate check, nulls."""
import datetime as dt

from pyspark.sql import functions as F

from lumenflow.functions.dates import previous_quarter_months, quarter_months, shift_label
from lumenflow.plans import segmentation as S


def _raw(spark, rows):
    df = spark.createDataFrame(rows, "month_year string, pos_code string, revenue bigint")
    return df.withColumn("month_year_date", F.to_date(F.concat("month_year", F.lit("-01"))))


def _seed(spark, month):
    return spark.createDataFrame([(m,) for m in previous_quarter_months(month)], "month_year string")


def _run(spark, raw, aging, history, month):
    return S.segment_month(raw, aging, history, _seed(spark, month), month,
                           etl_date=F.lit(None).cast("timestamp"))


def test_month_helpers():
    assert shift_label("2024-01", -1) == "2023-12"
    assert shift_label("2023-12", 1) == "2024-01"
    assert quarter_months("2024-05") == ["2024-04", "2024-05", "2024-06"]
    assert previous_quarter_months("2024-01") == ["2023-10", "2023-11", "2023-12"]


def test_three_month_sequence_no_trx_then_churn_then_back(spark):
    """A lost outlet is carried as No Trx, then Churn, then comes back."""
    aging = spark.createDataFrame([("p1", 10), ("p2", 10)], "pos_code string, pos_aging int")
    history = spark.createDataFrame([], ", ".join(
        f"{c} {t}" for c, t in zip(S.OUTPUT_COLUMNS, ["string", "date", "string", "bigint", "int"]
                                    + ["string"] * 3 + ["string", "string", "bigint", "string",
                                                        "timestamp", "string", "string"])))
    feeds = {
        "2024-01": [("2024-01", "p1", 30_000_000), ("2024-01", "p2", 5_000_000)],
        "2024-02": [("2024-02", "p2", 6_000_000)],
        "2024-03": [("2024-03", "p2", 7_000_000)],
        "2024-04": [("2024-04", "p1", 60_000_000), ("2024-04", "p2", 8_000_000)],
    }
    labels = {}
    for month, rows in feeds.items():
        out = _run(spark, _raw(spark, rows), aging, history, month)
        history = history.unionByName(out.select(*S.OUTPUT_COLUMNS))
        history = spark.createDataFrame(history.collect(), history.schema)  # materialise
        labels[month] = {r.pos_code: (r.pos_tiering, r.tiering_changes) for r in out.collect()}
    assert labels["2024-01"]["p1"] == ("G/P", None)              # first sight
    assert labels["2024-02"]["p1"] == ("No Trx", "No Trx G/P")
    assert labels["2024-03"]["p1"] == ("No Trx", "Churn")
    assert labels["2024-04"]["p1"] == ("G/P", "Back Active to G/P")
    assert labels["2024-02"]["p2"] == ("Regular", "Active Regular")


def test_new_outlet_transitions(spark):
    aging_prev = spark.createDataFrame([("n1", 1)], "pos_code string, pos_aging int")
    hist_rows = [("2024-01", dt.date(2024, 1, 1), "n1", 100, 1, "NEW", "Regular", "Bronze")]
    history = spark.createDataFrame(hist_rows, ", ".join(
        f"{c} {t}" for c, t in zip(S.BASE_COLUMNS, ["string", "date", "string", "bigint", "int",
                                                    "string", "string", "string"])))
    aging = spark.createDataFrame([("n1", 5)], "pos_code string, pos_aging int")
    out = _run(spark, _raw(spark, [("2024-02", "n1", 40_000_000)]), aging, history, "2024-02")
    assert out.first().tiering_changes == "New G/P"
    assert aging_prev.count() == 1


def test_aging_fan_out_is_kept_and_reported(spark):
    """A non-unique aging table multiplies rows; duplicate_check finds them."""
    aging = spark.createDataFrame([("p1", 1), ("p1", 7), ("p2", 9)], "pos_code string, pos_aging int")
    raw = _raw(spark, [("2024-01", "p1", 1), ("2024-01", "p2", 1)])
    calc = S.calculation(raw, aging)
    assert calc.count() == 3
    dup = S.duplicate_check(calc, F.concat("pos_code", "month_year")).collect()
    assert [r.unique_field for r in dup] == ["p12024-01"]


def test_duplicate_check_groups_null_keys(spark):
    df = spark.createDataFrame([(None, "2024-01"), (None, "2024-01"), ("a", None), ("a", None)],
                               "pos_code string, month_year string")
    got = S.duplicate_check(df, F.concat("pos_code", "month_year")).collect()
    assert len(got) == 1 and got[0].unique_field is None


def test_month_filter_stays_above_lag(spark):
    aging = spark.createDataFrame([("p", 10)], "pos_code string, pos_aging int")
    base = _raw(spark, [("2023-12", "p", 30_000_000)])
    history = S.calculation(base, aging)
    out = _run(spark, _raw(spark, [("2024-01", "p", 5_000_000)]), aging, history, "2024-01").first()
    assert (out.previous_tiering, out.previous_revenue, out.tiering_changes) == \
        ("G/P", 30_000_000, "Downgrade to Regular")


def test_run_month_is_idempotent_and_reads_its_own_table(spark, scratch):
    from lumenflow.sinks import storage
    aging = spark.createDataFrame([("p1", 10), ("p2", 10)], "pos_code string, pos_aging int")
    root = scratch("lp")
    first = _run(spark, _raw(spark, [("2024-01", "p1", 30_000_000), ("2024-01", "p2", 1)]),
                 aging, _raw(spark, []).select(*[F.lit(None).cast(t).alias(c) for c, t in zip(
                     S.BASE_COLUMNS, ["string", "date", "string", "bigint", "int", "string", "string", "string"])]).limit(0),
                 "2024-01")
    first.write.partitionBy("month_year").parquet(root)
    feed = _raw(spark, [("2024-02", "p2", 2)])
    assert S.run_month(feed, aging, root, _seed(spark, "2024-02"), "2024-02") == 2
    once = sorted((r.month_year, r.pos_code, r.pos_tiering, r.tiering_changes)
                  for r in storage.read_months(spark, root, S.table_schema()).collect())
    assert S.run_month(feed, aging, root, _seed(spark, "2024-02"), "2024-02") == 2
    twice = sorted((r.month_year, r.pos_code, r.pos_tiering, r.tiering_changes)
                   for r in storage.read_months(spark, root, S.table_schema()).collect())
    assert once == twice
    assert ("2024-02", "p1", "No Trx", "No Trx G/P") in once
