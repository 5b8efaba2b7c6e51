"""Several months in one plan, and months that are audited before they are published."""
import random

import pytest
from pyspark.sql import functions as F

from lumenflow.functions.dates import previous_quarter_months
from lumenflow.plans import segmentation as S
from lumenflow.sinks import months, storage

AGES = "pos_code string, pos_aging int"


def _feed(spark, rows):
    df = spark.createDataFrame(rows, "month_year string, pos_code string, revenue bigint")
    return df.withColumn("month_year_date", F.to_date(F.concat("month_year", F.lit("-01"))))


def _seed(spark, month):
    return spark.createDataFrame([(m,) for m in previous_quarter_months(month)], "month_year string")


def _rows(df):
    return sorted((tuple(r) for r in df.drop("etl_date").collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_backfill_equals_the_months_in_turn(spark, seed):
    rng = random.Random(seed)
    labels = S.month_range("2023-07", "2024-08")
    codes = [None, *(f"p{i}" for i in range(12))]
    rows = [(m, c, 200_000_000 if c == "p7" else rng.choice([0, -5, 9_000_000, 30_000_000, 160_000_000])) for m in labels for c in codes
            if c == "p7" or rng.random() < (0.3 if c in ("p1", "p2", None) else 0.85) and not (c == "p3" and m < "2024-03")]
    feed = _feed(spark, rows).cache()
    # one outlet without an age, one with two, and ages of a new one
    aging = spark.createDataFrame([(f"p{i}", i) for i in range(1, 12)] + [("p5", 1)], AGES).cache()
    first, last = "2023-12", "2024-08"
    history = S.calculation(feed.where(F.col("month_year") < first), aging)
    schema = S.table_schema()
    table = spark.createDataFrame([], schema).unionByName(history, allowMissingColumns=True)
    got = _rows(S.segment_months(feed, aging, table, first, last, etl_date=F.lit(None).cast("timestamp")))
    want = []
    for m in S.month_range(first, last):
        out = S.segment_month(feed.where(F.col("month_year") == m), aging, table, _seed(spark, m), m, F.lit(None).cast("timestamp"))
        kept = out.collect()
        want += [tuple(r) for r in out.drop("etl_date").collect()]
        table = spark.createDataFrame(table.collect() + kept, schema)
    assert got == sorted(want, key=repr)
    assert any("Churn" in map(str, r) for r in got) and any(r[1 + 1] == "p7" and "Diamond" in map(str, r[-2:]) for r in got)


def test_backfill_of_nothing(spark):
    empty = _feed(spark, [])
    history = spark.createDataFrame([], S.table_schema())
    assert S.segment_months(empty, spark.createDataFrame([], AGES), history, "2024-01", "2024-03").collect() == []


def test_a_failing_audit_leaves_the_old_month(spark, scratch):
    root = scratch("published")
    feed = _feed(spark, [(m, p, 30_000_000) for m in ("2024-01", "2024-02") for p in ("p1", "p2")])
    ages = spark.createDataFrame([("p1", 10), ("p2", 10)], AGES)
    assert S.publish_months(feed, ages, root, "2024-01", "2024-02") == {"2024-01": 2, "2024-02": 2}
    before = _rows(months.read(spark, root, S.table_schema()))
    twice = ages.unionByName(spark.createDataFrame([("p1", 11)], AGES))
    with pytest.raises(months.AuditError) as failed:
        S.publish_months(feed, twice, root, "2024-02")
    assert failed.value.broken == {"one row per outlet and month": 1}
    assert spark.read.parquet(failed.value.staged).count() == 3      # the staged rows can be looked at: p1 has two
    assert _rows(months.read(spark, root, S.table_schema())) == before
    assert S.publish_months(feed.where("pos_code = 'p2'"), ages, root, "2024-02") == {"2024-02": 2}
    now = _rows(months.read(spark, root, S.table_schema(), ["2024-02"]))
    assert {r[1 + 1]: r[5] for r in now} == {"p1": "No Trx", "p2": "G/P"}
    assert len(months.vacuum(spark, root)) == 1                        # the refused write; the first still holds a month
    assert len(_rows(months.read(spark, root, S.table_schema()))) == 4


def test_a_failed_write_and_an_emptied_month(spark, scratch):
    root = scratch("published")
    schema = "month_year string, n int"
    rows = spark.createDataFrame([("2024-01", 1), ("2024-02", 2), ("2024-03", 9)], schema)
    assert months.publish(rows, root, ["2024-01", "2024-02"]) == {"2024-01": 1, "2024-02": 1}
    bad = rows.withColumn("n", F.expr("if(n = 2, raise_error('stopped'), n)"))
    with pytest.raises(Exception, match="stopped"):
        months.publish(bad, root, ["2024-01", "2024-02"])
    assert sorted(tuple(r) for r in months.read(spark, root, schema).collect()) == [("2024-01", 1), ("2024-02", 2)]
    assert months.publish(rows.limit(0), root, ["2024-01"]) == {"2024-01": 0}
    assert [tuple(r) for r in months.read(spark, root, schema).collect()] == [("2024-02", 2)]
    assert months.read(spark, scratch("none"), schema).collect() == []


def test_writers_of_different_months_both_get_in(spark, scratch, monkeypatch):
    root, schema = scratch("published"), "month_year string, n int"
    one = lambda m, n: spark.createDataFrame([(m, n)], schema)       # noqa: E731
    months.publish(one("2024-01", 1), root, ["2024-01"])
    real, waiting = months._commit, [("2024-03", 3), None]

    def late(spark_, root_, after, held):
        other = waiting.pop(0) if waiting else None
        if other:
            months.publish(one(*other), root, [other[0]])
        return real(spark_, root_, after, held)

    monkeypatch.setattr(months, "_commit", late)
    months.publish(one("2024-02", 2), root, ["2024-02"])
    assert sorted(tuple(r) for r in months.read(spark, root, schema).collect()) == [("2024-01", 1), ("2024-02", 2), ("2024-03", 3)]
    waiting[:] = [("2024-02", 7), None]                               # the same month this time
    with pytest.raises(storage.ConflictError):
        months.publish(one("2024-02", 5), root, ["2024-02"])
    assert [r["n"] for r in months.read(spark, root, schema, ["2024-02"]).collect()] == [7]


def test_audits(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y")], "k string, v string")
    assert months.unique(F.col("k"))(df).count() == 1
    assert months.not_null("k", "v")(df).count() == 2
    assert months.accepted_values("v", ["x"])(df).collect()[0]["v"] == "y"
