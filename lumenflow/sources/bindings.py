"""Inputs of the pipelines, derived by Spark from the driver tables.

The pipelines were written for tables that are not part of the test data
(outlet revenue, outlet age, change envelopes, a region document, an
address master, a CSV to upsert).  Each binding below derives such an input
from the star-schema tables so that its size grows with them.  The SQL
oracle derives the same inputs independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenflow.functions.dates import month_label, month_start, previous_quarter_months, shift_label
from lumenflow.sources.tables import read_table

# Binding parameters (fixed, shared with the SQL oracle).
RUN_MONTH = "2000-04"
REVENUE_SCALE = 900           # outlet revenue = line value x 900
OUTLET_SLOTS = 16             # a supplier has (key mod 16) + 1 outlets
AGING_MONTHS = 24             # outlet age in months = (supplier key + outlet) mod 24
REBOOKED_ACCTBAL = 9500.0     # suppliers above this balance hold a second age record


# --- outlet segmentation ---------------------------------------------------

def _slots(suppkey: str):
    """Outlets that a supplier's parts are dealt to: 1 to 16, so that some
    outlets sell every month and others rarely."""
    return F.col(suppkey) % OUTLET_SLOTS + 1


def pos_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet = supplier and part group, month = ship month, all lines.

    One partial + final aggregate over lineitem; money is summed as
    decimal so the result does not depend on summation order.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice")
    outlet = F.concat_ws("-", F.col("l_suppkey").cast("string"),
                         (F.col("l_partkey") % _slots("l_suppkey")).cast("string"))
    agg = (
        li.groupBy(outlet.alias("pos_code"), month_label("l_shipdate").alias("month_year"))
        .agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")) * REVENUE_SCALE)
             .cast("bigint").alias("revenue"))
    )
    return agg.select("month_year", month_start("month_year").alias("month_year_date"),
                      "pos_code", "revenue")


def pos_aging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet age records.  Outlets of suppliers with a negative balance have
    none (left-join misses); those of rich ones have two (the table is not
    unique)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    booked = s.where(F.col("s_acctbal") >= 0).withColumn(
        "slot", F.explode(F.sequence(F.lit(0).cast("bigint"), (_slots("s_suppkey") - 1).cast("bigint"))))
    code = F.concat_ws("-", F.col("s_suppkey").cast("string"), F.col("slot").cast("string"))
    age = (F.col("s_suppkey") + F.col("slot")) % AGING_MONTHS
    first = booked.select(code.alias("pos_code"), age.cast("int").alias("pos_aging"))
    second = booked.where(F.col("s_acctbal") > REBOOKED_ACCTBAL).select(
        code.alias("pos_code"), (age + 1).cast("int").alias("pos_aging"))
    return first.unionByName(second)


def seed_months(spark: SparkSession, month: str = RUN_MONTH) -> DataFrame:
    """The month filter seed: the months of the quarter before ``month``."""
    rows = [(m,) for m in previous_quarter_months(month)]
    return spark.createDataFrame(rows, "month_year string")


def month_feed(sales: DataFrame, month: str) -> DataFrame:
    return sales.where(F.col("month_year") == F.lit(month))


def segmentation_history(spark: SparkSession, sf_dir: str, month: str = RUN_MONTH,
                         sales: DataFrame | None = None, aging: DataFrame | None = None,
                         full: bool = False) -> DataFrame:
    """The monthly table as it stands before ``month`` is run.

    Months before the previous one hold the plain tiers of their feed; the
    previous month is produced by running the monthly step itself, so it
    carries 'No Trx' rows as a real table would.  ``full`` gives all 15
    columns (earlier months have no lag, flag or stamp), otherwise the 8
    base columns.
    """
    from lumenflow.plans import segmentation as S

    sales = sales if sales is not None else pos_sales(spark, sf_dir)
    aging = aging if aging is not None else pos_aging(spark, sf_dir)
    prev = shift_label(month, -1)
    base = S.calculation(sales.where(F.col("month_year") < F.lit(prev)), aging)
    prev_rows = S.segment_month(month_feed(sales, prev), aging, base,
                                seed_months(spark, prev), prev,
                                etl_date=F.lit(None).cast("timestamp"))
    if full:
        return base.unionByName(prev_rows, allowMissingColumns=True).select(*S.OUTPUT_COLUMNS)
    return base.unionByName(prev_rows.select(*S.BASE_COLUMNS))


def segmentation_history_full(spark: SparkSession, sf_dir: str, month: str = RUN_MONTH,
                              sales: DataFrame | None = None,
                              aging: DataFrame | None = None) -> DataFrame:
    return segmentation_history(spark, sf_dir, month, sales, aging, full=True)


# --- change data capture ---------------------------------------------------

CDC_TOPIC = "shop.inventory.customers"
CDC_ROW_SCHEMA = "struct<id:bigint,event_type:string,value:double>"
CDC_KEY = "id"
CDC_BATCH_KEYS = 100
CDC_SEGMENT = 25_000            # offsets of a folder of the topic log


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change envelope per event, shaped like a Kafka record.

    offset = event id, partition = user mod 2, key = user, op from the event
    type (signup c; purchase, click u; view r; error d).  Timestamps run
    backwards within every seven messages and partition 1 lags a day behind.
    The ``k`` value in ``props`` marks odd messages: 0 not JSON, 1 ``after``
    null, 2 ``after`` missing, 3 ``payload`` null, 4 white space before the
    JSON, 5 ``payload`` given twice (the first one stale), 6 a field the row
    schema lacks and a value of another type.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    op = (F.when(F.col("event_type") == "signup", "c")
          .when(F.col("event_type").isin("purchase", "click"), "u")
          .when(F.col("event_type") == "view", "r")
          .when(F.col("event_type") == "error", "d"))
    after = F.struct(F.col("user_id").alias("id"), "event_type", "value")
    full = F.to_json(F.struct(F.struct(op.alias("op"), after.alias("after")).alias("payload")))
    odd = F.to_json(F.struct(F.struct(op.alias("op"), F.struct(
        F.col("user_id").alias("id"), "event_type", F.lit("n/a").alias("value"),
        F.lit("x").alias("note")).alias("after")).alias("payload")))
    text = (F.when(k == 0, F.lit("not json"))
            .when(k == 1, F.format_string('{"payload":{"op":"%s","after":null}}', op))
            .when(k == 2, F.format_string('{"payload":{"op":"%s"}}', op))
            .when(k == 3, F.lit('{"payload":null}'))
            .when(k == 4, F.concat(F.lit("\n\t "), full))
            .when(k == 5, F.concat(F.lit('{"payload":{"op":"d"},'), F.substring(full, 2, 1 << 30)))
            .when(k == 6, odd)
            .otherwise(full))
    partition = (F.col("user_id") % 2).cast("int")
    back = F.make_interval(days=partition, hours=F.pmod("event_id", F.lit(7)).cast("int"))
    return ev.select(
        F.encode(text, "UTF-8").alias("value"),
        F.lit(CDC_TOPIC).alias("topic"),
        partition.alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        (F.col("ts").cast("timestamp") - back).alias("timestamp"),
    )


# --- upsert and loads --------------------------------------------------------

UPSERT_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
TARGET_MAX_ACCTBAL = 5000.0     # target holds customers below this balance
STAGING_MIN_ACCTBAL = 2500.0    # staging holds customers from this balance (overlap 2500-5000)
STAGING_REPEAT_ACCTBAL = 9900.0  # above: the staging row appears twice
STAGING_NOKEY_ACCTBAL = 9850.0   # above (and up to the repeat bound): key missing


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select(*UPSERT_COLUMNS)
    return c.where(F.col("c_acctbal") < TARGET_MAX_ACCTBAL)


def upsert_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New balances for richer customers; some keys twice, some missing."""
    c = read_table(spark, sf_dir, "customer").select(*UPSERT_COLUMNS)
    return _staged(c.where(F.col("c_acctbal") >= STAGING_MIN_ACCTBAL))


def upsert_first_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every customer."""
    return _staged(read_table(spark, sf_dir, "customer").select(*UPSERT_COLUMNS))


def _staged(rows: DataFrame) -> DataFrame:
    bal = F.col("c_acctbal")
    key = F.when((bal > STAGING_NOKEY_ACCTBAL) & (bal <= STAGING_REPEAT_ACCTBAL),
                 F.lit(None)).otherwise(F.col("c_custkey"))
    first = rows.select(key.alias("c_custkey"), "c_name", "c_nationkey",
                        (bal + 1).alias("c_acctbal"), "c_mktsegment")
    again = rows.where(bal > STAGING_REPEAT_ACCTBAL).select(
        "c_custkey", "c_name", "c_nationkey", (bal + 2).alias("c_acctbal"), "c_mktsegment")
    return first.unionByName(again)


# --- region document and address master -------------------------------------------

# Document province names that differ from the master's, and the block rules
# that map them back (an equality rename and a prefix rule).
DOC_PROVINCE_NAMES = {2: "ASIA PACIFIC", 3: "EUROPA"}
DROPPED_LEVEL2_REGION = 4          # its city map is missing: the whole region vanishes
CHILDREN_PER_RECORD = 1000         # document fragments hold at most this many children


def _code(c, width: int):
    return F.format_string(f"%0{width}d", c)


def region_document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four-level region document as JSON lines.

    Levels: province = region, city = nation, district = market segment of
    the nation's customers, subdistrict = customer.  Codes are zero-padded
    text (2, 2, 2, 6 digits) and a child map is keyed by the concatenated
    codes of its ancestors.  Each line holds one fragment
    ``{"<level>": {...}}`` with at most ``CHILDREN_PER_RECORD`` children, so
    no single record grows with the data.
    """
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    rename = F.col("r_name")
    for key, name in DOC_PROVINCE_NAMES.items():
        rename = F.when(F.col("r_regionkey") == key, F.lit(name)).otherwise(rename)

    prov = region.select(_code("r_regionkey", 2).alias("code"), F.upper(rename).alias("name"))
    cities = (nation.where(F.col("n_regionkey") != DROPPED_LEVEL2_REGION)
              .select(_code("n_regionkey", 2).alias("parent"), _code("n_nationkey", 2).alias("code"),
                      F.upper("n_name").alias("name")))
    seg = (customer.join(nation.select("n_nationkey", "n_regionkey"),
                         customer["c_nationkey"] == nation["n_nationkey"])
           .groupBy("n_regionkey", "n_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("_n")))
    seg = seg.withColumn("_d", F.dense_rank().over(
        Window.partitionBy("n_regionkey", "n_nationkey").orderBy("c_mktsegment")))
    districts = seg.select(
        F.concat(_code("n_regionkey", 2), _code("n_nationkey", 2)).alias("parent"),
        _code("_d", 2).alias("code"), F.upper("c_mktsegment").alias("name"))
    subs = (customer.join(nation.select("n_nationkey", "n_regionkey"),
                          customer["c_nationkey"] == nation["n_nationkey"])
            .join(seg.select("n_nationkey", "c_mktsegment", "_d"), ["n_nationkey", "c_mktsegment"])
            .select(F.concat(_code("n_regionkey", 2), _code("n_nationkey", 2), _code("_d", 2)).alias("parent"),
                    _code("c_custkey", 6).alias("code"), F.upper("c_name").alias("name"),
                    (F.col("c_custkey") / CHILDREN_PER_RECORD).cast("long").alias("_chunk")))

    def fragments(df, level, nested):
        if not nested:
            grouped = df.groupBy((F.col("code").cast("long") / CHILDREN_PER_RECORD).cast("long"))
            body = F.map_from_entries(F.collect_list(F.struct("code", "name")))
            return grouped.agg(F.to_json(F.create_map(F.lit(level), body)).alias("value")).select("value")
        chunk = F.col("_chunk") if "_chunk" in df.columns else F.lit(0)
        grouped = df.groupBy("parent", chunk.alias("_c"))
        body = F.create_map(F.col("parent"), F.map_from_entries(F.collect_list(F.struct("code", "name"))))
        return grouped.agg(F.to_json(F.create_map(F.lit(level), body)).alias("value")).select("value")

    return (fragments(prov, "provinsi", False)
            .unionByName(fragments(cities, "kabupaten", True))
            .unionByName(fragments(districts, "kecamatan", True))
            .unionByName(fragments(subs, "kelurahan", True)))


MASTER_ABSENT_BELOW = 0.0          # customers with a negative balance are not in the master
MASTER_NO_HASH_BELOW = 1000.0      # balances in [0, 1000): name written without '#'
MASTER_NO_ID_EVERY = 97            # customers with such a key have no id
MASTER_SAME_ID_EVERY = 89          # ... and these the id before theirs
MASTER_OLD_ABOVE = 9000.0          # balances above: name suffixed ' (Old)'


def address_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address master: one row per customer with a non-negative
    balance, names in mixed case, some spelled differently, and carried
    attributes derived from the keys.  Some rows have no id, some the id of
    the customer before them."""
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    rows = (c.where(F.col("c_acctbal") >= MASTER_ABSENT_BELOW)
            .join(nation, c["c_nationkey"] == nation["n_nationkey"])
            .join(region, nation["n_regionkey"] == region["r_regionkey"]))
    bal = F.col("c_acctbal")
    urban = (F.when(bal < MASTER_NO_HASH_BELOW, F.regexp_replace("c_name", "#", ""))
             .when(bal > MASTER_OLD_ABOVE, F.concat("c_name", F.lit(" (Old)")))
             .otherwise(F.col("c_name")))
    key = F.col("c_custkey")
    return rows.select(
        F.when(key % MASTER_NO_ID_EVERY == 0, F.lit(None)).otherwise(
            key + 100000 - (key % MASTER_SAME_ID_EVERY == 0).cast("int")).alias("URBAN_ID"),
        F.col("r_name").alias("PROVINCE_NAME"),
        F.initcap("n_name").alias("DISTRICT_NAME"),
        F.col("c_mktsegment").alias("SUBDISTRICT_NAME"),
        urban.alias("URBAN_NAME"),
        F.concat(F.lit("ISLAND "), F.col("r_regionkey").cast("string")).alias("ISLAND_NAME"),
        F.when(F.col("c_nationkey") % 2 == 0, "KOTA").otherwise("KABUPATEN").alias("TYPE_LABEL"),
        F.format_string("%05d", (key * 7) % 100000).alias("POSTAL_CODE"),
        F.concat(F.lit("SC"), key.cast("string")).alias("CODE_SICEPAT"),
        F.when(bal > 5000, "YES").otherwise("NO").alias("IS_COD_SICEPAT"),
        F.concat(F.lit("D"), F.col("c_nationkey").cast("string"), F.lit("-"), key.cast("string")).alias("CODE_JNE_DESTINATION"),
        F.concat(F.lit("J"), key.cast("string")).alias("CODE_JNE"),
        F.concat(F.lit("O"), F.col("c_nationkey").cast("string")).alias("CODE_JNE_ORIGIN"),
        F.concat(F.lit("T"), key.cast("string")).alias("CODE_TIKI"),
    )
