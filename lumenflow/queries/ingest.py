"""Upsert and bulk-load queries (binding: customer balance bands, events)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lumenflow.plans import ingest
from lumenflow.queries import query
from lumenflow.session import fresh_path
from lumenflow.sources import bindings as B
from lumenflow.sources.files import read_delimited
from lumenflow.sources.tables import table_path


def _write_staging_csv(spark, sf_dir, rows=B.upsert_staging):
    path = fresh_path(spark, "staging") + "/customers.csv"
    (rows(spark, sf_dir)
     .write.option("header", True).option("sep", ";").csv(path))
    return path


@query("csv_scan_delimited")
def q_csv_scan_delimited(spark, sf_dir):
    path = fresh_path(spark, "delimited") + "/customer.csv"
    (spark.read.parquet(table_path(sf_dir, "customer"))
     .write.option("header", True).option("sep", ";").csv(path))
    return read_delimited(spark, path, sep=";")


UPSERT_BUCKETS = 16


@query("upsert_existing")
def q_upsert_existing(spark, sf_dir):
    """Target stored by key bucket with a ``double`` key, staging read from a
    CSV whose key is an ``int``; only the touched buckets are rewritten."""
    root = fresh_path(spark, "upsert_target")
    target = B.upsert_target(spark, sf_dir).withColumn("c_custkey", F.col("c_custkey").cast("double"))
    ingest.upsert_bucketed(spark, target, root, "c_custkey", UPSERT_BUCKETS)
    staging = ingest.stage(spark, _write_staging_csv(spark, sf_dir))
    ingest.upsert_bucketed(spark, staging, root)
    return ingest.read_bucketed(spark, root).drop(ingest.ETL_COLUMN)


@query("upsert_merge_on_read")
def q_upsert_merge_on_read(spark, sf_dir):
    """The same upsert by deletion vectors: the target's rows stay where they are."""
    root = fresh_path(spark, "upsert_positions")
    target = B.upsert_target(spark, sf_dir).withColumn("c_custkey", F.col("c_custkey").cast("double"))
    ingest.upsert_by_positions(spark, target, root, "c_custkey", UPSERT_BUCKETS)
    ingest.upsert_by_positions(spark, ingest.stage(spark, _write_staging_csv(spark, sf_dir)), root)
    return ingest.read_bucketed(spark, root).drop(ingest.ETL_COLUMN)


@query("upsert_concurrent")
def q_upsert_concurrent(spark, sf_dir):
    """The staging rows in two upserts at the same time, odd keys and the others."""
    root = fresh_path(spark, "upsert_raced")
    target = B.upsert_target(spark, sf_dir).withColumn("c_custkey", F.col("c_custkey").cast("double"))
    ingest.upsert_bucketed(spark, target, root, "c_custkey", UPSERT_BUCKETS)
    staging = ingest.stage(spark, _write_staging_csv(spark, sf_dir))
    odd = F.coalesce(F.col("c_custkey") % 2 == 1, F.lit(False))
    with ThreadPoolExecutor(2) as pool:
        upserts = [pool.submit(ingest.upsert_bucketed, spark, staging.where(odd), root),
                   pool.submit(ingest.upsert_by_positions, spark, staging.where(~odd), root)]
        for done in upserts:
            done.result()
    return ingest.read_bucketed(spark, root).drop(ingest.ETL_COLUMN)


@query("upsert_first_load")
def q_upsert_first_load(spark, sf_dir):
    """No target yet: the whole customer table is staged and becomes it."""
    root = fresh_path(spark, "upsert_new")
    staging = ingest.stage(spark, _write_staging_csv(spark, sf_dir, B.upsert_first_staging))
    ingest.upsert_bucketed(spark, staging, root)
    return ingest.read_bucketed(spark, root).drop(ingest.ETL_COLUMN)


# --- bulk loads -----------------------------------------------------------------

@query("bulk_load_parquet")
def q_bulk_load_parquet(spark, sf_dir):
    target, _ = ingest.bulk_load(spark, table_path(sf_dir, "events"),
                                 fresh_path(spark, "load_parquet"))
    return spark.read.parquet(target)


CSV_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("bulk_load_csv")
def q_bulk_load_csv(spark, sf_dir):
    """A CSV with a declared schema: one pass over the source."""
    src = fresh_path(spark, "source") + "/events.csv"
    (spark.read.parquet(table_path(sf_dir, "events"))
     .write.option("header", True).option("timestampFormat", CSV_TIME_FORMAT)
     .option("timestampNTZFormat", CSV_TIME_FORMAT).csv(src))
    target, _ = ingest.bulk_load(spark, src, fresh_path(spark, "load_csv"), schema=EVENTS_SCHEMA)
    return spark.read.parquet(target)


@query("bulk_load_stats")
def q_bulk_load_stats(spark, sf_dir):
    """Rows and parts of a load, measured on the written files."""
    target, rows = ingest.bulk_load(spark, table_path(sf_dir, "lineitem"), fresh_path(spark, "load_stats"))
    return ingest.load_statistics(spark, target).agg(
        F.sum("rows").alias("rows"), (F.min("rows") > 0).alias("no_empty_part"),
        (F.sum("rows") == F.lit(rows)).alias("as_reported"))
