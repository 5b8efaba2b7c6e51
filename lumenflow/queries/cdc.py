"""Change-data-capture queries (binding: one envelope per event)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenflow.operators import cdc
from lumenflow.queries import query
from lumenflow.session import fresh_path
from lumenflow.sources import bindings as B
from lumenflow.sources import topic_log
from lumenflow.sources.files import read_delimited
from lumenflow.streaming import cdc_stream


def _parsed(spark, sf_dir):
    # the events file is one task; parsing is worth more
    return cdc.parse_envelopes(B.cdc_messages(spark, sf_dir), B.CDC_ROW_SCHEMA,
                               partitions=spark.sparkContext.defaultParallelism)


@query("cdc_reject_split")
def q_cdc_reject_split(spark, sf_dir):
    return cdc.reject_split(_parsed(spark, sf_dir))


@query("cdc_latest_by_key")
def q_cdc_latest_by_key(spark, sf_dir):
    return cdc.latest_by_key(_parsed(spark, sf_dir), B.CDC_KEY)


@query("cdc_key_bounded_batch")
def q_cdc_key_bounded_batch(spark, sf_dir):
    return cdc.key_bounded_batch(_parsed(spark, sf_dir), B.CDC_KEY, B.CDC_BATCH_KEYS)


@query("cdc_field_report")
def q_cdc_field_report(spark, sf_dir):
    return cdc.field_report(_parsed(spark, sf_dir))


@query("cdc_drift_export")
def q_cdc_drift_export(spark, sf_dir):
    """Newest images with the fields the row schema lacks, as CSV.  ``value`` is text
    there, as some of them are no numbers."""
    path = f"{fresh_path(spark, 'drift')}/{cdc.export_name(B.CDC_TOPIC)}.csv"
    cdc.latest_with_drift(_parsed(spark, sf_dir), B.CDC_KEY).write.option("header", True).csv(path)
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.col("id").cast("bigint").alias("id"), "event_type", F.expr("try_cast(value AS double)").alias("value"),
                       F.col("value").isNotNull().alias("has_value"), "note")


@query("cdc_bounded_runs")
def q_cdc_bounded_runs(spark, sf_dir):
    """The consumer's runs over the whole topic: each ends where it holds
    ``CDC_BATCH_KEYS`` keys, and all are exported as CSV under the topic's name."""
    topic_dir = fresh_path(spark, "topic")
    B.cdc_messages(spark, sf_dir).repartitionByRange(8, "partition", "offset").write.parquet(topic_dir)
    messages = spark.read.schema(cdc_stream.MESSAGE_SCHEMA).parquet(topic_dir)
    exports = fresh_path(spark, "exports")
    exported = cdc_stream.drain_backlog(messages, B.CDC_ROW_SCHEMA, B.CDC_KEY, fresh_path(spark, "position"), exports,
                                        B.CDC_TOPIC, B.CDC_BATCH_KEYS)
    schema = "id bigint, event_type string, value double, run int"
    if not exported:
        return spark.createDataFrame([], schema)
    return spark.read.option("header", True).schema(schema).csv(f"{exports}/{cdc.export_name(B.CDC_TOPIC)}.csv")


@query("cdc_stream_latest")
def q_cdc_stream_latest(spark, sf_dir):
    """Envelopes land in a topic log; a streaming query drains it as a consumer group, in
    several micro-batches, and the sink is read back."""
    log, sink = fresh_path(spark, "topic_log"), fresh_path(spark, "cdc_sink")
    topic_log.append(B.cdc_messages(spark, sf_dir), log, B.CDC_SEGMENT)
    ends = topic_log.topic_end(spark, log)
    source = topic_log.stream_topic(spark, log, group="export", max_offsets_per_trigger=max(1, max(ends.values(), default=0) // 3))
    if ends:
        cdc_stream.run_bounded(source, B.CDC_ROW_SCHEMA, B.CDC_KEY, sink, fresh_path(spark, "cdc_checkpoint"), ends=ends)
    return cdc_stream.read_latest(spark, sink, B.CDC_KEY, B.CDC_ROW_SCHEMA)


@query("csv_export_roundtrip")
def q_csv_export_roundtrip(spark, sf_dir):
    out_dir = fresh_path(spark, "export")
    path = f"{out_dir}/{cdc.export_name(B.CDC_TOPIC)}.csv"
    latest = cdc.latest_by_key(_parsed(spark, sf_dir), B.CDC_KEY)
    latest.write.option("header", True).csv(path)
    return read_delimited(spark, path)
