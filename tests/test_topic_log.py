"""The topic log and its streaming source."""
import json
import time

import pytest
from pyspark.sql import functions as F

from lumenflow.sources import topic_log
from lumenflow.streaming import cdc_stream

SCHEMA = "struct<id:bigint,name:string>"


def _messages(spark, rows):
    """(partition, offset, id) -> messages."""
    out = [(json.dumps({"payload": {"op": "u", "after": {"id": i, "name": f"{p}-{o}"}}}).encode(), "t", p, o) for p, o, i in rows]
    return spark.createDataFrame(out, "value binary, topic string, partition int, offset bigint").withColumn("timestamp", F.timestamp_seconds("offset"))


def _drain(stream, checkpoint):
    got = []
    q = (stream.writeStream.foreachBatch(lambda df, n: got.append([(r["partition"], r["offset"]) for r in df.collect()]))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return got


def test_appends_are_read_as_a_table(spark, scratch):
    root = scratch("log")
    rows = [(p, o, o) for p in (0, 1) for o in range(5 * p, 5 * p + 30)]
    assert topic_log.append(_messages(spark, rows[::2]).where("partition = 0"), root, 10) == 1
    assert topic_log.append(_messages(spark, rows[30:]), root, 10) == 2
    got = topic_log.read_topic(spark, root)
    assert got.columns == ["value", "topic", "partition", "offset", "timestamp"]
    want = sorted((p, o) for p, o, _ in rows[::2] if p == 0) + [(1, o) for _, o, _ in rows[30:]]
    assert sorted((r["partition"], r["offset"]) for r in got.collect()) == want
    assert got.where("timestamp <> timestamp_seconds(offset) or topic <> 't'").isEmpty()
    assert topic_log.topic_end(spark, root) == {0: 29, 1: 35}


def test_a_log_only_grows(spark, scratch):
    root = scratch("log")
    topic_log.append(_messages(spark, [(0, 5, 1), (1, 2, 1)]), root)
    with pytest.raises(ValueError):
        topic_log.append(_messages(spark, [(0, 6, 1), (1, 2, 1)]), root)
    assert topic_log.topic_end(spark, root) == {0: 6, 1: 3}
    assert topic_log.append(_messages(spark, [(0, 9, 1)]), root) == 2


def test_earliest_restart_and_late_partitions(spark, scratch):
    root, checkpoint = scratch("log"), scratch("checkpoint")
    topic_log.append(_messages(spark, [(0, o, o) for o in range(3, 20)]), root, 10)
    first = _drain(topic_log.stream_topic(spark, root), checkpoint)
    assert sorted(sum(first, [])) == [(0, o) for o in range(3, 20)]                # from the earliest on
    topic_log.append(_messages(spark, [(0, 25, 1), (7, 100, 1), (7, 101, 2)]), root, 10)
    again = _drain(topic_log.stream_topic(spark, root), checkpoint)                # the checkpoint goes on
    assert sorted(sum(again, [])) == [(0, 25), (7, 100), (7, 101)]
    assert sum(_drain(topic_log.stream_topic(spark, root), checkpoint), []) == []


def test_nothing_is_committed_by_reading(spark, scratch):
    root = scratch("log")
    topic_log.append(_messages(spark, [(0, o, o) for o in range(10)]), root)
    stream = topic_log.stream_topic(spark, root, group="g")

    def fails(df, n):
        df.collect()
        raise RuntimeError("the export failed")

    q = stream.writeStream.foreachBatch(fails).option("checkpointLocation", scratch("c1")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="the export failed"):
        q.awaitTermination()
    assert topic_log.committed_offsets(root, "g") == {}
    _drain(topic_log.stream_topic(spark, root), scratch("c2"))                     # no group: nothing either
    assert topic_log.committed_offsets(root, "g") == {}


def test_a_group_goes_on_without_its_checkpoint(spark, scratch):
    root = scratch("log")
    topic_log.append(_messages(spark, [(0, o, o) for o in range(10)]), root)
    sink = scratch("sink")
    why = cdc_stream.run_bounded(topic_log.stream_topic(spark, root, "g", max_offsets_per_trigger=4), SCHEMA, "id", sink,
                                 scratch("c1"), ends=topic_log.topic_end(spark, root))
    assert why == cdc_stream.DRAINED and cdc_stream.read_latest(spark, sink, "id").count() == 10
    done = topic_log.committed_offsets(root, "g").get(0, 0)
    assert 0 < done <= 10                                                          # the last batch may not be confirmed yet
    topic_log.append(_messages(spark, [(0, o, o) for o in range(10, 13)]), root)
    rest = _drain(topic_log.stream_topic(spark, root, "g", "committed"), scratch("c2"))
    assert sorted(sum(rest, [])) == [(0, o) for o in range(done, 13)]
    with pytest.raises(Exception, match="group"):
        _drain(topic_log.stream_topic(spark, root, None, "committed"), scratch("c3"))


def test_the_key_bound_ends_a_run(spark, scratch):
    root, sink, checkpoint = scratch("log"), scratch("sink"), scratch("c")
    topic_log.append(_messages(spark, [(o % 2, o // 2, o // 3) for o in range(120)]), root)
    stream = lambda: topic_log.stream_topic(spark, root, "g", max_offsets_per_trigger=5)     # noqa: E731
    ends = topic_log.topic_end(spark, root)
    assert cdc_stream.run_bounded(stream(), SCHEMA, "id", sink, checkpoint, max_keys=9, max_seconds=120, ends=ends) == cdc_stream.KEYS
    held = cdc_stream.read_latest(spark, sink, "id").count()
    assert 9 <= held < 20                                                          # a batch brings at most ten
    assert cdc_stream.run_bounded(stream(), SCHEMA, "id", sink, checkpoint, max_keys=1000, max_seconds=120, ends=ends) == cdc_stream.DRAINED
    got = {r["id"]: r["name"] for r in cdc_stream.read_latest(spark, sink, "id").collect()}
    assert len(got) == 40                                                          # every message was read, over both runs
    assert all(got[i] == max((f"{o % 2}-{o // 2}" for o in range(3 * i, 3 * i + 3)), key=lambda n: tuple(map(int, n.split("-")[::-1]))) for i in got)


def test_the_time_bound_ends_a_run(spark, scratch):
    root, sink = scratch("log"), scratch("sink")
    topic_log.append(_messages(spark, [(0, o, o) for o in range(5)]), root)
    start = time.monotonic()
    why = cdc_stream.run_bounded(topic_log.stream_topic(spark, root, "g"), SCHEMA, "id", sink, scratch("c"), max_keys=100, max_seconds=12)
    assert why == cdc_stream.SECONDS and time.monotonic() - start >= 12
    assert cdc_stream.read_latest(spark, sink, "id").count() == 5
