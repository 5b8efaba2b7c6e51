import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenflow.operators import backlog
from lumenflow.streaming import cdc_stream

SCHEMA = "struct<id:bigint,name:string>"


def sequential(messages, k):
    """(pos -> run) of a consumer that stops at the k-th distinct key."""
    out, run, held = {}, 0, set()
    for pos, key in sorted(messages):
        out[pos] = run
        held.add(key)
        if len(held) == k:
            run, held = run + 1, set()
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=30), st.integers(1, 5))
def test_run_ends_equal_counting(keys, k):
    for starts in range(len(keys) + 1):
        got = backlog.run_ends(np.array(keys, np.int64), starts, k)
        for i in range(starts + 1):
            want = next((q for q in range(i, len(keys)) if len(set(keys[i:q + 1])) == k), len(keys))
            assert got[i] == want


@pytest.mark.parametrize("seed, n, keys, k, width", [(0, 400, 25, 10, 37), (1, 300, 8, 8, 10), (2, 300, 5, 9, 16), (3, 200, 400, 1, 7),
                                                     (4, 500, 60, 40, 20), (5, 0, 3, 2, 5), (6, 300, 20, 3, 1000)])
def test_planned_runs_equal_a_sequential_consumer(spark, seed, n, keys, k, width):
    rng = random.Random(seed)
    size = max(1, n * 3)
    places = sorted(rng.sample(range(size), n))                       # gaps, and whole empty chunks
    places = [p for p in places if not n // 2 < p < n // 2 + 3 * width]
    rows = [(p, rng.randrange(keys) if rng.random() < 0.8 else 0) for p in places]
    messages = spark.createDataFrame(rows, "pos long, key long")
    runs = backlog.plan_runs(messages, size, k, width)
    got = {r["pos"]: r["run"] for r in backlog.with_runs(messages, runs, width).collect()}
    assert got == sequential(rows, k)
    assert runs.count() == -(-size // width)


def _topic(spark, seed, n, partitions, offsets=1):
    rng, rows, at = random.Random(seed), [], {}
    for i in range(n):
        key = None if rng.random() < 0.05 else rng.randrange(30)
        p = 0 if key is None else key % partitions                    # a key belongs to one partition
        at[p] = at.get(p, 100 * p) + rng.randrange(1, offsets + 1)
        after = {"id": key, "name": f"n{i}"}
        rows.append((json.dumps({"payload": {"op": rng.choice("ccuud"), "after": after}}).encode(), p, at[p]))
    return spark.createDataFrame(rows, "value binary, partition int, offset bigint").withColumn("timestamp", F.lit(None).cast("timestamp"))


def _one_by_one(spark, msgs, state, where, k):
    ends, out = cdc_stream.topic_ends(msgs), []
    while (n := cdc_stream.next_run(msgs, SCHEMA, "id", state, where, "t", k, ends)) is not None:
        rows = spark.read.option("header", True).schema("id bigint, name string").csv(f"{where}/t.csv").collect() if n else []
        out.append(sorted((r.id if r.id is not None else -1, r.name) for r in rows))
    return [r for r in out if r]


def _drained(spark, where):
    rows = spark.read.option("header", True).schema("id bigint, name string, run int").csv(f"{where}/t.csv").collect()
    runs = {}
    for r in rows:
        runs.setdefault(r.run, []).append((r.id if r.id is not None else -1, r.name))
    return [sorted(runs[k]) for k in sorted(runs)]


@pytest.mark.parametrize("seed, partitions, offsets, k, width", [(1, 1, 1, 10, 25), (2, 3, 1, 7, 20), (3, 4, 5, 12, 90)])
def test_draining_equals_runs_one_by_one(spark, scratch, seed, partitions, offsets, k, width):
    msgs = _topic(spark, seed, 150, partitions, offsets)
    want = _one_by_one(spark, msgs, scratch("state"), scratch("one"), k)
    state, where = scratch("state"), scratch("all")
    n = cdc_stream.drain_backlog(msgs, SCHEMA, "id", state, where, "t", k, width)
    assert _drained(spark, where) == want and n == sum(map(len, want)) and len(want) > 3
    assert cdc_stream.drain_backlog(msgs, SCHEMA, "id", state, where, "t", k, width) == 0
    assert cdc_stream.next_run(msgs, SCHEMA, "id", state, where, "t", k, cdc_stream.topic_ends(msgs)) is None


def test_draining_goes_on_after_a_run_and_new_messages(spark, scratch):
    whole = _topic(spark, 9, 160, 2)
    first = whole.where("offset < 150")
    states, wheres = (scratch("a"), scratch("b")), (scratch("x"), scratch("y"))
    for state, where in zip(states, wheres):
        assert cdc_stream.consume_bounded(first, SCHEMA, "id", state, where, "t", 6) == 6
    want = _one_by_one(spark, whole, states[0], wheres[0], 6)
    cdc_stream.drain_backlog(whole, SCHEMA, "id", states[1], scratch("z"), "t", 6, 30)
    assert cdc_stream.next_run(whole, SCHEMA, "id", states[1], wheres[1], "t", 6, cdc_stream.topic_ends(whole)) is None
    assert len(want) > 2


def test_draining_without_accepted_messages(spark, scratch):
    msgs = _topic(spark, 4, 40, 2).withColumn("value", F.lit(b"no json"))
    state = scratch("state")
    assert cdc_stream.drain_backlog(msgs, SCHEMA, "id", state, scratch("w"), "t", 5) == 0
    assert cdc_stream.next_run(msgs, SCHEMA, "id", state, scratch("w"), "t", 5, cdc_stream.topic_ends(msgs)) is None


def test_a_drained_run_is_one_file(spark, scratch):
    msgs = _topic(spark, 8, 400, 3).repartition(4)
    where = scratch("all")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # as where there is much data
    try:
        n = cdc_stream.drain_backlog(msgs, SCHEMA, "id", scratch("state"), where, "t", 20, 100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    files = spark.read.option("header", True).csv(f"{where}/t.csv").select("run", F.input_file_name().alias("f")).distinct().groupBy("run").count()
    rows = files.collect()
    assert tasks > 1 and n > 0 and len(rows) > 3 and {r["count"] for r in rows} == {1}
