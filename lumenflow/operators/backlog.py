"""Run boundaries of a whole backlog at once.

A consumer that stops at the message which brings it to ``k`` distinct keys cuts a
backlog into runs.  One run's end is a function of its start: the k-th message from there on
whose key was not seen since the start.  Followed one by one, the runs are as many jobs as
there are runs; here they are found in a number of jobs that grows with the logarithm of the
backlog.

Messages lie on a line of positions, cut into chunks of ``width``.

1. ``_frontiers``: for each chunk the first occurrences of the first k distinct keys from it
   on.  A chunk's own come first, then those of 1, 2, 4, ... chunks ahead are merged in, until
   all have k or reach the end.  They are all a run that starts before the chunk needs to know
   of what lies behind its end.
2. Within a chunk two pointers give the end of the run from every start, so also where the
   last run that starts in the chunk ends (the chunk's exit) and how many runs that takes.  The
   positions that are some start's exit are the *entries* of the chunks they lie in.
3. Each entry leads to its own exit, which is an entry again: a successor function over the
   entries, a small part of the positions.  Pointer doubling from position 0 finds the entries
   that are really entered, with their run numbers.
4. Every chunk then names the run starts in it.

No step sees more than a chunk and k keys in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.session import materialize

WIDTH = 50_000


def _frontiers(held: DataFrame, n_chunks: int, batch_size: int) -> DataFrame:
    """(chunk, ahead): array<struct<pos, key>> of the first occurrences of the first
    ``batch_size`` distinct keys from the chunk's start on."""
    def firsts(batches):
        for batch in batches:
            chunks, rows = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                pos, key = (np.asarray(c) for c in rows[i].values.flatten())
                at = np.sort(np.unique(key, return_index=True)[1])[:batch_size]
                out.append([{"pos": int(p), "key": int(k)} for p, k in zip(pos[at], key[at])])
            yield pa.RecordBatch.from_arrays([chunks, pa.array(out, rows.type)], names=["chunk", "ahead"])

    here = materialize(held.mapInArrow(firsts, "chunk long, ahead array<struct<pos:long,key:long>>"), "firsts")
    step = 1
    while not here.where((F.size("ahead") < batch_size) & (F.col("chunk") + step < n_chunks)).isEmpty():
        far = here.select((F.col("chunk") - step).alias("chunk"), F.col("ahead").alias("far"))
        known = F.transform("ahead", lambda x: x["key"])
        more = F.filter(F.col("far"), lambda x: ~F.array_contains(known, x["key"]))
        here = materialize(here.join(far, "chunk", "left").select("chunk", F.when(
            (F.size("ahead") < batch_size) & F.col("far").isNotNull(),
            F.slice(F.concat("ahead", more), 1, batch_size)).otherwise(F.col("ahead")).alias("ahead")), "firsts")
        step *= 2
    return here


def run_ends(keys: np.ndarray, starts: int, batch_size: int) -> np.ndarray:
    """For each of the first ``starts`` + 1 places, the index of the element at which a run
    from there holds ``batch_size`` distinct keys; the length where none does."""
    codes = np.unique(keys, return_inverse=True)[1].tolist()
    times = [0] * (max(codes, default=-1) + 1)
    out, distinct, end = np.empty(starts + 1, np.int64), 0, 0
    for i in range(starts + 1):
        while end < len(codes) and distinct < batch_size:
            distinct += not times[codes[end]]
            times[codes[end]] += 1
            end += 1
        out[i] = end - 1 if distinct == batch_size else len(codes)
        if i < starts:
            times[codes[i]] -= 1
            distinct -= not times[codes[i]]
    return out


class _Chunk:
    """The runs that start in one chunk."""

    def __init__(self, chunk: int, held, ahead, width: int, end: int, batch_size: int) -> None:
        (pos, key), (far, far_key) = ([np.asarray(c) for c in x.values.flatten()] if x.values is not None else
                                      [np.empty(0, np.int64)] * 2 for x in (held, ahead))
        self.pos, self.limit = pos, min((chunk + 1) * width, end)
        place = np.concatenate([pos, far, [end - 1]])
        self.next = place[run_ends(np.concatenate([key, far_key]), len(pos), batch_size)] + 1

    def exits(self) -> tuple[np.ndarray, np.ndarray]:
        """Per start (a message or, last, none of them): where the last run that starts in
        the chunk ends, and how many runs that takes."""
        out, hops = self.next.copy(), np.ones(len(self.next), np.int64)
        then = np.searchsorted(self.pos, self.next)
        for i in np.flatnonzero(self.next < self.limit)[::-1].tolist():
            out[i], hops[i] = out[then[i]], hops[then[i]] + 1
        return out, hops

    def starts(self, entry: int) -> list[int]:
        out = []
        while entry < self.limit:
            out.append(entry)
            entry = int(self.next[np.searchsorted(self.pos, entry)])
        return out


def plan_runs(messages: DataFrame, n_positions: int, batch_size: int, width: int = WIDTH) -> DataFrame:
    """(chunk, base, starts) of each chunk of ``messages(pos, key)``, all below ``n_positions``:
    the run that the chunk begins in (-1: none yet) and the positions at which runs start
    in it.  A message is in run ``base`` + the number of starts up to its position."""
    spark = messages.sparkSession
    n_chunks = max(1, -(-n_positions // width))
    rows = messages.select(F.floor(F.col("pos") / width).alias("chunk"), F.struct("pos", "key").alias("m"))
    held = rows.groupBy("chunk").agg(F.array_sort(F.collect_list("m")).alias("held"))
    held = spark.range(n_chunks).withColumnRenamed("id", "chunk").join(held, "chunk", "left").select(
        "chunk", F.coalesce("held", F.array().cast("array<struct<pos:bigint,key:bigint>>")).alias("held"))
    held = materialize(held, "held")
    ahead = _frontiers(held, n_chunks, batch_size).select((F.col("chunk") - 1).alias("chunk"), "ahead")
    chunks = materialize(held.join(ahead, "chunk", "left").select(
        "chunk", "held", F.coalesce("ahead", F.array().cast("array<struct<pos:bigint,key:bigint>>")).alias("ahead")), "chunks")

    def each(rows: DataFrame, answer, schema: str) -> DataFrame:
        """The rows ``answer`` gives for each (chunk, held, ahead, more)."""
        names = [c.split(" ")[0] for c in schema.split(", ")]

        def run(batches):
            for batch in batches:
                out = []
                for i in range(batch.num_rows):
                    c = _Chunk(batch.column(0)[i].as_py(), batch.column(1)[i], batch.column(2)[i], width, n_positions, batch_size)
                    out += answer(batch.column(0)[i].as_py(), c, batch.column(3)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(len(names))], names=names)
        return rows.mapInArrow(run, schema)

    leave = each(chunks.withColumn("more", F.lit(0)),
                 lambda _, c, more: [(int(x),) for x in np.unique(c.exits()[0]) if x < n_positions], "entry long")
    entries = leave.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("entry"))).distinct()
    entries = entries.groupBy(F.floor(F.col("entry") / width).alias("chunk")).agg(F.collect_list("entry").alias("entries"))

    def led(_, c, entries):
        exits, hops = c.exits()
        at = np.searchsorted(c.pos, entries)
        return list(zip(entries, exits[at].tolist(), hops[at].tolist()))

    jump = first = materialize(each(chunks.join(entries, "chunk"), led, "entry long, exit long, hops long"), "jump")
    entered = spark.range(1).select(F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("run"))
    while True:
        more = entered.join(jump, "entry").where(F.col("exit") < n_positions).select(
            F.col("exit").alias("entry"), (F.col("run") + F.col("hops")).alias("run"))
        grown = materialize(entered.unionByName(more), "entered")
        if more.isEmpty():
            entered = grown
            break
        entered = grown
        then = jump.select(F.col("entry").alias("exit"), F.col("exit").alias("far"), F.col("hops").alias("again"))
        jump = materialize(jump.join(then, "exit").select("entry", F.col("far").alias("exit"), (F.col("hops") + F.col("again")).alias("hops")), "jump")

    # the run in progress in every chunk between an entry and its exit
    last = F.least(F.floor(F.col("exit") / width), F.lit(n_chunks - 1))
    between = F.sequence(F.floor(F.col("entry") / width) + 1, last)
    begun = (entered.join(first, "entry").where(last > F.floor(F.col("entry") / width))
             .select(F.explode(between).alias("chunk"), (F.col("run") + F.col("hops") - 1).alias("base")))
    begun = begun.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("chunk"), F.lit(-1).cast("long").alias("base")))
    mine = entered.select(F.floor(F.col("entry") / width).alias("chunk"), F.col("entry").alias("more"))
    starts = each(chunks.join(mine, "chunk"), lambda n, c, entry: [(n, s) for s in c.starts(entry)], "chunk long, start long")
    starts = starts.groupBy("chunk").agg(F.array_sort(F.collect_list("start")).alias("starts"))
    return materialize(begun.join(starts, "chunk", "left").select(
        "chunk", "base", F.coalesce("starts", F.array().cast("array<bigint>")).alias("starts")), "runs")


def with_runs(messages: DataFrame, runs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``messages`` with the ``run`` of their ``pos``."""
    placed = messages.withColumn("_chunk", F.floor(F.col("pos") / width))
    named = runs.select(F.col("chunk").alias("_chunk"), F.col("base").alias("_base"), F.col("starts").alias("_starts"))
    run = F.col("_base") + F.size(F.filter("_starts", lambda s: s <= F.col("pos")))
    return placed.join(named, "_chunk").withColumn("run", run.cast("int")).drop("_chunk", "_base", "_starts")
