"""Change-data-capture as a Structured Streaming job.

Source: Kafka (``format('kafka')``) when the connector is on the classpath,
a topic log (``sources.topic_log``: positions per partition, groups, restart), or a
folder of Parquet files with the same columns (``value``, ``partition``, ``offset``,
``timestamp``, ``topic``).  Each micro-batch is
parsed and reduced to the newest row per key inside ``foreachBatch``; no
state is carried between batches.  The batch output is written to
``<sink>/batch=<id>`` with overwrite, so a replayed batch (after a failure
between write and checkpoint commit) rewrites the same folder: the sink is
idempotent and the checkpoint gives at-least-once delivery.
"""

from __future__ import annotations

import ast
import time
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lumenflow.operators import backlog, cdc
from lumenflow.session import materialize
from lumenflow.sinks import storage

MESSAGE_SCHEMA = ("value binary, topic string, partition int, offset bigint, "
                  "timestamp timestamp")


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    try:
        return reader.load()
    except Exception as exc:  # the connector is a separate package
        if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the "
                               "classpath; use file_source() for a folder of messages") from exc
        raise


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _export_batch(batch: DataFrame, batch_id: int, row_schema: str, key: str, sink: str) -> None:
    parsed = cdc.parse_envelopes(batch, row_schema)
    order = cdc.accepted_order()
    newest = (parsed.groupBy(F.col("after")[key].alias("_key"))
              .agg(F.max_by(F.struct(order.alias("_order"), F.col("after").alias("_row")),
                             order).alias("_m"))
              .where(F.col("_m").isNotNull())
              .select("_m._order", "_m._row"))
    newest.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")


def run_latest_by_key(messages: DataFrame, row_schema: str, key: str, sink: str,
                      checkpoint: str) -> None:
    """Process everything available now, then stop."""
    q = (messages.writeStream.foreachBatch(lambda batch, n: _export_batch(batch, n, row_schema, key, sink))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


KEYS, SECONDS, DRAINED = "keys", "seconds", "drained"
_POLL = 0.05


def run_bounded(messages: DataFrame, row_schema: str, key: str, sink: str, checkpoint: str,
                max_keys: int | None = None, max_seconds: float | None = None,
                ends: dict[int, int] | None = None) -> str:
    """One run of the stream, ended by whichever comes first: ``max_keys`` distinct keys are
    held in the run's batches (``KEYS``), ``max_seconds`` are over (``SECONDS``), or the
    source's position has reached ``ends``, next offsets per partition (``DRAINED``).
    Returns which.

    Micro-batches follow one another as fast as they come.  A bound is looked at
    between batches: the batch that reaches it is still exported whole, and its offsets are
    committed after that; the next is not begun.  What the run has not committed the next
    run with the same checkpoint reads again.
    """
    spark = messages.sparkSession
    began, mine, over = time.monotonic(), [], []

    def reached() -> str | None:
        if max_seconds is not None and time.monotonic() - began >= max_seconds:
            return SECONDS
        if max_keys is not None and mine and (spark.read.parquet(*[f"{sink}/batch={n}" for n in mine])
                                              .select(F.col("_row")[key]).distinct().count() >= max_keys):
            return KEYS
        return None

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if over:
            raise _Over()                       # not begun: its offsets stay uncommitted
        _export_batch(batch, batch_id, row_schema, key, sink)
        mine.append(batch_id)
        if why := reached():
            over.append(why)

    q = (messages.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(processingTime="0 seconds").start())
    try:
        while not (over and _committed(q, mine)):
            if not q.isActive:
                q.awaitTermination()            # raises what ended it
            if not mine and (why := reached()):
                over.append(why)                # the time is over and no batch came
                break
            last = q.lastProgress
            if ends is not None and last and last["sources"] and _position(last["sources"][0]["endOffset"]) == ends and _committed(q, mine):
                over.append(DRAINED)
            if max_seconds is not None and time.monotonic() - began >= max_seconds and not over:
                over.append(SECONDS)
            time.sleep(_POLL)
    except StreamingQueryException:
        if not over:
            raise
    finally:
        q.stop()
    return over[0]


class _Over(Exception):
    pass


def _committed(q, batches: list[int]) -> bool:
    """Whether the last exported batch is finished, its offsets with it."""
    last = q.lastProgress
    return not batches or bool(last) and last["batchId"] >= batches[-1] or not q.isActive


def _position(offset) -> dict[int, int]:
    """The position in a progress report, which has it as the text of a dict."""
    found = ast.literal_eval(offset) if isinstance(offset, str) else offset or {}
    return {int(p): int(n) for p, n in found.items()}


def read_latest(spark: SparkSession, sink: str, key: str, row_schema: str | None = None) -> DataFrame:
    """Newest row per key over all batches written so far; none if there is no batch and
    the row schema says what none is."""
    if row_schema and not storage.exists(spark, sink):
        return spark.createDataFrame([], row_schema)
    batches = spark.read.parquet(sink)
    fields = batches.schema["_row"].dataType.fieldNames()
    newest = (batches.groupBy(F.col("_row")[key].alias("_key"))
              .agg(F.max_by("_row", "_order").alias("_row")))
    return newest.select(*[F.col("_row")[f].alias(f) for f in fields])


def compact_batches(spark: SparkSession, sink: str, key: str, upto: int) -> str:
    """Fold the batches up to ``upto`` into one folder beside them, newest row
    per key, and return the new sink: later reads scan the distinct keys and
    the newer batches instead of every batch ever written.  The old sink is
    left for its readers."""
    target = f"{sink}-upto-{upto}"
    old = spark.read.parquet(sink)
    (old.where(F.col("batch") <= upto).groupBy(F.col("_row")[key].alias("_key"))
     .agg(F.max_by(F.struct("_order", "_row"), "_order").alias("_m")).select("_m.*")
     .write.mode("overwrite").parquet(f"{target}/batch={upto}"))
    newer = old.where(F.col("batch") > upto)
    if not newer.isEmpty():
        newer.write.mode("append").partitionBy("batch").parquet(target)
    return target


FIRST_WINDOW = 4        # offsets a partition that a run first looks at, per key of its bound


def topic_ends(messages: DataFrame) -> dict[int, tuple[int, int]]:
    """The first and last offset of each partition, a row per partition."""
    return {r["partition"]: (r["lo"], r["hi"]) for r in messages.groupBy("partition").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()}


def consume_bounded(messages: DataFrame, row_schema: str, key: str, state_root: str,
                    export_dir: str, topic: str, batch_size: int = 1000) -> int:
    """One bounded run of the change consumer over a replayable source.

    The committed position is one offset per partition (a small versioned
    table below ``state_root``): a run reads the messages from there on, so a
    message is read whatever its timestamp.  Partitions are read side by side
    (order: distance from the partition's origin, then partition; the origin is
    its first offset when it was first seen, set so that it joins the others where
    they are) until ``batch_size`` distinct keys are held or nothing is left.  The
    order doesn't depend on where runs begin, so runs one by one and
    ``drain_backlog`` cut at the same messages.  To find that
    place the run looks at a window of offsets per partition and doubles it
    while it holds too few keys; the window is a plain range of (partition,
    offset), which the source can push down, so a long backlog isn't read for
    a small batch.

    The newest row per key goes to ``<export_dir>/<topic with underscores>.csv``
    (replacing the export before it), unless there is none: then the export
    stays.  Only afterwards the new offsets are committed, so a failed run is
    repeated (at least once).  Returns the number of rows exported.
    """
    return next_run(messages, row_schema, key, state_root, export_dir, topic, batch_size, topic_ends(messages)) or 0


def next_run(messages: DataFrame, row_schema: str, key: str, state_root: str, export_dir: str,
             topic: str, batch_size: int, ends: dict[int, tuple[int, int]]) -> int | None:
    """``consume_bounded`` up to ``ends`` (of ``topic_ends``).  None once the
    committed offsets have reached them, which a run that exports no row (0)
    does not mean: draining a topic is calling this until it gives None."""
    topic_start = _Position.read(messages.sparkSession, state_root, ends)
    base, origin = topic_start.base, topic_start.origin
    if not base:
        return None
    spark = messages.sparkSession
    least = min(base[p] - origin[p] for p in base)
    left = max(ends[p][1] - origin[p] for p in base) - least + 1

    def window(size: int) -> DataFrame:
        """Messages less than ``size`` steps from the first; the ends keep a growing
        source out of the run."""
        some = F.lit(False)
        for p, first in base.items():
            last = min(origin[p] + least + size - 1, ends[p][1])
            some = some | ((F.col("partition") == p) & F.col("offset").between(first, last))
        return cdc.parse_envelopes(messages.where(some), row_schema).withColumn("_far", _far(origin))

    order = F.struct("_far", "partition")
    size, cut = FIRST_WINDOW * batch_size, None
    while True:
        parsed = window(size)
        cut = cdc.key_bound_cutoff(parsed, key, batch_size, order)
        if cut is not None or size >= left:
            break
        size *= 2
    batch = parsed
    if cut is not None:
        batch = parsed.where(order <= F.struct(F.lit(cut["_far"]).cast("bigint").alias("_far"),
                                               F.lit(cut["partition"]).cast("int").alias("partition")))
    nexts = {p: (ends[p][1] + 1 if cut is None else max(base[p], min(
        origin[p] + cut["_far"] + (1 if p <= cut["partition"] else 0), ends[p][1] + 1))) for p in base}
    out = cdc.latest_by_key(batch, key)
    n = 0
    if not out.isEmpty():
        path = f"{export_dir}/{cdc.export_name(topic)}.csv"
        out.write.mode("overwrite").option("header", True).csv(path)
        n = spark.read.option("header", True).csv(path).count()
    topic_start.commit(spark, state_root, nexts)
    return n


def _far(origin: dict[int, int]) -> Column:
    """Distance of a message from its partition's origin."""
    far = F.lit(None).cast("bigint")
    for p, first in origin.items():
        far = F.when(F.col("partition") == p, F.col("offset") - first).otherwise(far)
    return far


@dataclass(frozen=True)
class _Position:
    """Where a consumer stands: a row per partition of the topic."""
    version: int                            # of the committed table
    known: dict[int, tuple[int, int]]       # committed: next offset, origin
    base: dict[int, int]                    # first offset to read, of partitions that have one
    origin: dict[int, int]

    @staticmethod
    def read(spark: SparkSession, state_root: str, ends: dict[int, tuple[int, int]]) -> _Position:
        version = storage.current_number(spark, state_root)
        rows = storage.read_version(spark, state_root, version).collect() if version else []
        known = {r["partition"]: (r["next"], r["origin"]) for r in rows}
        level = max((nxt - origin for nxt, origin in known.values()), default=0)
        origin = {p: known[p][1] if p in known else lo - level for p, (lo, _) in ends.items()}
        start = {p: max(known[p][0], lo) if p in known else lo for p, (lo, _) in ends.items()}
        base = {p: start[p] for p, (_, hi) in ends.items() if hi >= start[p]}
        return _Position(version, known, base, {p: origin[p] for p in base})

    def commit(self, spark: SparkSession, state_root: str, nexts: dict[int, int]) -> None:
        """Refused (``storage.ConflictError``) if another consumer has moved on meanwhile."""
        rows = {p: (nxt, origin) for p, (nxt, origin) in self.known.items()} | {p: (n, self.origin[p]) for p, n in nexts.items()}
        storage.write_version(spark.createDataFrame(
            sorted((p, *r) for p, r in rows.items()), "partition int, next bigint, origin bigint").coalesce(1),
            state_root, self.version)


def drain_backlog(messages: DataFrame, row_schema: str, key: str, state_root: str, export_dir: str,
                  topic: str, batch_size: int = 1000, width: int = backlog.WIDTH) -> int:
    """All runs of ``consume_bounded`` up to the topic's present ends, together.

    The runs end at the same messages and hold the same rows as those called one by one, but
    their boundaries are found for the whole backlog (``operators.backlog``) and all are
    exported by one write, to ``<export_dir>/<topic with underscores>.csv/run=<n>``, n from 0.
    The ends are committed after it.  Returns the number of rows exported."""
    spark = messages.sparkSession
    ends = topic_ends(messages)
    here = _Position.read(spark, state_root, ends)
    if not here.base:
        return 0
    least = min(first - here.origin[p] for p, first in here.base.items())
    levels = max(ends[p][1] - here.origin[p] for p in here.base) - least + 1
    order = sorted(here.base)
    some, turn = F.lit(False), F.lit(None).cast("bigint")
    for i, p in enumerate(order):
        some = some | ((F.col("partition") == p) & F.col("offset").between(here.base[p], ends[p][1]))
        turn = F.when(F.col("partition") == p, F.lit(i).cast("bigint")).otherwise(turn)
    parsed = cdc.parse_envelopes(messages.where(some), row_schema)
    placed = parsed.withColumn("pos", (_far(here.origin) - least) * len(order) + turn)
    # written, as the boundaries and the export both read it, and filtered where it is read: a
    # filter before would be pushed into the parse and repeat it
    judged = materialize(placed.select("pos", "status", "after"), "judged")
    accepted = judged.where(F.col("status") == cdc.ACCEPTED).drop("status")
    runs = backlog.plan_runs(accepted.select("pos", F.xxhash64(F.col("after")[key]).alias("key")), levels * len(order), batch_size, width)
    path = f"{export_dir}/{cdc.export_name(topic)}.csv"
    newest = (backlog.with_runs(accepted, runs, width).groupBy("run", F.col("after")[key].alias("_key"))
              .agg(F.max_by("after", "pos").alias("_row")).select("_row.*", "run"))
    # a run is at most ``batch_size`` rows, written by one task: one file, not one from every task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = Observation()
    (newest.repartition(tasks, "run").observe(written, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("header", True).partitionBy("run").csv(path))
    n = written.get.get("rows", 0)
    here.commit(spark, state_root, {p: ends[p][1] + 1 for p in here.base})
    return n
