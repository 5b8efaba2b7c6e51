"""A topic as a log of message files, and a streaming source that reads it.

The log is a folder.  Each append is a folder of its own, split by partition and by
segments of offsets, and becomes part of the topic by one commit file, which names the
folder and the offsets it holds of each partition.  Commits are numbered, and a number is
given once (``sinks.storage``), so a reader sees whole appends in order and appends don't
cross.  Offsets of a partition only grow from append to append.

``TopicLogSource`` (``format("topic_log")``) is a Python data source over that folder:

* offsets are a next offset per partition; a partition that turns up later starts at
  its first message (``startingOffsets`` ``earliest``, the default) as all do;
* a micro-batch is one task per file that holds offsets of its range, read with the
  range pushed into the file; nothing is read twice and nothing through the driver;
* nothing is committed by reading.  With a ``group``, the positions of finished batches are
  kept in ``_groups/<group>`` of the log, and ``startingOffsets`` ``committed`` begins there;
* ``maxOffsetsPerTrigger`` bounds what each partition adds to a batch.

The same name reads the log as a table (all that is committed when the read is planned).
Paths are opened with ``pyarrow.fs``, so the folder may lie on any store that it knows.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lumenflow.sinks import storage

SCHEMA = "value binary, topic string, partition int, offset bigint, timestamp timestamp"
SEGMENT = 1_000_000         # offsets of a folder
_ARROW = pa.schema([("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                    ("timestamp", pa.timestamp("us", "UTC"))])
_COMMIT = re.compile(r"^v=(\d{8})$")

Offsets = dict[int, int]


# ---- writing -------------------------------------------------------------------

def append(messages: DataFrame, root: str, segment: int = SEGMENT) -> int:
    """Append messages (``SCHEMA`` columns) to the log; returns the append's number.
    An offset that its partition already has, or has passed, is refused."""
    spark = messages.sparkSession
    folder = storage.fresh_folder("append")
    rows = messages.select(*_ARROW.names).withColumn("segment", F.floor(F.col("offset") / segment) * segment)
    (rows.repartition("partition", "segment").sortWithinPartitions("partition", "segment", "offset")
     .write.partitionBy("partition", "segment").parquet(f"{root}/{folder}"))
    # a row per partition of the topic
    held = spark.read.schema(f"{SCHEMA}, segment bigint").parquet(f"{root}/{folder}").groupBy("partition").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
    mine = {r["partition"]: (r["lo"], r["hi"]) for r in held}
    while True:
        known = storage.versions(spark, root)
        ends: Offsets = {}
        for n in known:
            ends |= {p: hi + 1 for p, (_, hi) in _Append.parse(storage.committed_text(spark, root, n)).ranges.items()}
        behind = sorted(p for p, (lo, _) in mine.items() if lo < ends.get(p, lo))
        if behind:
            storage.delete(spark, f"{root}/{folder}")
            raise ValueError(f"partitions {behind} already reach beyond these offsets")
        n = (known[-1] if known else 0) + 1
        if storage.claim_version(spark, root, n, json.dumps({"folder": folder, "ranges": {str(p): r for p, r in mine.items()}})):
            return n


def read_topic(spark: SparkSession, root: str) -> DataFrame:
    spark.dataSource.register(TopicLogSource)
    return spark.read.format("topic_log").load(root)


def stream_topic(spark: SparkSession, root: str, group: str | None = None, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    spark.dataSource.register(TopicLogSource)
    reader = spark.readStream.format("topic_log").option("startingOffsets", starting)
    if group:
        reader = reader.option("group", group)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load(root)


def topic_end(spark: SparkSession, root: str) -> Offsets:
    """The next offset of each partition."""
    return _Log(root).end()


def committed_offsets(root: str, group: str) -> Offsets:
    """Where a group's finished batches end; empty before the first."""
    return _Log(root).group(group)


# ---- reading (no session: this side runs in the source's own workers) ------------

@dataclass(frozen=True)
class _Append:
    folder: str
    ranges: dict[int, tuple[int, int]]

    @staticmethod
    def parse(text: str) -> _Append:
        found = json.loads(text) if text else {"folder": "", "ranges": {}}
        return _Append(found["folder"], {int(p): (lo, hi) for p, (lo, hi) in found["ranges"].items()})


@dataclass(frozen=True)
class _Range(InputPartition):
    """Offsets [start, end) of a partition in one file."""
    file: str
    partition: int
    start: int
    end: int


class _Log:
    def __init__(self, root: str) -> None:
        path = re.sub(r"^file:/+", "/", root)
        self.fs, self.base = pafs.FileSystem.from_uri(path)
        self.seen: dict[int, _Append] = {}

    def _text(self, path: str) -> str:
        with self.fs.open_input_stream(path) as f:
            return f.read().decode()

    def appends(self) -> list[_Append]:
        """In the order of their numbers, up to the first that is not complete; a
        commit that was read is not read again."""
        at = posixpath.join(self.base, "_commits")
        listed = self.fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        for n in sorted(int(m.group(1)) for f in listed if (m := _COMMIT.match(f.base_name))):
            if n not in self.seen:
                text = self._text(posixpath.join(at, f"v={n:08d}"))
                if not text:
                    break
                self.seen[n] = _Append.parse(text)
        return [self.seen[n] for n in sorted(self.seen)]

    def start(self) -> Offsets:
        out: Offsets = {}
        for a in self.appends():
            for p, (lo, _) in a.ranges.items():
                out.setdefault(p, lo)
        return out

    def end(self) -> Offsets:
        out: Offsets = {}
        for a in self.appends():
            out |= {p: hi + 1 for p, (_, hi) in a.ranges.items()}
        return out

    def plan(self, start: Offsets, end: Offsets) -> list[_Range]:
        out = []
        for a in self.appends():
            for p, (lo, hi) in a.ranges.items():
                first, last = max(start.get(p, lo), lo), min(end.get(p, 0), hi + 1)
                if first >= last:
                    continue
                where = posixpath.join(self.base, a.folder, f"partition={p}")
                for f in self.fs.get_file_info(pafs.FileSelector(where, recursive=True)):
                    segment = re.search(r"/segment=(\d+)/", f.path)
                    if f.is_file and f.base_name.startswith("part-") and segment and int(segment.group(1)) < last:
                        out.append(_Range(f.path, p, first, last))
        return out

    def read(self, r: _Range) -> Iterator[pa.RecordBatch]:
        inside = (pc.field("offset") >= r.start) & (pc.field("offset") < r.end)
        file = pads.dataset(r.file, filesystem=self.fs, format="parquet")
        for batch in file.to_batches(columns=["value", "topic", "offset", "timestamp"], filter=inside):
            if batch.num_rows:
                columns = {"partition": pa.array([r.partition] * batch.num_rows, pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] if f.name in columns else batch.column(f.name).cast(f.type) for f in _ARROW], schema=_ARROW)

    def _group_path(self, group: str) -> str:
        return posixpath.join(self.base, "_groups", f"{group}.json")

    def group(self, group: str) -> Offsets:
        path = self._group_path(group)
        if self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            return {}
        return {int(p): n for p, n in json.loads(self._text(path)).items()}

    def commit_group(self, group: str, offsets: Offsets) -> None:
        path = self._group_path(group)
        self.fs.create_dir(posixpath.dirname(path))
        with self.fs.open_output_stream(f"{path}.new") as f:
            f.write(json.dumps(_written(offsets)).encode())
        self.fs.move(f"{path}.new", path)


def _written(offsets: Offsets) -> dict[str, int]:
    return {str(p): n for p, n in sorted(offsets.items())}


def _read(offsets: dict) -> Offsets:
    return {int(p): int(n) for p, n in offsets.items()}


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _TopicReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TopicStream(self.options)


class _TopicReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"]

    def partitions(self) -> list[InputPartition]:
        log = _Log(self.root)
        return log.plan({}, log.end())

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _Log(self.root).read(partition)


class _TopicStream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.root, self.group = options["path"], options.get("group")
        self.starting = options.get("startingOffsets", "earliest")
        if self.starting not in ("earliest", "committed"):
            raise ValueError(f"startingOffsets is earliest or committed, not {self.starting}")
        if self.starting == "committed" and not self.group:
            raise ValueError("committed offsets are those of a group")
        most = options.get("maxOffsetsPerTrigger")
        self.most = int(most) if most else None
        self.log: _Log | None = None
        self.last: Offsets | None = None

    def _open(self) -> _Log:
        self.log = self.log or _Log(self.root)
        return self.log

    def initialOffset(self) -> dict:
        log = self._open()
        first = log.start()
        if self.starting == "committed":
            first |= log.group(self.group)
        return _written(first)

    def latestOffset(self) -> dict:
        log = self._open()
        end = log.end()
        if self.most is None:
            return _written(end)
        # a restarted query goes on from its checkpoint, which is never behind what its
        # group has finished or, without one, the start; each call moves on from the last
        if self.last is None:
            self.last = log.start() | (log.group(self.group) if self.group else {})
        first = log.start()
        self.last = {p: min(n, self.last.get(p, first[p]) + self.most) for p, n in end.items()}
        return _written(self.last)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self._open().plan(_read(start), _read(end))

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _Log(self.root).read(partition)

    def commit(self, end: dict) -> None:
        if self.group:
            self._open().commit_group(self.group, _read(end))
