"""Table storage on a shared file system.

* Versioned tables: each write goes to a folder of its own below the table
  root, and version n is the file ``_commits/v=<n>`` that names the folder.  The
  file is created only if it does not exist, so of several writers that read the
  same version exactly one gets the next number and the others learn of it
  (``ConflictError``): compare and set.  Readers take the newest version; a reader
  is never overwritten by its own writer, and old versions go only by an explicit
  ``vacuum``.  On a file system without an atomic create of a whole file (HDFS), a
  version whose file is still empty is not read, and no other writer gets past it;
  if its writer died, ``abandon`` frees the number.
* Month-partitioned tables: ``month_year=<label>`` folders replaced one at
  a time with dynamic partition overwrite.

File-system calls go through Hadoop's ``FileSystem`` of the session, so the
same code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_VERSION = re.compile(r"^v=(\d{8})$")


class ConflictError(RuntimeError):
    """Another writer has committed since the version was read."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _commit_file(root: str, n: int) -> str:
    return f"{root}/_commits/v={n:08d}"


def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its text unless it exists: of several callers exactly
    one succeeds."""
    fs, p = _fs(spark, path)
    if fs.getUri().getScheme() == "file":
        # a link appears whole or not at all, on shared mounts as well
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{local}.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError as exc:
        if "AlreadyExists" in exc.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def claim_version(spark: SparkSession, root: str, n: int, text: str) -> bool:
    """Commit ``text`` as version ``n``, unless there is one."""
    return _claim(spark, _commit_file(root, n), text)


def fresh_folder(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def committed_text(spark: SparkSession, root: str, n: int) -> str:
    """What a version's commit says (of a table: its folder); empty while it is
    being committed."""
    fs, p = _fs(spark, _commit_file(root, n))
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions there are, oldest first."""
    fs, p = _fs(spark, f"{root}/_commits")
    if not fs.exists(p):
        return []
    found = (_VERSION.match(st.getPath().getName()) for st in fs.listStatus(p))
    return sorted(int(m.group(1)) for m in found if m)


def current_number(spark: SparkSession, root: str) -> int:
    """The newest version; 0 if there is none."""
    for n in reversed(versions(spark, root)):
        if committed_text(spark, root, n):
            return n
    return 0


def version_path(spark: SparkSession, root: str, n: int) -> str:
    return f"{root}/{committed_text(spark, root, n)}"


def current_version(spark: SparkSession, root: str) -> str | None:
    n = current_number(spark, root)
    return version_path(spark, root, n) if n else None


def table_exists(spark: SparkSession, root: str) -> bool:
    return current_number(spark, root) > 0


def read_version(spark: SparkSession, root: str, n: int) -> DataFrame:
    return spark.read.parquet(version_path(spark, root, n))


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_version(spark, root)
    return spark.read.parquet(path) if path else None


def write_version(df: DataFrame, root: str, after: int | None = None) -> int:
    """Write ``df`` as the version after ``after`` (as read: 0 for none yet), or
    raise ``ConflictError`` if there is one already.  Without ``after`` it
    replaces whatever is current.  Older versions stay readable until ``vacuum``."""
    spark = df.sparkSession
    folder = fresh_folder("data")
    df.write.parquet(f"{root}/{folder}")
    while True:
        known = versions(spark, root)
        n = (after if after is not None else known[-1] if known else 0) + 1
        # a number that vacuum freed is older than the current one
        if not (known and known[-1] >= n) and claim_version(spark, root, n, folder):
            return n
        if after is not None:
            delete(spark, f"{root}/{folder}")
            raise ConflictError(f"{root} has moved on from version {after}")


def abandon(spark: SparkSession, root: str, n: int) -> None:
    """Give up a version that its writer never finished."""
    if committed_text(spark, root, n):
        raise ValueError(f"version {n} of {root} is committed")
    delete(spark, _commit_file(root, n))


def vacuum(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove versions older than the newest ``keep`` (an explicit call: a
    reader may still hold an old version).  Returns the folders that went."""
    if keep < 1:
        raise ValueError("the current version is never removed")
    done = [n for n in versions(spark, root) if committed_text(spark, root, n)]
    gone = []
    for n in done[:-keep]:
        gone.append(version_path(spark, root, n))
        delete(spark, _commit_file(root, n))
        delete(spark, gone[-1])
    return gone


def replace_month(df: DataFrame, root: str, month: str, columns: tuple[str, ...],
                  partition_column: str = "month_year") -> int:
    """Make partition ``month`` of the table hold exactly the rows of ``df``.

    Rows of other months are never written (they would replace those
    partitions).  Dynamic partition overwrite swaps only the partition
    being written, so the job may read other months of the same table.
    An empty result deletes the partition, as a delete-then-insert would.
    Returns the number of rows written.
    """
    spark = df.sparkSession
    rows = df.where(F.col(partition_column) == F.lit(month)).select(*columns)
    seen = Observation(f"replace_{abs(hash((root, month)))}")
    observed = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    (observed.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_column)
     .parquet(root))
    n = int(seen.get["n"])
    if n == 0:
        delete(spark, f"{root}/{partition_column}={month}")
    return n


def read_months(spark: SparkSession, root: str, schema: str,
                partition_column: str = "month_year") -> DataFrame:
    """The month-partitioned table with its declared columns (``schema`` is
    their DDL, in order).  Nothing is inferred, so a table that doesn't exist
    yet, or whose last month was emptied, is an empty table."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(root).select(
        *spark.createDataFrame([], schema).columns)
