"""Session construction and shared-storage helpers.

Library functions never create a session themselves; they take DataFrames.
``build_session`` is only for tests, the benchmark and local runs.  On a
cluster the caller owns the session and names a shared folder in
``spark.checkpoint.dir``; every intermediate table this package writes goes
below that folder.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "lumenflow") -> SparkSession:
    master = master or os.environ.get("LUMENFLOW_MASTER", "local[8]")
    shared = os.environ.get("LUMENFLOW_SHARED") or (
        tempfile.mkdtemp(prefix="lumenflow-") if master.startswith("local[") else None)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LUMENFLOW_DRIVER_MEMORY", "16g"))
    )
    if shared:
        builder = builder.config(SCRATCH_CONF, shared)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Unset, it is an error, except in one process (``local[...]``), where any
    folder is shared and a fresh one is registered.
    """
    base = spark.conf.get(SCRATCH_CONF, None)
    if not base:
        base = spark.sparkContext.getConf().get(SCRATCH_CONF, None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {SCRATCH_CONF} to a folder that the driver and all executors of {master} share")
        base = tempfile.mkdtemp(prefix="lumenflow-")
        spark.conf.set(SCRATCH_CONF, base)
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


_owned: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _owned:
        _owned[-1].append(path)
    return path


@contextlib.contextmanager
def intermediates(spark: SparkSession):
    """Own the intermediate tables written inside: they are removed at the
    end.  For jobs that write their result themselves; a DataFrame that is
    returned still reads them."""
    _owned.append([])
    try:
        yield
    finally:
        from lumenflow.sinks import storage
        for path in _owned.pop():
            storage.delete(spark, path)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet below the shared folder and continue
    from the written table: the plan is computed once (a reliable RDD
    checkpoint computes it twice), the lineage is cut, the copy survives
    executor loss, and later scans get column pruning and pushdown."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
