"""Staged upsert of a delimited file, and bulk loads.

Upsert: rows of the target whose key appears in the staging file are
replaced by the staging rows, stamped with ``etl_date``.  The table is kept
in key buckets.  What is in it is named by a manifest, a small versioned table
of (bucket, folder); an upsert writes folders of its own and then the next version of
the manifest.  That commit is the only switch, so a failed upsert leaves the whole
previous table, and a reader of an older manifest still finds its files.

Two ways to write, on the same table:

* ``upsert_bucketed`` copies on write: it reads the touched buckets and writes them
  again without the replaced rows.
* ``upsert_by_positions`` merges on read: it writes the staging rows beside what is
  there, and for the rows they replace only their positions, one bitmap a data file
  (its *deletion vector*).  It reads the key column of the touched buckets and nothing
  else of them.  Readers drop the positions; ``compact`` rewrites buckets in which
  many have gathered.

The commit is a compare and set on the manifest version that was read.  If another
upsert came first, buckets that it did not touch need no more than the newer manifest
(the written folders stay as they are); otherwise the upsert is done again on the newer
table.  No writer's rows are lost.

The manifest also holds the key and the number of buckets, so both are fixed
by the first load and can't drift between calls (``rebucket`` changes the
number).  Staging columns take the target's types before anything is hashed.
Rows with a null key are never deleted, so they are only ever added, in
folders of their own, and never rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.sinks import storage
from lumenflow.sources.files import read_by_extension, read_delimited

ETL_COLUMN = "etl_date"


def stage(spark: SparkSession, path: str, sep: str = ";", schema: str | None = None) -> DataFrame:
    return read_delimited(spark, path, sep=sep, schema=schema)


def merge_staging(target: DataFrame | None, staging: DataFrame, key: str,
                  etl_date: Column) -> DataFrame:
    """The table after the upsert (pure; no write)."""
    stamped = staging.withColumn(ETL_COLUMN, etl_date)
    if target is None:
        return stamped
    stamped = conform(stamped, target)
    # one row per key and map task before the join; AQE broadcasts the keys
    # only when they measure small
    keys = stamped.select(key).where(F.col(key).isNotNull()).distinct()
    kept = target.join(keys, key, "left_anti")
    return kept.unionByName(stamped, allowMissingColumns=True)


def conform(staging: DataFrame, target: DataFrame) -> DataFrame:
    """Staging columns cast by name to the target's types."""
    types = dict(target.dtypes)
    return staging.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                            for c in staging.columns])


BUCKET_COLUMN = "key_bucket"
MIN_BUCKETS = 16
ROWS_PER_BUCKET = 5_000_000     # what the first load aims at
FILES_PER_BUCKET = 4            # tasks that write one bucket
NO_KEY = -1                     # manifest entry of the folders of rows without a key
COMPACT_SHARE = 0.2             # deleted rows of a bucket at which compact rewrites it
COMPACT_FOLDERS = 8             # or so many folders


@dataclass(frozen=True)
class Manifest:
    version: int                                # 0: not committed yet
    key: str
    buckets: int
    columns: str                                # DDL
    folders: tuple[tuple[int, str], ...]
    gone: tuple[tuple[int, str], ...] = ()      # at most one folder of deletion vectors a bucket

    def paths(self, wanted=None) -> list[str]:
        return [p for b, p in self.folders if wanted is None or b in wanted]

    def touched_state(self, touched) -> set:
        """What an upsert of these buckets depends on."""
        return {(b, p) for b, p in (*self.folders, *self.gone) if b in touched}


def read_manifest(spark: SparkSession, table_root: str) -> Manifest | None:
    """At most a few rows a bucket and one for each load without a key."""
    root = f"{table_root}/manifest"
    version = storage.current_number(spark, root)
    if not version:
        return None
    rows = storage.read_version(spark, root, version).collect()
    named = sorted((r["bucket"], r["folder"], r["gone"]) for r in rows if r["folder"] is not None)
    return Manifest(version, rows[0]["key"], rows[0]["buckets"], rows[0]["columns"],
                    tuple((b, p) for b, p, gone in named if not gone), tuple((b, p) for b, p, gone in named if gone))


def _commit(spark: SparkSession, table_root: str, m: Manifest) -> None:
    """The version after the one that ``m`` was made from, or a conflict."""
    rows = [(m.key, m.buckets, m.columns, b, p, gone) for part, gone in ((m.folders, False), (m.gone, True)) for b, p in part]
    rows = rows or [(m.key, m.buckets, m.columns, NO_KEY, None, False)]
    storage.write_version(spark.createDataFrame(
        rows, "key string, buckets int, columns string, bucket int, folder string, gone boolean").coalesce(1),
        f"{table_root}/manifest", m.version)


def key_bucket(key: str, buckets: int) -> Column:
    """Bucket of a key; ``NO_KEY`` for a missing one."""
    return F.when(F.col(key).isNull(), F.lit(NO_KEY)).otherwise(
        F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def _partitions(spark: SparkSession, root: str, column: str) -> dict[int, str]:
    fs, p = storage._fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return {int(n.split("=")[1]): f"{root}/{n}" for n in names if n.startswith(f"{column}=")}


def _write_buckets(df: DataFrame, key: str, buckets: int, table_root: str) -> dict[int, str]:
    """Write the rows below a new folder; (bucket -> folder) of what was written.
    ``FILES_PER_BUCKET`` tasks share a bucket and its rows are spread over them
    by all columns, so repeated or missing keys don't meet in one task."""
    spark = df.sparkSession
    root = f"{table_root}/data/{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64(*df.columns), F.lit(FILES_PER_BUCKET))
    (df.withColumn(BUCKET_COLUMN, key_bucket(key, buckets))
     .repartition(BUCKET_COLUMN, part)
     .write.partitionBy(BUCKET_COLUMN).parquet(root))
    return _partitions(spark, root, BUCKET_COLUMN)


def _scan(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _live(spark: SparkSession, m: Manifest, wanted=None, columns: list[str] | None = None, places: bool = False) -> DataFrame:
    """Rows of the table, or of some buckets, without deleted positions; with
    ``_file`` and ``_row`` if ``places``.  Only buckets with deletion vectors pay for them."""
    names = columns or spark.createDataFrame([], m.columns).columns
    file, row = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    marked = {b for b, _ in m.gone}
    wanted = {b for b, _ in m.folders} if wanted is None else set(wanted)
    clean, dirty = m.paths(wanted - marked), m.paths(wanted & marked)
    if clean or not dirty:
        out = _scan(spark, clean, m.columns)
        out = out.select(*names, file, row) if places and clean else out.select(*names)
        if places and not clean:
            out = out.withColumns({"_file": F.lit(None).cast("string"), "_row": F.lit(None).cast("bigint")})
        if not dirty:
            return out
    rows = _scan(spark, dirty, m.columns).select(*names, file, row)
    vectors = spark.read.schema(_VECTOR).parquet(*[p for b, p in m.gone if b in wanted])
    bit = F.expr("shiftright(coalesce(get(words, cast(_row / 64 as int)), 0L), cast(_row % 64 as int)) & 1L")
    kept = rows.join(vectors.withColumnRenamed("file", "_file"), "_file", "left").where(bit == 0)
    kept = kept.select(*names, *(["_file", "_row"] if places else []))
    return out.unionByName(kept) if clean else kept


def table_exists(spark: SparkSession, table_root: str) -> bool:
    return storage.table_exists(spark, f"{table_root}/manifest")


def _manifest(spark: SparkSession, table_root: str) -> Manifest:
    manifest = read_manifest(spark, table_root)
    if manifest is None:
        raise ValueError(f"no table at {table_root}")
    return manifest


def read_bucketed(spark: SparkSession, table_root: str) -> DataFrame:
    return _live(spark, _manifest(spark, table_root))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def _upsert(spark: SparkSession, staging: DataFrame, table_root: str, key: str | None, buckets: int | None,
            etl_date: Column | None, change: Callable) -> list[int]:
    """First load, or ``change(manifest, staging, touched) -> manifest``, committed on
    the version that it was made from or made to fit a newer one."""
    key = key or staging.columns[0]
    stamp = etl_date if etl_date is not None else F.current_timestamp()
    staging = staging.withColumn(ETL_COLUMN, stamp)
    while True:
        manifest = read_manifest(spark, table_root)
        if manifest is None:
            count = buckets or max(MIN_BUCKETS, -(-staging.count() // ROWS_PER_BUCKET))
            written = _write_buckets(staging, key, count, table_root)
            touched = sorted(b for b in written if b != NO_KEY)
            result = Manifest(0, key, count, _ddl(staging), tuple(written.items()))
        else:
            if key != manifest.key or buckets not in (None, manifest.buckets):
                raise ValueError(f"the table is bucketed by {manifest.key} in {manifest.buckets} buckets, "
                                 f"not by {key} in {buckets}")
            rows = conform(staging, spark.createDataFrame([], manifest.columns))
            touched = sorted(r[0] for r in rows.where(F.col(key).isNotNull())
                             .select(key_bucket(key, manifest.buckets).alias("b")).distinct().collect())
            result = change(manifest, rows, touched)
        while True:
            try:
                _commit(spark, table_root, result)
                return touched
            except storage.ConflictError:
                newer = _manifest(spark, table_root)
            base = manifest
            if base is None or (newer.key, newer.buckets, newer.columns) != (base.key, base.buckets, base.columns) \
                    or newer.touched_state(touched) != base.touched_state(touched):
                break                           # what was read has changed: once more
            result = _rebased(result, base, newer, touched)
            manifest = newer


def _rebased(mine: Manifest, base: Manifest, newer: Manifest, touched: list[int]) -> Manifest:
    """``mine``, made from ``base``, on ``newer``: its touched buckets and the rows
    without a key that it added."""
    added = tuple(x for x in mine.folders if x[0] in touched or x[0] == NO_KEY and x not in base.folders)
    return replace(newer, columns=mine.columns, folders=tuple(x for x in newer.folders if x[0] not in touched) + added,
                   gone=tuple(x for x in newer.gone if x[0] not in touched) + tuple(x for x in mine.gone if x[0] in touched))


def upsert_bucketed(spark: SparkSession, staging: DataFrame, table_root: str,
                    key: str | None = None, buckets: int | None = None,
                    etl_date: Column | None = None) -> list[int]:
    """Upsert into the table at ``table_root``, rewriting only the buckets the
    staging keys fall into; returns the buckets rewritten.

    The first column is the key unless ``key`` is given.  ``buckets`` is for
    the first load (by default about ``ROWS_PER_BUCKET`` rows each); later a
    value that differs from the table's is refused, as is another key.
    """
    def change(m: Manifest, rows: DataFrame, touched: list[int]) -> Manifest:
        keys = rows.select(m.key).where(F.col(m.key).isNotNull()).distinct()
        current = _live(spark, m, touched)
        merged = current.join(keys, m.key, "left_anti").unionByName(rows, allowMissingColumns=True)
        written = _write_buckets(merged, m.key, m.buckets, table_root)
        stray = set(written) - set(touched) - {NO_KEY}
        if stray:
            raise AssertionError(f"buckets {sorted(stray)} were written but not read")
        return replace(m, columns=_ddl(merged), folders=tuple(x for x in m.folders if x[0] not in touched) + tuple(written.items()),
                       gone=tuple(x for x in m.gone if x[0] not in touched))

    return _upsert(spark, staging, table_root, key, buckets, etl_date, change)


_VECTOR = "file string, words array<bigint>"


def _write_vectors(places: DataFrame, old: DataFrame | None, buckets: int, table_root: str) -> dict[int, str]:
    """(bucket -> folder) of the deletion vectors of (bucket, _file, _row), joined
    with those there are: bit _row % 64 of word _row / 64 of a file's array."""
    spark = places.sparkSession
    bits = places.select(BUCKET_COLUMN, F.col("_file").alias("file"), (F.col("_row") / 64).cast("int").alias("word"),
                         F.expr("shiftleft(1L, cast(_row % 64 as int))").alias("bits"))
    if old is not None:
        bits = bits.unionByName(old.select(BUCKET_COLUMN, "file", F.posexplode("words").alias("word", "bits")).where("bits <> 0"))
    words = bits.groupBy(BUCKET_COLUMN, "file", "word").agg(F.bit_or("bits").alias("bits"))
    per_file = words.groupBy(BUCKET_COLUMN, "file").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"), F.max("word").alias("last"))
    vectors = per_file.select(BUCKET_COLUMN, "file", F.transform(
        F.sequence(F.lit(0), F.col("last")), lambda w: F.coalesce(F.try_element_at("held", w), F.lit(0).cast("bigint"))).alias("words"))
    root = f"{table_root}/data/{uuid.uuid4().hex}"
    vectors.repartition(BUCKET_COLUMN).write.partitionBy(BUCKET_COLUMN).parquet(root)
    return _partitions(spark, root, BUCKET_COLUMN)


def upsert_by_positions(spark: SparkSession, staging: DataFrame, table_root: str,
                        key: str | None = None, buckets: int | None = None,
                        etl_date: Column | None = None) -> list[int]:
    """The same upsert by merge on read: the staging rows are written beside the
    table and the positions of the rows they replace into deletion vectors, so what is
    written follows the staging rows, however large the buckets are that they touch."""
    def change(m: Manifest, rows: DataFrame, touched: list[int]) -> Manifest:
        keys = rows.select(m.key).where(F.col(m.key).isNotNull()).distinct()
        # the smallest and largest key reach the scan, so files and row groups beyond are skipped
        lo, hi = keys.agg(F.min(m.key), F.max(m.key)).first()
        held = _live(spark, m, touched, [m.key], places=True)
        if lo is not None:
            held = held.where(F.col(m.key).between(F.lit(lo), F.lit(hi)))
        places = held.join(keys, m.key, "left_semi").withColumn(BUCKET_COLUMN, key_bucket(m.key, m.buckets))
        places = places.select(BUCKET_COLUMN, "_file", "_row")
        marked = [(b, p) for b, p in m.gone if b in touched]
        old = None
        for b, p in marked:
            part = spark.read.schema(_VECTOR).parquet(p).withColumn(BUCKET_COLUMN, F.lit(b))
            old = part if old is None else old.unionByName(part)
        vectors = _write_vectors(places, old, m.buckets, table_root)
        merged = spark.createDataFrame([], m.columns).unionByName(rows, allowMissingColumns=True)
        written = _write_buckets(merged, m.key, m.buckets, table_root)
        return replace(m, columns=_ddl(merged), folders=m.folders + tuple(written.items()),
                       gone=tuple(x for x in m.gone if x[0] not in vectors) + tuple(vectors.items()))

    return _upsert(spark, staging, table_root, key, buckets, etl_date, change)


def compact(spark: SparkSession, table_root: str, share: float = COMPACT_SHARE, folders: int = COMPACT_FOLDERS) -> list[int]:
    """Rewrite the buckets that lie in more than ``folders`` folders or of whose rows
    ``share`` or more are deleted; returns them.  A conflict leaves the table as it is."""
    m = _manifest(spark, table_root)
    many = {b for b, _ in m.folders if b != NO_KEY and sum(x == b for x, _ in m.folders) > folders}
    for b, p in m.gone:
        # a row per data file: the bits of its vector
        deleted = spark.read.schema(_VECTOR).parquet(p).agg(F.sum(F.aggregate(
            "words", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w)))).first()[0] or 0
        if deleted >= share * _scan(spark, m.paths({b}), m.columns).count():
            many.add(b)
    if many:
        written = _write_buckets(_live(spark, m, many), m.key, m.buckets, table_root)
        _commit(spark, table_root, replace(
            m, folders=tuple(x for x in m.folders if x[0] not in many) + tuple(written.items()),
            gone=tuple(x for x in m.gone if x[0] not in many)))
    return sorted(many)


def rebucket(spark: SparkSession, table_root: str, buckets: int) -> None:
    """The same rows in another number of buckets, as a new version."""
    manifest = _manifest(spark, table_root)
    rows = _live(spark, manifest)
    written = _write_buckets(rows, manifest.key, buckets, table_root)
    _commit(spark, table_root, replace(manifest, buckets=buckets, columns=_ddl(rows), folders=tuple(written.items()), gone=()))


def vacuum(spark: SparkSession, table_root: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` manifests and the folders that none
    of those names (explicit: older readers lose their files, and an upsert under
    way its new folders)."""
    root = f"{table_root}/manifest"
    storage.vacuum(spark, root, keep)
    named: set[str] = set()
    for n in storage.versions(spark, root):
        rows = storage.read_version(spark, root, n).select("folder").where("folder is not null").collect()
        named |= {r[0].rsplit("/", 1)[0].rsplit("/", 1)[-1] for r in rows}
    fs, p = storage._fs(spark, f"{table_root}/data")
    gone = [st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName() not in named]
    for path in gone:
        storage.delete(spark, path)
    return gone


def bulk_load(spark: SparkSession, source_path: str, target_path: str,
              sep: str = ",", schema: str | None = None) -> tuple[str, int]:
    """Replace the target with the whole source file (format chosen by the
    file name).  Returns the target path and the number of rows loaded,
    read from the written files' footers (exact even when tasks were
    retried, and no second pass over the data).  A CSV is read once if its
    ``schema`` (DDL) is given, twice if its types are to be inferred."""
    df = read_by_extension(spark, source_path, sep=sep, schema=schema)
    df.write.mode("overwrite").parquet(target_path)
    return target_path, spark.read.parquet(target_path).count()


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
              batch_rows: int = 100_000) -> None:
    """Replace a database table with ``df`` (the table is recreated, then
    filled in batches of ``batch_rows`` per executor connection)."""
    props = {"batchsize": str(batch_rows), **(properties or {})}
    df.write.mode("overwrite").jdbc(url, table, properties=props)


def load_statistics(spark: SparkSession, target_path: str) -> DataFrame:
    """(file, rows, bytes) of each file that a load wrote: measured on what is
    there, one row per written part."""
    files = spark.read.parquet(target_path).select("_metadata.file_name", "_metadata.file_size")
    return files.groupBy(F.col("file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
