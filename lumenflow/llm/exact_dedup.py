"""Exact deduplication: a tree merge of sorted digest runs.

Each input partition becomes one run sorted by digest, with one row per digest.
Partitions then exchange runs in rounds: ``FAN`` neighbouring runs meet, cut by
digest over the tasks, are merged in sorted order, and one row per digest stays
(the identifier kept so far and the number of rows behind it).  After the last
round one run is left, spread over the tasks by digest.  A copy costs one row
per run, so no group of copies is ever gathered, however large.

Every merge verifies: rows are the same text only if the SHA-256 digest, the
length and a second independent hash all agree.

Defined results: a null text equals the empty text; the row with the largest
``doc_id`` stays (a null id only if there is no other); rows that repeat both
id and text have the same ``kept``, and ``drop_copies`` returns one of them; an
empty table gives an empty result; other columns are untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.session import materialize

RUNS = 512
FAN = 8
_RUN = "run int, digest binary, n_bytes long, check long, keep_id long, n long"
_TEXT = "_lf_text"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_bytes, check) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias(_TEXT)).select(
        "doc_id", F.unhex(F.sha2(F.col(_TEXT), 256)).alias("digest"),
        F.octet_length(_TEXT).cast("long").alias("n_bytes"), F.xxhash64(_TEXT).alias("check"))


def _merge(batches):
    """Fold a stream sorted by (run, digest, n_bytes, check, id descending):
    the first identifier of each text stays, the counts add up.  The last text
    of a batch is held back, as the next batch may continue it."""
    schema, held = None, None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        schema = table.schema
        if held is not None:
            table = pa.concat_tables([held, table])
        table = table.combine_chunks()
        if not len(table):
            continue
        new = np.zeros(len(table), bool)
        new[0] = True
        for name in ("run", "digest", "n_bytes", "check"):
            col = table.column(name).chunk(0)
            new[1:] |= ~np.asarray(pc.equal(col[1:], col[:-1]))
        first = np.flatnonzero(new)
        n = np.add.reduceat(np.asarray(table.column("n")), first)
        out = table.take(pa.array(first))
        out = out.set_column(out.schema.get_field_index("n"), schema.field("n"), pa.array(n, pa.int64()))
        held = out.slice(len(out) - 1)
        if len(out) > 1:
            yield from out.slice(0, len(out) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _sorted(runs: DataFrame) -> DataFrame:
    return runs.sortWithinPartitions("run", "digest", "n_bytes", "check", F.desc_nulls_last("keep_id"))


def merge_runs(rows: DataFrame) -> DataFrame:
    """(digest, n_bytes, check, keep_id, n), one row per distinct text."""
    runs = rows.select((F.spark_partition_id() % RUNS).alias("run"), "digest", "n_bytes", "check",
                       F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    runs = _sorted(runs).mapInArrow(_merge, _RUN)
    left = RUNS
    while left > 1:
        left = -(-left // FAN)
        runs = (runs.withColumn("run", F.expr(f"cast(run div {FAN} as int)"))
                .repartition("run", "digest"))
        runs = _sorted(runs).mapInArrow(_merge, _RUN)
    return runs.drop("run")


def copy_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(digests(docs), "digests")
    groups = merge_runs(rows).where("n > 1")
    keys = ["digest", "n_bytes", "check"]
    found = rows.join(groups, keys, "left")
    single = F.col("n").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no row with a larger id has; all columns.
    Rows that repeat id and text are folded after the join, which has already
    brought them together (no further exchange)."""
    names = docs.columns
    stays = (copy_report(docs).where("kept")
             .select(F.col("doc_id").alias("_lf_id"), F.col("text_sha256").alias("_lf_sha")).distinct())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tagged = docs.withColumns({"_lf_id": F.col("doc_id").cast("long"), "_lf_sha": F.sha2(text, 256)})
    mine, other = tagged.alias("m"), stays.alias("s")
    held = mine.join(other, F.col("m._lf_id").eqNullSafe(F.col("s._lf_id"))
                     & (F.col("m._lf_sha") == F.col("s._lf_sha"))).select("m.*")
    return held.dropDuplicates(["_lf_id", "_lf_sha"]).select(*names)
