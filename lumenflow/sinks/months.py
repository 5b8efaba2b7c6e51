"""A month table whose months are written, audited and then published.

A write stages its months in a folder of its own.  Audits read the staged rows; each gives
the rows that break a rule.  Only if none does, the months are published: the next
version of a manifest (month, folder), one compare and set for all months of the write.  A
failed audit, or a failed job, leaves the table as it was, and its readers never see a
month half replaced.

Two writers of different months both get in: the later one puts its months on the
newer manifest.  A writer whose own month was replaced meanwhile is refused
(``storage.ConflictError``), as its rows were made from the older one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.sinks import storage

MONTH = "month_year"
Audit = Callable[[DataFrame], DataFrame]


class AuditError(RuntimeError):
    """Staged months that broke rules: ``broken`` counts the rows of each, ``staged`` is
    the folder, left for a look at them."""

    def __init__(self, broken: dict[str, int], staged: str) -> None:
        super().__init__(f"not published: {broken} (staged in {staged})")
        self.broken, self.staged = broken, staged


# ---- audits ------------------------------------------------------------------------

def unique(key: Column) -> Audit:
    """Values of ``key`` seen more than once (null is a value here)."""
    return lambda df: df.groupBy(key.alias("unique_field")).count().where("count > 1")


def not_null(*columns: str) -> Audit:
    def rows(df: DataFrame) -> DataFrame:
        missing = F.lit(False)
        for c in columns:
            missing = missing | F.col(c).isNull()
        return df.where(missing)
    return rows


def accepted_values(column: str, values: Iterable[str]) -> Audit:
    known = list(values)
    return lambda df: df.where(F.col(column).isNotNull() & ~F.col(column).isin(known))


# ---- the table ---------------------------------------------------------------------

def _manifest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """(version, month -> folder): a row a month."""
    n = storage.current_number(spark, f"{root}/manifest")
    rows = storage.read_version(spark, f"{root}/manifest", n).collect() if n else []
    return n, {r["month"]: r["folder"] for r in rows}


def _commit(spark: SparkSession, root: str, after: int, months: Mapping[str, str]) -> None:
    storage.write_version(spark.createDataFrame(sorted(months.items()), "month string, folder string").coalesce(1),
                          f"{root}/manifest", after)


def read(spark: SparkSession, root: str, schema: str, months: Iterable[str] | None = None) -> DataFrame:
    """The published months, or some of them, with the declared columns.  Only the
    folders of the wanted months are opened."""
    _, held = _manifest(spark, root)
    wanted = sorted(held) if months is None else sorted(set(months) & held.keys())
    empty = spark.createDataFrame([], schema)
    if not wanted:
        return empty
    # one base path a write, as a folder may hold several months
    out = None
    by_write: dict[str, list[str]] = {}
    for m in wanted:
        by_write.setdefault(held[m], []).append(f"{held[m]}/{MONTH}={m}")
    for base, paths in by_write.items():
        part = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*empty.columns)
        out = part if out is None else out.unionByName(part)
    return out


def publish(df: DataFrame, root: str, months: Iterable[str], audits: Mapping[str, Audit] | None = None) -> dict[str, int]:
    """Replace ``months`` of the table by the rows of ``df`` (rows of other months are not
    written; a month without rows is removed).  Returns the rows of each.  Raises
    ``AuditError`` and changes nothing if an audit finds any."""
    spark = df.sparkSession
    months = sorted(set(months))
    version, before = _manifest(spark, root)
    staged = f"{root}/data/{storage.fresh_folder('months')}"
    df.where(F.col(MONTH).isin(months)).write.partitionBy(MONTH).parquet(staged)
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    rows = spark.read.schema(schema).parquet(staged)
    broken = {name: n for name, audit in (audits or {}).items() if (n := audit(rows).count())}
    if broken:
        raise AuditError(broken, staged)
    # a row a month
    counts = {r[MONTH]: r["n"] for r in rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).collect()}
    while True:
        version_now, held = _manifest(spark, root)
        if {m: held.get(m) for m in months} != {m: before.get(m) for m in months}:
            raise storage.ConflictError(f"months of {months} were replaced since version {version}")
        kept = {m: f for m, f in held.items() if m not in months}
        try:
            _commit(spark, root, version_now, kept | {m: staged for m in months if counts.get(m)})
            return {m: counts.get(m, 0) for m in months}
        except storage.ConflictError:
            continue


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` manifests and the staged folders that none of
    those names, failed audits' with them (explicit: see ``storage.vacuum``)."""
    storage.vacuum(spark, f"{root}/manifest", keep)
    named = {r["folder"].rsplit("/", 1)[-1] for n in storage.versions(spark, f"{root}/manifest")
             for r in storage.read_version(spark, f"{root}/manifest", n).collect()}
    fs, p = storage._fs(spark, f"{root}/data")
    gone = [st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName() not in named]
    for path in gone:
        storage.delete(spark, path)
    return gone
