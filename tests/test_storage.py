"""Month write-back (self-read, empty month) and the staged upsert."""
import datetime as dt

from pyspark.sql import functions as F

from lumenflow.plans import ingest
from lumenflow.sinks import storage

COLS = ("month_year", "pos_code", "revenue")
SCHEMA = "month_year string, pos_code string, revenue bigint"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "month_year string, pos_code string, revenue bigint")


def test_replace_month_while_reading_the_same_table(spark, scratch):
    root = scratch("lp")
    _rows(spark, [("2024-01", "a", 1), ("2024-02", "a", 2)]).write.partitionBy("month_year").parquet(root)
    table = storage.read_months(spark, root, SCHEMA)
    # next month computed from the table itself, written back into it
    nxt = table.where(F.col("month_year") == "2024-02").withColumn("month_year", F.lit("2024-03")) \
        .withColumn("revenue", F.col("revenue") + 1)
    assert storage.replace_month(nxt, root, "2024-03", COLS) == 1
    # re-running the month replaces, never appends
    assert storage.replace_month(nxt, root, "2024-03", COLS) == 1
    got = sorted(tuple(r) for r in storage.read_months(spark, root, SCHEMA).collect())
    assert got == [("2024-01", "a", 1), ("2024-02", "a", 2), ("2024-03", "a", 3)]


def test_empty_result_deletes_the_month(spark, scratch):
    root = scratch("lp")
    _rows(spark, [("2024-01", "a", 1), ("2024-02", "b", 2)]).write.partitionBy("month_year").parquet(root)
    empty = storage.read_months(spark, root, SCHEMA).where(F.lit(False))
    assert storage.replace_month(empty, root, "2024-02", COLS) == 0
    assert [r.month_year for r in storage.read_months(spark, root, SCHEMA).collect()] == ["2024-01"]


def test_rows_of_other_months_are_not_written(spark, scratch):
    root = scratch("lp")
    _rows(spark, [("2024-01", "a", 1)]).write.partitionBy("month_year").parquet(root)
    storage.replace_month(_rows(spark, [("2024-01", "x", 9), ("2024-02", "b", 2)]), root, "2024-02", COLS)
    got = sorted(tuple(r) for r in storage.read_months(spark, root, SCHEMA).collect())
    assert got == [("2024-01", "a", 1), ("2024-02", "b", 2)]


def test_month_table_from_nothing_and_emptied(spark, scratch):
    root = scratch("lp")
    assert storage.read_months(spark, root, SCHEMA).count() == 0
    assert storage.replace_month(_rows(spark, [("2024-01", "a", 1)]), root, "2024-01", COLS) == 1
    assert storage.replace_month(_rows(spark, []), root, "2024-01", COLS) == 0
    assert storage.read_months(spark, root, SCHEMA).collect() == []
    assert storage.replace_month(_rows(spark, [("2024-02", "b", 2)]), root, "2024-02", COLS) == 1
    assert [tuple(r) for r in storage.read_months(spark, root, SCHEMA).collect()] == [("2024-02", "b", 2)]


def _staging(spark, scratch, text):
    path = scratch("staging") + "/test.csv"
    spark.createDataFrame([(line,) for line in text.split("\n")], "value string") \
        .coalesce(1).write.text(path)
    return ingest.stage(spark, path)


def test_upsert_first_load_then_existing(spark, scratch):
    root = scratch("target")
    stamp = F.lit(dt.datetime(2024, 1, 1))
    first = _staging(spark, scratch, "id;name\n3;Ana\n4;Budi\n5;Cici\n6;Dedi")
    assert first.columns == ["id", "name"] and dict(first.dtypes)["id"] == "int"
    assert not ingest.table_exists(spark, root)
    ingest.upsert_bucketed(spark, first, root, etl_date=stamp)
    assert ingest.table_exists(spark, root)
    # duplicate key 5 and a null key: both inserted; key 4 replaced; 3 and 6 kept
    second = _staging(spark, scratch, "id;name\n4;Budi2\n5;Eka\n5;Eka2\n;Nokey")
    ingest.upsert_bucketed(spark, second, root, etl_date=F.lit(dt.datetime(2024, 2, 1)))
    got = sorted((r.id if r.id is not None else -1, r.name, r.etl_date.month)
                 for r in ingest.read_bucketed(spark, root).collect())
    assert got == [(-1, "Nokey", 2), (3, "Ana", 1), (4, "Budi2", 2), (5, "Eka", 2),
                   (5, "Eka2", 2), (6, "Dedi", 1)]


def test_null_target_keys_are_never_deleted(spark):
    target = spark.createDataFrame([(None, "t"), (1, "u")], "id int, name string")
    staging = spark.createDataFrame([(None, "s"), (1, "v")], "id int, name string")
    out = ingest.merge_staging(target, staging, "id", F.lit(None).cast("timestamp"))
    assert sorted((r.id or 0, r.name) for r in out.collect()) == [(0, "s"), (0, "t"), (1, "v")]


def test_versions_keep_the_previous_table_readable(spark, scratch):
    root = scratch("versions")
    storage.write_version(spark.range(3).toDF("id"), root)
    storage.write_version(spark.range(5).toDF("id"), root)
    first = storage.read_version(spark, root, 1)
    storage.write_version(spark.range(7).toDF("id"), root)
    assert storage.read_current(spark, root).count() == 7 and first.count() == 3
    assert storage.versions(spark, root) == [1, 2, 3]
    assert len(storage.vacuum(spark, root, keep=2)) == 1
    assert storage.versions(spark, root) == [2, 3]


def test_format_dispatch(spark, scratch):
    from lumenflow.sources.files import read_by_extension
    import pytest
    with pytest.raises(ValueError):
        read_by_extension(spark, "/data/trips.json")
    path = scratch("src") + "/x.parquet"
    spark.range(250_001).write.parquet(path)
    target, rows = ingest.bulk_load(spark, path, scratch("dst"))
    assert rows == 250_001
    parts = ingest.load_statistics(spark, target).collect()
    assert sum(r["rows"] for r in parts) == 250_001 and all(r["bytes"] > 0 for r in parts)


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, scratch):
    root = scratch("bucketed")
    target = spark.createDataFrame([(i, f"n{i}") for i in range(200)], "id bigint, name string")
    ingest.upsert_bucketed(spark, target, root, "id", buckets=8, etl_date=F.lit(dt.datetime(2024, 1, 1)))
    before = dict(ingest.read_manifest(spark, root).folders)
    old = ingest.read_bucketed(spark, root)
    staging = _staging(spark, scratch, "id;name\n5;five\n5;five-again\n;nokey\n999;new")
    touched = ingest.upsert_bucketed(spark, staging, root, etl_date=F.lit(dt.datetime(2024, 2, 1)))
    assert 1 <= len(touched) <= 2
    after = dict(ingest.read_manifest(spark, root).folders)
    assert all((before[b] == after[b]) == (b not in touched) for b in range(8))
    rows = ingest.read_bucketed(spark, root).collect()
    assert len(rows) == 200 - 1 + 4 and old.count() == 200
    assert sorted(r.name for r in rows if r.id == 5) == ["five", "five-again"]
    assert any(r.id is None for r in rows) and any(r.id == 999 for r in rows)


def test_upsert_with_another_key_type_loses_nothing(spark, scratch):
    root = scratch("typed")
    target = spark.createDataFrame([(float(i), "t") for i in range(200)], "id double, name string")
    ingest.upsert_bucketed(spark, target, root, "id", buckets=16)
    staging = spark.createDataFrame([(i, "s") for i in range(5)], "id int, name string")
    ingest.upsert_bucketed(spark, staging, root)
    rows = ingest.read_bucketed(spark, root).collect()
    assert len(rows) == 200 and len({r.id for r in rows}) == 200
    assert sorted(r.id for r in rows if r.name == "s") == [0, 1, 2, 3, 4]


def test_the_bucket_count_belongs_to_the_table(spark, scratch):
    import pytest
    root = scratch("counted")
    target = spark.createDataFrame([(i, "t") for i in range(20)], "id bigint, name string")
    staging = spark.createDataFrame([(i, "s") for i in range(5)], "id bigint, name string")
    ingest.upsert_bucketed(spark, target, root, "id", buckets=4)
    with pytest.raises(ValueError):
        ingest.upsert_bucketed(spark, staging, root, "id", buckets=8)
    with pytest.raises(ValueError):
        ingest.upsert_bucketed(spark, staging, root, "name")
    ingest.upsert_bucketed(spark, staging, root)
    assert ingest.read_bucketed(spark, root).count() == 20
    ingest.rebucket(spark, root, 8)
    ingest.upsert_bucketed(spark, staging, root, buckets=8)
    assert ingest.read_bucketed(spark, root).count() == 20


def test_a_failed_upsert_leaves_the_table(spark, scratch, monkeypatch):
    import pytest
    root = scratch("failed")
    target = spark.createDataFrame([(i, "t") for i in range(20)], "id bigint, name string")
    ingest.upsert_bucketed(spark, target, root, "id", buckets=4)

    def no(*_):
        raise RuntimeError("stopped before the commit")
    with monkeypatch.context() as m:
        m.setattr(ingest, "_commit", no)
        with pytest.raises(RuntimeError):
            ingest.upsert_bucketed(spark, spark.createDataFrame([(1, "s")], "id bigint, name string"), root)
    assert {r.name for r in ingest.read_bucketed(spark, root).collect()} == {"t"}
    assert len(ingest.vacuum(spark, root)) == 1          # the orphaned folder
    assert ingest.read_bucketed(spark, root).count() == 20


def test_rows_without_a_key_are_only_added(spark, scratch):
    root = scratch("nokey")
    ingest.upsert_bucketed(spark, spark.createDataFrame([(None, "a"), (1, "b")], "id int, name string"), root, "id")
    first = [p for b, p in ingest.read_manifest(spark, root).folders if b == ingest.NO_KEY]
    ingest.upsert_bucketed(spark, spark.createDataFrame([(None, "c")], "id int, name string"), root)
    ingest.upsert_bucketed(spark, spark.createDataFrame([(1, "d")], "id int, name string"), root)
    manifest = ingest.read_manifest(spark, root)
    assert set(first) < {p for b, p in manifest.folders if b == ingest.NO_KEY}
    assert sorted(r.name for r in ingest.read_bucketed(spark, root).collect()) == ["a", "c", "d"]


def test_seed_is_read_as_text(spark, scratch):
    from lumenflow.sources import files
    path = scratch("seed") + "/filter_month.csv"
    spark.createDataFrame([("month_year",), ("2023-10",), ("2023-11",), ("2023-12",)], "value string") \
        .coalesce(1).write.text(path)
    seed = files.read_seed(spark, path)
    assert dict(seed.dtypes) == {"month_year": "string"}
    assert sorted(r.month_year for r in seed.collect()) == ["2023-10", "2023-11", "2023-12"]


def test_one_of_two_writers_gets_the_next_version(spark, scratch):
    import pytest
    root = scratch("raced")
    assert storage.write_version(spark.range(1), root, 0) == 1
    assert storage.write_version(spark.range(2), root, 1) == 2
    for stale in (0, 1):
        with pytest.raises(storage.ConflictError):
            storage.write_version(spark.range(9), root, stale)
    assert storage.read_current(spark, root).count() == 2
    storage.vacuum(spark, root, 1)
    with pytest.raises(storage.ConflictError):                     # its number is free again, but it is stale
        storage.write_version(spark.range(9), root, 0)
    assert storage.write_version(spark.range(3), root) == 3


def test_many_writers_at_once_lose_nothing(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    path = scratch("claims") + "/_commits/v=00000001"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage._claim(spark, path, f"writer-{i}"), range(32)))
    assert sum(won) == 1
    assert storage.committed_text(spark, path.split("/_commits")[0], 1) == f"writer-{won.index(True)}"


def test_a_version_without_its_name_is_not_read(spark, scratch):
    import pytest
    root = scratch("doubt")
    storage.write_version(spark.range(2), root)
    assert storage._claim(spark, storage._commit_file(root, 2), "")         # its writer died here
    assert storage.read_current(spark, root).count() == 2
    with pytest.raises(storage.ConflictError):
        storage.write_version(spark.range(3), root, 1)
    with pytest.raises(ValueError):
        storage.abandon(spark, root, 1)
    storage.abandon(spark, root, 2)
    assert storage.write_version(spark.range(3), root, 1) == 2


def _interleaved(spark, root, monkeypatch, upsert, mine, others):
    """``mine`` is upserted, and each of ``others`` between its read and its commit."""
    real, waiting = ingest._commit, list(others)

    def commit(spark_, table_root, manifest):
        if waiting:
            rows = waiting.pop(0)
            with monkeypatch.context() as m:
                m.setattr(ingest, "_commit", real)
                upsert(spark_, rows, table_root)
        return real(spark_, table_root, manifest)

    with monkeypatch.context() as m:
        m.setattr(ingest, "_commit", commit)
        upsert(spark, mine, root)


def _people(spark, ids, name):
    return spark.createDataFrame([(i, f"{name}{i}") for i in ids], "id bigint, name string")


def test_interleaved_upserts_keep_all_rows(spark, scratch, monkeypatch):
    for upsert in (ingest.upsert_bucketed, ingest.upsert_by_positions):
        root = scratch("interleaved")
        upsert(spark, _people(spark, range(40), "t"), root, "id", 4)
        # the same keys, other keys of the same buckets, and rows without a key
        _interleaved(spark, root, monkeypatch, upsert, _people(spark, [1, 2, 100], "a"),
                     [_people(spark, [2, 3, 200], "b"), _people(spark, [None, 300], "c")])
        rows = {(r.id, r.name) for r in ingest.read_bucketed(spark, root).collect()}
        assert {(1, "a1"), (2, "a2"), (3, "b3"), (100, "a100"), (200, "b200"), (300, "c300"), (None, "cNone")} <= rows
        assert len(rows) == 40 + 4 and ingest.read_bucketed(spark, root).count() == 44


def test_untouched_buckets_need_only_a_new_manifest(spark, scratch, monkeypatch):
    root = scratch("rebased")
    ingest.upsert_bucketed(spark, _people(spark, range(40), "t"), root, "id", 4)
    bucket = {r.id: r.b for r in spark.range(100).withColumn("b", ingest.key_bucket("id", 4)).collect()}
    one, two = ([i for i in range(40) if bucket[i] == b][:2] for b in (0, 3))
    writes, real = [], ingest._write_buckets
    monkeypatch.setattr(ingest, "_write_buckets", lambda *a: writes.append(1) or real(*a))
    _interleaved(spark, root, monkeypatch, ingest.upsert_bucketed, _people(spark, one, "a"), [_people(spark, two, "b")])
    assert len(writes) == 2                                        # neither was done again
    names = {r.id: r.name[0] for r in ingest.read_bucketed(spark, root).collect()}
    assert all(names[i] == ("a" if i in one else "b" if i in two else "t") for i in range(40))


def test_two_first_loads(spark, scratch, monkeypatch):
    root = scratch("firsts")
    _interleaved(spark, root, monkeypatch, ingest.upsert_bucketed, _people(spark, [1, 2], "a"), [_people(spark, [2, 3], "b")])
    assert sorted((r.id, r.name) for r in ingest.read_bucketed(spark, root).collect()) == [(1, "a1"), (2, "a2"), (3, "b3")]


def test_merge_on_read_equals_copy_on_write(spark, scratch):
    import random
    rng = random.Random(4)
    roots = scratch("cow"), scratch("mor")
    stamp = F.lit(dt.datetime(2024, 1, 1))
    loads = [_people(spark, range(300), "t")] + [
        _people(spark, [rng.choice([None, rng.randrange(400)]) for _ in range(n)], f"s{n}-") for n in (1, 30, 5, 80)]
    for k, rows in enumerate(loads):
        ingest.upsert_bucketed(spark, rows, roots[0], "id", 4, stamp)
        ingest.upsert_by_positions(spark, rows, roots[1], "id", 4, stamp)
        got = [sorted((tuple(r) for r in ingest.read_bucketed(spark, root).collect()), key=repr) for root in roots]
        assert got[0] == got[1], k
    m = ingest.read_manifest(spark, roots[1])
    assert m.gone and len({b for b, _ in m.gone}) == len(m.gone)
    # both ways on one table, then compaction and vacuum
    one = _people(spark, [5], "z")
    for root in roots:
        ingest.upsert_bucketed(spark, one, root, etl_date=stamp)
    assert ingest.compact(spark, roots[1], share=0.01, folders=99)
    assert not ingest.read_manifest(spark, roots[1]).gone
    ingest.vacuum(spark, roots[1])
    got = [sorted((tuple(r) for r in ingest.read_bucketed(spark, root).collect()), key=repr) for root in roots]
    assert got[0] == got[1]


def test_merge_on_read_writes_what_the_staging_holds(spark, scratch):
    root = scratch("small")
    ingest.upsert_by_positions(spark, _people(spark, range(50_000), "a long enough name to weigh something "), root, "id", 4)
    before = set(ingest.read_manifest(spark, root).paths())
    ingest.upsert_by_positions(spark, _people(spark, range(0, 400, 4), "new"), root)
    m = ingest.read_manifest(spark, root)
    assert before < set(m.paths())                                 # nothing was rewritten
    added = spark.read.schema(m.columns).parquet(*sorted(set(m.paths()) - before))
    assert added.count() == 100
    vectors = spark.read.schema(ingest._VECTOR).parquet(*[p for _, p in m.gone])
    assert vectors.selectExpr("sum(aggregate(words, 0L, (n, w) -> n + bit_count(w)))").first()[0] == 100
    assert ingest.read_bucketed(spark, root).count() == 50_000
    assert ingest.compact(spark, root) == []                       # few are deleted


def test_rebucket_refuses_a_table_that_moved_on(spark, scratch, monkeypatch):
    import pytest
    root = scratch("refused")
    ingest.upsert_by_positions(spark, _people(spark, range(20), "t"), root, "id", 2)
    real = ingest._write_buckets

    def late(*a):
        monkeypatch.setattr(ingest, "_write_buckets", real)
        ingest.upsert_by_positions(spark, _people(spark, [3, 77], "late"), root)
        return real(*a)

    monkeypatch.setattr(ingest, "_write_buckets", late)
    with pytest.raises(storage.ConflictError):
        ingest.rebucket(spark, root, 3)
    assert ingest.read_bucketed(spark, root).count() == 21
    ingest.rebucket(spark, root, 3)
    assert ingest.read_bucketed(spark, root).count() == 21 and ingest.read_manifest(spark, root).buckets == 3
