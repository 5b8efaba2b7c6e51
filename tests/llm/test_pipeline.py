import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import cases  # noqa: E402

import corpus_pipeline  # noqa: E402
from lumenflow.llm import exact_dedup, mixing, near_dedup, packing  # noqa: E402
from lumenflow.llm.oracle import SQL  # noqa: E402
from lumenflow.llm.queries import QUERIES, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    """Every stage against its operator's own report on the same input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == first, name
        rows = out.collect()
        if name == "toxicity":
            ids = {r["doc_id"] for r in rows}
            labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
            clean = [r["doc_id"] in ids for r in labels if r["toxic"] == 0 and r["quality"] == 1]
            assert sum(clean) / len(clean) > 0.95
        if name == "exact_dedup":
            want = [r["doc_id"] for r in exact_dedup.copy_report(docs).where("kept").collect()]
            assert sorted(r["doc_id"] for r in rows) == sorted(want)
        if name == "near_dedup":
            want = [r["doc_id"] for r in near_dedup.near_classes(docs).where("kept").collect()]
            assert sorted(r["doc_id"] for r in rows) == sorted(want)
        if name == "mixing":
            want = [r["doc_id"] for r in mixing.mix_report(docs).collect()]
            assert sorted(r["doc_id"] for r in rows) == sorted(want)
        docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    pieces = packing.token_pieces(docs, tokenizer_path()).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert cases.rows_of(got.select(*pieces.columns)) == cases.rows_of(pieces)


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert got and len({r["sequence_id"] for r in got}) < len(got)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    assert sorted(con.sql(SQL[name]).columns) == cols
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    text = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)     # noqa: E731
    assert text(got.select(*cols).collect()) == text(want)
