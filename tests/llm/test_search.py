import collections
import math
import os
import random
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import lexical_search  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def expected(docs, queries, k=20):
    """All scores of all documents, sorted."""
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(queries):
        found = []
        for doc_id, c in counts:
            n = sum(c.values())
            m = 75 + (25 * n * n_docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:k])]
    return sorted(out, key=repr)


def queries_df(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "item_id long, text string, term string, rank int")


def run(spark, docs, queries, k=20, parts=3):
    index = lexical_search.build_index(cases.docs(spark, docs).repartition(parts))
    got = lexical_search.search(index, queries_df(spark, queries), k)
    assert got.columns == ["item_id", "qkey", "rank", "doc_id", "score"]
    return cases.rows_of(got.drop("qkey"))


QUERIES = [(1, "one Two one"), (2, None), (3, ""), (4, "absent-everywhere"), (5, cases.prose(1, 60)), (6, cases.prose(3, 30)),
           (6, cases.prose(8, 30)), (None, "w1 w2 w3"), (7, "same"), (7, "same"), (8, "漢字\U0001F600 É é ß"), (9, "A.b,C! w5_w6")]


def test_search_equals_brute_force(spark):
    assert run(spark, cases.texts(), QUERIES) == expected(cases.texts(), QUERIES)


@pytest.mark.parametrize("shard", [1, 3000, 1 << 20])
def test_strata_shards_and_batches(spark, monkeypatch, shard):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(lexical_search, "VISIT_BYTES", 20_000)
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    monkeypatch.setattr(lexical_search, "ROWS", 3)
    monkeypatch.setattr(lexical_search, "BATCH_TERMS", 150)
    rng = random.Random(shard)
    docs = [(i, cases.prose(i, rng.choice([5, 20, 20, 21, 80, 300]), 150)) for i in range(300)]
    docs += [(1000 + i, cases.prose(7, 20, 150)) for i in range(60)]           # equal scores
    queries = [(i, cases.prose(5000 + i, rng.randrange(1, 40), 160)) for i in range(25)] + [(99, cases.prose(7, 20, 150))]
    assert run(spark, docs, queries, 7, 5) == expected(docs, queries, 7)


def test_a_stratum_is_passed_over(spark, monkeypatch):
    """Bounds decide what is scored, and scoring less changes nothing."""
    scored = []
    real = lexical_search._Stratum.scores

    def counted(self, block, visitors):
        scored.append(len(visitors))
        return real(self, block, visitors)

    docs = [(i, cases.prose(i, 30 + i % 40, 4000)) for i in range(400)]
    queries = [(i, docs[i][1]) for i in range(0, 400, 50)]
    index = lexical_search.build_index(cases.docs(spark, docs).coalesce(1))
    monkeypatch.setattr(lexical_search._Stratum, "scores", counted)
    rows = [tuple(r) for r in lexical_search.query_terms(queries_df(spark, queries)).join(index.dictionary, "term").select(
        "item_id", "qkey", "term", "times", "df").collect()]
    block, = lexical_search._blocks(rows, index.n_docs)
    kinds = ("int64", bool, "uint64", "uint32", "uint32", "uint32")
    import numpy as np
    strata = [(m, *(np.frombuffer(x, t) for x, t in zip(rest, kinds))) for m, *rest in map(tuple, index.strata.collect())]
    best = lexical_search._Best(len(block.keys), 1)
    lexical_search._visit(strata, block, best)
    assert sum(scored) < len(strata) * len(queries) / 2
    assert [int(f[2][0]) for f in best.found] == [k[0] for k in block.keys]


def test_integers_where_doubles_are_too_short(spark):
    text = "alpha beta " * 300_000
    docs = [(i, "alpha " * (i + 1) + f"u{i}") for i in range(40)] + [(90, "beta gamma")]
    assert run(spark, docs, [(1, text)]) == expected(docs, [(1, text)])


def test_every_document_is_in_the_index(spark):
    index = lexical_search.build_index(cases.docs(spark))
    ids = sum(len(r["null_ids"]) for r in index.strata.collect())
    assert ids == len(cases.texts())


def test_empty_tables(spark):
    assert run(spark, [], QUERIES) == [] and run(spark, cases.texts(), []) == []
    assert run(spark, [(1, None), (2, "")], QUERIES) == []
