import hashlib
import os
import re
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import fim  # noqa: E402

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def expected(doc_id, text):
    """The contract, by joining segments."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="aB <>PSM\né漢\U0001F600\x00", max_size=40))
def test_round_trip_and_contract(doc_id, text):
    got = fim.transform(text.encode(), doc_id)
    assert (got.n, got.form, got.prefix_chars, got.middle_chars, got.output.decode()) == expected(doc_id, text)
    assert fim.restore(got.output, got.form) == text.encode()


@given(st.binary(max_size=30), st.data())
def test_rotation_exchanges_blocks(raw, data):
    a, b, c = sorted(data.draw(st.integers(0, len(raw))) for _ in range(3))
    buffer = bytearray(raw)
    fim.rotate(buffer, a, b, c)
    assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def all_rows():
    rows = cases.texts() + [(30 + i, t) for i, t in enumerate(("<P>", "a<S>b", "x <M", "<", ">", "<P", "tail <"))]
    return rows + [(1000 + i, cases.prose(i, 30) + " é漢<" * (i % 3)) for i in range(200)]


def test_report_equals_brute_force(spark):
    rows = all_rows()
    want = []
    for i, t in rows:
        n, form, p, m, out = expected(i, t)
        want.append((i, n, form, p, m, sha(out), sha(t or "")))
    got = cases.rows_of(fim.fim_report(cases.docs(spark, rows)))
    assert got == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_texts_keep_columns_and_come_back(spark):
    df = cases.docs(spark, all_rows()).selectExpr("*", "'old' AS form", "'old' AS restored")
    filled = fim.fim_texts(df)
    assert filled.columns == [c for c in df.columns if c != "form"] + ["form", "fim"]
    back = fim.restored_texts(filled)
    rows = back.collect()
    assert len(rows) == df.count() and all(r["restored"] == (r["text"] or "") and r["spans"] == "clash" for r in rows)
    for r in rows:
        assert r["fim"] == expected(r["doc_id"], r["text"])[4]


@pytest.mark.parametrize("size", [1_000_000])
def test_long_texts(size):
    for text in ("a" * size, "漢" * (size // 3), "ab " * (size // 3)):
        for doc_id in range(4):
            got = fim.transform(text.encode(), doc_id)
            assert fim.restore(got.output, got.form) == text.encode()
            assert got.n == len(UNIT.findall(text))


def test_empty_table(spark):
    assert fim.fim_report(cases.docs(spark, [])).collect() == []
    assert fim.fim_texts(cases.docs(spark, [])).collect() == []
