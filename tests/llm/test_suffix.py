import hashlib
import os
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import suffix_dedup  # noqa: E402


def expected(rows):
    """Every window of every text, and the place it first starts at.  Rows that
    repeat id and text are one place (no test has one id with texts that share)."""
    size = suffix_dedup.WINDOW
    texts = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i, k: (i is None, i or 0, k)         # noqa: E731
    first = {}
    for i, t in texts:
        for k in range(len(t) - size + 1):
            at = first.setdefault(t[k:k + size], order(i, k))
            first[t[k:k + size]] = min(at, order(i, k))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - size + 1):
            if first[t[k:k + size]] < order(i, k):
                gone[k:k + size] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int(np.count_nonzero(gone[:-1] & ~np.roll(gone, 1)[:-1])) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shared_rows(seed, n=60):
    """Texts that share passages, some with a letter changed, in other places."""
    rng, rows = random.Random(seed), []
    passages = [cases.prose(900 + i, 60) for i in range(6)]
    line = cases.prose(990, 30)
    for i in range(n):
        parts = [cases.prose(rng.random(), rng.randrange(5, 40))]
        for _ in range(rng.randrange(3)):
            p = list(passages[rng.randrange(6)])
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "#"
            a = rng.randrange(100)
            parts += ["".join(p[a:a + rng.randrange(90, 220)]), cases.prose(rng.random(), 10)]
        parts.append(line + f" é漢{rng.randrange(3)}")
        rows.append((100 + i, " ".join(parts)))
    return rows


def test_report_equals_brute_force(spark):
    rows = cases.texts() + shared_rows(5) + [(400, "a" * 5000), (401, "ab" * 300), (402, "a" * 99), (403, "a" * 100), (404, "b" + "a" * 100)]
    assert cases.rows_of(suffix_dedup.repeat_report(cases.docs(spark, rows).repartition(5))) == expected(rows)


@pytest.mark.parametrize("group, shard, part", [(2, 3, 150), (5, 20, 1 << 20), (16, 100, 700)])
def test_hot_groups_in_rounds(spark, monkeypatch, group, shard, part):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    base = cases.prose(50, 60)
    rows = shared_rows(group, 40) + [(1000 + i, cases.edited(base, i, 2)) for i in range(40)] + [(2000 + i, base) for i in range(30)]
    assert cases.rows_of(suffix_dedup.repeat_report(cases.docs(spark, rows).repartition(3))) == expected(rows)


def test_repeated_rows_are_one_place(spark):
    text = cases.prose(1, 100)
    rows = [(5, text), (5, text), (4, None), (None, text), (None, text), (7, text)]
    assert cases.rows_of(suffix_dedup.repeat_report(cases.docs(spark, rows))) == expected(rows)


def test_removed_from_texts(spark):
    df = cases.docs(spark)
    got = suffix_dedup.remove_repeats(df)
    assert got.columns == df.columns
    by_id = {(r["doc_id"], r["lang"]): r for r in got.collect()}
    rows = {(r["doc_id"], r["lang"]): r for r in df.collect()}
    assert len(by_id) == len(rows) and all(r["spans"] == "clash" for r in by_id.values())
    texts = {k[0]: r["text"] for k, r in by_id.items()}
    assert texts[1] is None and texts[6] == cases.prose(1, 300) and texts[7] == "" and texts[4] == "one two"


def test_empty_table(spark):
    assert suffix_dedup.repeat_report(cases.docs(spark, [])).collect() == []
    assert len(suffix_dedup.repeat_report(cases.docs(spark, [(1, None), (2, "")])).collect()) == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(c % 3 for c in b)), min_size=1, max_size=30))
def test_blind_trie_sorts(texts):
    assert [texts[i] for i in suffix_dedup.blind_trie(texts)] == sorted(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=60).map(lambda b: bytes(c % 2 for c in b))), min_size=1, max_size=40))
def test_suffix_array_of_groups(items):
    items.sort(key=lambda x: x[0])
    texts = [t for _, t in items]
    group = np.unique([g for g, _ in items], return_inverse=True)[1]
    blob = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    strings = suffix_dedup._Strings(blob, np.cumsum(length) - length, length)
    order, common = suffix_dedup.suffix_array(strings, group)
    assert [(int(group[i]), texts[i]) for i in order] == sorted(zip(group.tolist(), texts))
    for k, (i, c) in enumerate(zip(order, common)):
        if k == 0 or group[order[k - 1]] != group[i]:
            assert c == -1
        else:
            assert c == len(os.path.commonprefix([texts[order[k - 1]], texts[i]]))


def test_sampling_covers_every_window():
    rng = random.Random(2)
    texts = [bytes(rng.randrange(97, 100) for _ in range(rng.randrange(0, 400))) for _ in range(30)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, start, n, p, anchor, _ = suffix_dedup.passages(raw, offs)
    seen = {}
    for t, s, k, q, a in zip(text, start, n, p, anchor):
        for w in range(k):
            d = int(q) - w
            assert 0 <= d <= suffix_dedup.WINDOW - suffix_dedup.GRAM
            content = raw[s + w:s + w + suffix_dedup.WINDOW].tobytes()
            assert s + w + suffix_dedup.WINDOW <= offs[t + 1]
            assert seen.setdefault(content, (d, a)) == (d, a)
    assert sum(n) == sum(max(0, len(t) - suffix_dedup.WINDOW + 1) for t in texts)
