import collections
import hashlib
import math
import random
import sys
import os

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import exact_dedup, near_dedup, substring_dedup  # noqa: E402


# ---- exact -----------------------------------------------------------------

def exact_expected(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_report_equals_brute_force(spark):
    got = cases.rows_of(exact_dedup.copy_report(cases.docs(spark)))
    assert got == exact_expected(cases.texts())


def test_exact_many_runs_and_a_hot_group(spark):
    rng = random.Random(0)
    rows = [(i, "hot" if i % 3 == 0 else f"t{rng.randrange(300)}") for i in range(3000)]
    df = cases.docs(spark, rows).repartition(37)
    assert cases.rows_of(exact_dedup.copy_report(df)) == exact_expected(rows)


def test_exact_drop_keeps_columns_and_one_row_of_each_text(spark):
    df = cases.docs(spark)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert sorted(r["text"] or "" for r in got) == sorted({t or "" for _, t in cases.texts()})
    want = {t: k for _, k, _, _, t in exact_expected(cases.texts())}
    assert all(r["doc_id"] == want[hashlib.sha256((r["text"] or "").encode()).hexdigest()] for r in got)


def test_exact_empty_table(spark):
    assert exact_dedup.copy_report(cases.docs(spark, [])).collect() == []
    assert exact_dedup.drop_copies(cases.docs(spark, [])).collect() == []


# ---- near ------------------------------------------------------------------

def shingles(text):
    w = cases.words(text)
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def near_expected(rows, threshold=0.8):
    """(id, class, size) by comparing all pairs with exact statistics."""
    sets = [shingles(t) for _, t in rows]
    df = collections.Counter(s for c in sets for s in c)
    scale = {s: 1 + math.log(min(1 / near_dedup.COMMON, len(rows) / n)) / math.log(1 / near_dedup.COMMON) for s, n in df.items()}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = sum(min(sets[i][s], sets[j][s]) * scale[s] for s in sets[i].keys() & sets[j].keys())
                total = sum(n * scale[s] for c in (sets[i], sets[j]) for s, n in c.items())
                if both / (total - both) >= threshold - 1e-9:
                    root[find(i)] = find(j)
    classes = collections.defaultdict(list)
    for i in range(len(rows)):
        classes[find(i)].append(rows[i][0])
    out = []
    for i in range(len(rows)):
        ids = classes[find(i)]
        out.append((rows[i][0], min((x for x in ids if x is not None), default=None), len(ids)))
    return sorted(out, key=repr)


def test_near_classes_equal_brute_force(spark):
    got = near_dedup.near_classes(cases.docs(spark)).drop("kept")
    assert cases.rows_of(got) == near_expected(cases.texts())


def test_near_large_family_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = cases.prose(20, 200)
    rows = [(i, cases.edited(base, i, 4 + i % 9)) for i in range(60)] + [(100 + i, cases.prose(100 + i, 150)) for i in range(40)]
    got = near_dedup.near_classes(cases.docs(spark, rows)).drop("kept")
    assert cases.rows_of(got) == near_expected(rows)


def test_near_drop_keeps_one_of_each_class(spark):
    df = cases.docs(spark)
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 6 in ids and 7 not in ids and 8 not in ids and 9 in ids and 4 in ids and 5 not in ids
    assert ids.count(13) == 2 and {1, 2, 3} <= set(ids)


def test_near_empty_table(spark):
    assert near_dedup.near_classes(cases.docs(spark, [])).collect() == []
    assert near_dedup.drop_near_copies(cases.docs(spark, [(1, None), (2, "")])).count() == 2


def test_samples_agree_as_often_as_the_weights():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    w1 = rng.integers(1, 5, 60)
    w2 = np.maximum(0, w1 + rng.integers(-2, 3, 60))
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    same = total = 0
    for k in range(30):
        t = near_dedup.mix(s + np.uint64(k * 7919))
        some = w2 > 0
        for j in range(0, 100, 2):
            a = near_dedup.sample(t, np.log(w1), np.array([0, 60]), j)[0]
            b = near_dedup.sample(t[some], np.log(w2[some]), np.array([0, some.sum()]), j)[0]
            same, total = same + (a == b), total + 1
    assert abs(same / total - want) < 0.05


def test_block_similarity_equals_counters():
    texts = [cases.prose(i, n, 12) for i, n in enumerate((40, 60, 3, 80))]
    none = (np.empty(0, np.uint64), np.empty(0))
    import pyarrow as pa
    got = near_dedup.block_similarity(list(near_dedup.word_hashes(pa.array(texts))), none)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = shingles(a), shingles(b)
            assert got[i, j] == pytest.approx(sum((x & y).values()) / sum((x | y).values()))


# ---- substrings ------------------------------------------------------------

def repeats_expected(rows):
    size = substring_dedup.WINDOW
    lists = [cases.words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, lists):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("wide", [4000, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(substring_dedup, "WIDE", wide)      # 1: windows are counted by hash
    rng, rows = random.Random(5), cases.texts()
    passages = [cases.prose(900 + i, 60) for i in range(6)]
    for i in range(40):
        parts = [cases.prose(1000 + i, rng.randrange(5, 40))]
        for _ in range(rng.randrange(3)):
            p = passages[rng.randrange(6)].split(" ")
            a = rng.randrange(20)
            parts += [" ".join(p[a:a + rng.randrange(30, 45)]), cases.prose(rng.random(), 10)]
        rows.append((100 + i, " ".join(parts)))
    assert cases.rows_of(substring_dedup.repeat_report(cases.docs(spark, rows).repartition(5))) == repeats_expected(rows)


def test_counted_blocks_have_no_small_rest(monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    texts = [cases.prose(i, 40) for i in range(101)] + ["a b c d e f"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 4])], names=["text"]) for i in range(0, len(texts), 4)]
    found = list(near_dedup._counted(batches))
    assert len(found) > 2 and sum(n for n, _, _ in found) == len(texts)
    whole = collections.Counter()
    for n, keys, count in found:
        assert n >= found[0][0] // 2 and len(set(keys.tolist())) == len(keys)
        whole.update(dict(zip(keys.tolist(), count.tolist())))
    words = [list(near_dedup._slices([b])) for b in batches]
    one = collections.Counter()
    for (_, w, first, _), in words:
        one.update(near_dedup._distinct(*near_dedup.shingle_hashes(w, first))[0].tolist())
    assert whole == one


def test_repeats_removed_from_texts(spark):
    df = cases.docs(spark)
    got = substring_dedup.remove_repeats(df)
    assert got.columns == df.columns
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    assert by_id[1] is None and by_id[6] == "" and by_id[11] == "" and by_id[4] == "one two" and by_id[17] == cases.prose(14, 34)
    assert cases.words(by_id[12]) == (cases.prose(8, 20) + " " + cases.prose(9, 50)).split(" ")


def test_repeats_empty_table(spark):
    assert substring_dedup.repeat_report(cases.docs(spark, [])).collect() == []


def test_automaton_statistics():
    rng = random.Random(1)
    for _ in range(30):
        seqs = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(3)]
        a = substring_dedup.SuffixAutomaton()
        for s in seqs:
            a.add(s, 1)
        a.finish()
        subs = collections.Counter(tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1))
        for s in seqs:
            want = [max((n for n in range(1, k + 2) if subs[tuple(s[k + 1 - n:k + 1])] > 1), default=0) for k in range(len(s))]
            assert a.statistics(s).tolist() == want
