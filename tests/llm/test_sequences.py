import collections
import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import chat, mixing, packing  # noqa: E402
from lumenflow.llm.queries import tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = ["don't 'sTop ''s 'll're I'M x's'", "a1b22,c3 ...é e\u0301 E\u0301cole ß İ", "<|endoftext|> x<|startoftext|>y <|end", "tab\tnew\nline\x0b\x0c\r\x1fz",
       "漢字かな 한국어 \U0001F600\U0001F600!! \u00a0\u3000x", "A.B-C_D#e$f%g&h*i|j", "", "'", "''''", "it'S IT'VE we'D", "x" * 300, "1234567890 3.14", "a\x00b", "\u2028x\u0085y"]


def test_ids_equal_those_of_whole_texts(spark):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    import pyarrow as pa
    enc = packing._Encoder(tokenizer_path())
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in enc.texts(pa.array(texts))] == want
    assert [g.tolist() for g in enc.texts(pa.array(texts))] == want       # from the cache


def test_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    import pyarrow as pa
    enc = packing._Encoder(tokenizer_path())
    texts = [cases.prose(i, 9) for i in range(6)]
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        for t, w in zip(texts, want):
            assert [g.tolist() for g in enc.texts(pa.array([t]))] == [w]


def check_packing(pieces, capacity):
    bins = collections.defaultdict(list)
    for r in pieces:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("group_rows", [50_000, 12])
def test_packing_of_awkward_documents(spark, group_rows):
    rows = cases.texts() + [(50 + i, t) for i, t in enumerate(ODD)]
    df, tok = cases.docs(spark, rows), tokenizer_path()
    got = packing.pack(packing.token_pieces(df, tok, 256), 256, group_rows).collect()
    enc = packing.encoder(tok).tokenizer
    want = collections.Counter()
    for doc_id, text in rows:
        ids = enc.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, a in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[a:a + 256], "<u4")
            want[doc_id, piece, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = check_packing(got, 256)
    bound = packing.lower_bound(np.array([r["length"] for r in got]), 256)
    assert bound <= bins <= bound + (1 if group_rows > 100 else 4)


def test_packing_repeated_id_and_empty_table(spark):
    df = cases.docs(spark, [(1, "a b c")] * 50)
    assert len(packing.pack(packing.token_pieces(df, tokenizer_path(), 16), 16).collect()) == 50
    assert packing.pack(packing.token_pieces(cases.docs(spark, []), tokenizer_path())).collect() == []


def test_sequences_hold_the_ids(spark):
    df, tok = cases.docs(spark, [(1, "a b c"), (2, "d e"), (3, None), (2, "f")]), tokenizer_path()
    packed = packing.pack(packing.token_pieces(df, tok, 6), 6)
    got = sorted(i for r in packing.sequences(df, packed, tok, 6).collect() for i in r["ids"])
    enc = packing.encoder(tok).tokenizer
    assert got == sorted(i for t in ("a b c", "d e", "", "f") for i in [*enc.encode(t, add_special_tokens=False).ids, 1])


def test_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(0)
    for _ in range(300):
        capacity = int(rng.integers(2, 60))
        lengths = rng.integers(1, capacity + 1, rng.integers(1, 40))
        bins, offsets, n = packing.best_fit_decreasing(lengths, capacity)
        check_packing([{"sequence_id": b, "offset": o, "length": x} for b, o, x in zip(bins, offsets, lengths)], capacity)
        assert -(-lengths.sum() // capacity) <= packing.lower_bound(lengths, capacity) <= n
    assert packing.lower_bound(np.array([6] * 7), 10) == 7
    assert packing.lower_bound(np.array([4] * 9), 10) == 5       # two to a bin, which volume alone does not show


# ---- mixing ----------------------------------------------------------------

def shares(children, budget):
    """Whole-token water filling by hand: [(name, weight, capacity)] -> {name: tokens}."""
    out, left, rest = {}, budget, sum(w for _, w, _ in children)
    todo = sorted(children, key=lambda c: (c[2] / c[1], c[0]))
    while todo and todo[0][2] * rest <= left * todo[0][1]:
        name, weight, cap = todo.pop(0)
        out[name] = cap
        left, rest = left - cap, rest - weight
    return out | {name: left * weight // rest for name, weight, _ in todo}


def mixed_rows():
    return [(i, cases.prose(i, 3 + (i * 37) % 200), ["en", "en", "de", None][i % 4], f"src{min(i % 11, 6)}") for i in range(300)]


@pytest.mark.parametrize("budget", [None, 3000, 10**9])
def test_mixing_budgets_and_prefixes(spark, budget):
    rows = mixed_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, epoch string")
    tokens = {r[0]: len(cases.words(r[1])) for r in rows}
    leaf_of = {r[0]: (f"d{int(r[3][3:]) % 4}", r[2] or "", r[3]) for r in rows}
    total = collections.Counter()
    for i, leaf in leaf_of.items():
        total[leaf] += tokens[i]
    cap = lambda *p: 2 * sum(v for k, v in total.items() if k[:len(p)] == p)     # noqa: E731
    want = {}
    top = shares([(d, 4 - int(d[1:]), cap(d)) for d in {k[0] for k in total}], sum(total.values()) if budget is None else budget)
    for d in top:
        langs = shares([(x, 4 if x == "en" else 2, cap(d, x)) for x in {k[1] for k in total if k[0] == d}], top[d])
        for x in langs:
            for s, q in shares([(s, 1, cap(d, x, s)) for s in {k[2] for k in total if k[:2] == (d, x)}], langs[x]).items():
                want[d, x, s] = q
    got = mixing.mix_report(df, budget=budget).collect()
    used, epochs = collections.Counter(), collections.Counter()
    for r in got:
        leaf = (r["domain"], r["lang"], r["source"])
        assert leaf_of[r["doc_id"]] == leaf and tokens[r["doc_id"]] == r["n_tokens"]
        used[leaf] += r["n_tokens"]
        epochs[r["doc_id"]] += 1
    longest = collections.defaultdict(int)
    for i, leaf in leaf_of.items():
        longest[leaf] = max(longest[leaf], tokens[i])
        assert epochs[i] <= 2 and epochs[i] >= min(2, want[leaf] // total[leaf])
    for leaf, q in want.items():
        assert q - longest[leaf] < used[leaf] <= q
    mixed = mixing.mix(df, budget=budget)
    assert mixed.columns == df.columns
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == epochs


def test_mixing_awkward_documents(spark):
    df = cases.docs(spark)
    got = mixing.mix(df)
    assert got.columns == df.columns
    ids = collections.Counter(r["doc_id"] for r in got.collect())
    report = collections.Counter(r["doc_id"] for r in mixing.mix_report(df).collect())
    assert ids == report and ids[14] in (0, 2, 4)
    assert mixing.mix(cases.docs(spark, [])).collect() == []
    # texts without a token cost nothing: once each, as their leaf has no epoch
    assert [r["doc_id"] for r in mixing.mix_report(cases.docs(spark, [(1, None), (2, "")])).orderBy("doc_id").collect()] == [1, 2]


def test_empty_texts_stay_within_the_epochs(spark):
    rows = [(i, cases.prose(i, 20) if i % 3 else "", "en", "src1") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for most in (1, 2, 3):
        copies = collections.Counter(r["doc_id"] for r in mixing.mix_report(df, budget=10**6, max_epochs=most).collect())
        assert set(copies.values()) == {most} and len(copies) == 60


# ---- chat ------------------------------------------------------------------

def rendered(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def chat_expected(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    out = [n, rendered(chosen[:n])]
    for side in (chosen[n:], rejected[n:]):
        spans, at = [], 0
        for r, t in side:
            start = at + len(f"<|im_start|>{r}\n")
            if r == "assistant":
                spans.append(f"{start}-{start + len(t) + len('<|im_end|>')}")
            at += len(rendered([(r, t)]))
        out += [rendered(side), ",".join(spans)]
    return (*out, not chosen[n:] and not rejected[n:])


def test_pairs_share_the_longest_prefix(spark):
    import random
    rng, rows, want = random.Random(3), [], []
    for i in range(60):
        talk = [(rng.choice(["user", "assistant", "system"]), rng.choice(["a", "b c", "", "é😀"])) for _ in range(rng.randrange(1, 8))]
        other = talk[:rng.randrange(len(talk) + 1)] + [(rng.choice(["user", "assistant"]), rng.choice(["a", "z"])) for _ in range(rng.randrange(3))]
        rows.append((i, talk, other))
        if other:
            want.append((i, *chat_expected(talk, other)))
    rows += [(None, [("user", "a")], [("user", "a")]), (99, [], [("user", "a")])]
    pairs = spark.createDataFrame(rows, "pair_id long, chosen array<struct<role string, text string>>, rejected array<struct<role string, text string>>")
    assert cases.rows_of(chat.format_pairs(pairs)) == sorted(want, key=repr)


def test_answer_pairs(spark):
    rows = [(0, 1, "assistant", "no", 1), (0, 0, "user", "q", 1), (0, 2, "user", "more", 1), (1, 0, "assistant", None, 1), (1, 0, "assistant", None, 1),
            (2, 0, "user", "alone", 1), (3, 0, "assistant", "x", 1), (4, 0, "assistant", "s", 1), (5, 0, "assistant", "s", 1), (None, 0, "assistant", "y", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pair_id long")
    got = {r["pair_id"]: r for r in chat.format_pairs(chat.all_answer_pairs(df)).collect()}
    assert set(got) == {0, 1, 3, 4, 5}
    assert got[0]["prompt"] == rendered([("user", "q")]) and got[0]["chosen"] == rendered([("assistant", "no")]) and got[0]["rejected"] == rendered([("assistant", "")])
    assert got[4]["tie"] and got[4]["chosen"] == "" and got[4]["prompt"] == rendered([("assistant", "s")])
    assert chat.format_pairs(chat.all_answer_pairs(df.limit(0))).collect() == []


@pytest.mark.parametrize("rows_a_range", [1, 3, 10_000])
def test_answers_follow_in_one_order(spark, monkeypatch, rows_a_range):
    """However finely the order is cut, an answer follows the one before it."""
    import hashlib
    monkeypatch.setattr(chat, "RANGE_ROWS", rows_a_range)
    ids = [i * 1_000_003 for i in range(0, 60, 2)]
    df = spark.createDataFrame([(2 * i, 0, "assistant", f"a{2 * i}") for i in ids], "conv_id long, turn long, role string, text string")
    order = sorted((hashlib.md5(str(2 * i).encode()).hexdigest(), 2 * i) for i in ids)
    want = {a[1]: f"a{b[1]}" for a, b in zip(order, order[1:] + order[:1])}
    got = chat.all_answer_pairs(df).collect()
    assert {r["pair_id"]: r["rejected"][0]["text"] for r in got} == want


def test_every_answer_gets_a_pair(spark):
    from lumenflow.llm.queries import op9_preference_format
    # even ids only: no neighbour has an answer; 7 has none itself
    rows = [(i, 0, "user", f"q{i}") for i in range(0, 200, 2)] + [(i, 1, "assistant", f"a{i}") for i in range(0, 200, 2)]
    rows += [(7, 0, "user", "alone"), (0, 2, "user", "later")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_pairs(chat.all_answer_pairs(df)).collect()
    assert sorted(r["pair_id"] for r in got) == list(range(0, 200, 2))
    assert all(r["chosen"] == rendered([("assistant", f"a{r['pair_id']}")]) and r["prompt"] == rendered([("user", f"q{r['pair_id']}")]) for r in got)
    assert len({r["rejected"] for r in got}) == 100 and not any(r["rejected"] == r["chosen"] for r in got)      # one cycle of all
    dense = df.unionByName(spark.createDataFrame([(1, 0, "assistant", "b")], df.schema))
    near = {r["pair_id"]: r for r in chat.format_pairs(chat.all_answer_pairs(dense)).collect()}
    assert near[0]["rejected"] == rendered([("assistant", "b")]) and near[1]["rejected"] == rendered([("assistant", "a0")]) and len(near) == 101
    one = chat.format_pairs(chat.all_answer_pairs(df.where("conv_id = 4"))).collect()
    assert [r["tie"] for r in one] == [True]

    class Session:
        class read:
            parquet = staticmethod(lambda path: df)
    assert op9_preference_format(Session, "unused").count() == 100
