"""Scorer, region flatten, exact split, blocks and the fuzzy best match."""
import itertools
import json
import random

import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenflow.functions import jaro_winkler as JW
from lumenflow.operators import hierarchy as H
from lumenflow.operators import matching as MT

_DUCK = duckdb.connect()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("AB_# 01(x)", max_size=14), st.text("AB_# 01(x)", max_size=14)),
                min_size=1, max_size=20))
def test_scorer_equals_duckdb(pairs):
    ref = [_DUCK.execute("select jaro_winkler_similarity(?, ?)", list(p)).fetchone()[0] for p in pairs]
    got = JW.jaro_winkler([a for a, _ in pairs], [b for _, b in pairs])
    assert np.allclose(got, ref, atol=1e-12)
    assert np.all(_bound(pairs) + 1e-12 >= got)


def _bound(pairs):
    """The bound of a node that holds one member."""
    ha, hb = (JW.char_histogram([p[i] for p in pairs]) for i in (0, 1))
    la, lb = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
    head = np.array([JW._common_prefix(a[:4], b[:4]) for a, b in pairs])
    return JW.bound(np.minimum(ha, hb).sum(axis=1), la, lb, head)


def test_scorer_long_strings():
    a, b = "X" * 80 + "ABC", "X" * 79 + "ACB"
    ref = _DUCK.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
    assert abs(float(JW.jaro_winkler([a], [b])[0]) - ref) < 1e-12


def _doc(spark, obj_or_lines):
    lines = obj_or_lines if isinstance(obj_or_lines, list) else [json.dumps(obj_or_lines)]
    return H.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_flatten_drops_orphans_and_concatenates_codes(spark):
    doc = {"provinsi": {"11": "ACEH", "12": "SUMUT"},
           "kabupaten": {"11": {"01": "KAB A"}, "99": {"01": "ORPHAN"}},
           "kecamatan": {"1101": {"010": "KEC A"}},
           "kelurahan": {"1101010": {"2001": "DESA A", "2002": "DESA B"}}}
    got = sorted(tuple(r) for r in H.flatten(_doc(spark, doc)).collect())
    assert got == [("11", "ACEH", "1101", "KAB A", "1101010", "KEC A", "11010102001", "DESA A"),
                   ("11", "ACEH", "1101", "KAB A", "1101010", "KEC A", "11010102002", "DESA B")]


def test_repeated_key_keeps_last_value(spark):
    text = ('{"provinsi": {"11": "OLD", "11": "NEW"}, "kabupaten": {"11": {"01": "K"}}, '
            '"kecamatan": {"1101": {"01": "C"}}, "kelurahan": {"110101": {"01": "D"}}}')
    assert [r.province_name for r in H.flatten(_doc(spark, [text])).collect()] == ["NEW"]


def test_fragments_equal_whole_document(spark):
    whole = {"provinsi": {"11": "A"}, "kabupaten": {"11": {"01": "B", "02": "C"}},
             "kecamatan": {"1101": {"01": "D"}, "1102": {"01": "E"}},
             "kelurahan": {"110101": {"01": "F"}, "110201": {"01": "G", "02": "H"}}}
    parts = [json.dumps({"provinsi": whole["provinsi"]}), json.dumps({"kabupaten": whole["kabupaten"]}),
             json.dumps({"kecamatan": whole["kecamatan"]}),
             json.dumps({"kelurahan": {"110101": {"01": "F"}}}),
             json.dumps({"kelurahan": {"110201": {"01": "G", "02": "H"}}})]
    a = sorted(tuple(r) for r in H.flatten(_doc(spark, whole)).collect())
    b = sorted(tuple(r) for r in H.flatten(_doc(spark, parts)).collect())
    assert a == b and len(a) == 3


def _region(spark, rows):
    return spark.createDataFrame(rows, "subdistrict_code string, province_name string, city_name string, "
                                       "district_name string, subdistrict_name string")


def _master(spark, rows):
    return spark.createDataFrame(rows, "URBAN_ID bigint, PROVINCE_NAME string, DISTRICT_NAME string, "
                                       "SUBDISTRICT_NAME string, URBAN_NAME string")


def test_exact_split_uppercases_master_only_and_matches_null_text(spark):
    region = _region(spark, [("1", "P", "C", "D", "S"), ("2", "P", "C", "D", "s"), ("3", "P", "C", "D", None)])
    master = _master(spark, [(10, "p", "c", "d", "s"), (11, "P", "C", "D", None)])
    mapped, left_only, master_only = MT.exact_split(region, master)
    assert [tuple(r) for r in mapped.collect()] == [("1", 10)]
    assert sorted(r.subdistrict_code for r in left_only.collect()) == ["2", "3"]
    assert [r.URBAN_ID for r in master_only.collect()] == [11]     # null became the text NAN


def test_block_rules(spark):
    lp = spark.createDataFrame([("PAPUA TENGAH",), ("DAERAH ISTIMEWA YOGYAKARTA",), ("ACEH",)], "province_name string")
    mp = spark.createDataFrame([("PAPUA",), ("PAPUA BARAT",), ("DI YOGYAKARTA",), ("ACEH",), ("PAPU",)], "m_province string")
    got = sorted(tuple(r) for r in MT.block_map(lp, mp).collect())
    assert got == [("ACEH", "ACEH"), ("DAERAH ISTIMEWA YOGYAKARTA", "DI YOGYAKARTA"),
                   ("PAPUA TENGAH", "PAPUA"), ("PAPUA TENGAH", "PAPUA BARAT")]


def _brute(left_rows, master_rows, rules):
    """Reference answer: score every pair of the block, keep the best."""
    blocks = {}
    for p, *_ in [(r[1],) for r in left_rows]:
        targets = set()
        rule = next((r for r in rules if p in r.provinces), None)
        for m in master_rows:
            mp = m[1].upper()
            if rule is None and mp == p or rule and (mp.startswith(rule.target) if rule.prefix else mp == rule.target):
                targets.add(mp)
        blocks[p] = targets
    out = {}
    for code, p, c, d, s in left_rows:
        a = "_".join([p, c, d, s])
        best = None
        for uid, mp, mc, md, ms in master_rows:
            mp, mc, md = mp.upper(), mc.upper(), md.upper()
            clean = re.sub(r"\([^)]*\)", "", ms.upper())
            if mp not in blocks[p]:
                continue
            score = round(float(JW.jaro_winkler([a], ["_".join([mp, mc, md, clean])])[0]), 9)
            key = (-score, mp, mc, md, clean, uid)
            if score > 0 and (best is None or key < best):
                best = key
        if best:
            out[code] = (best[5], -best[0])
    return out


def test_fuzzy_best_match_equals_brute_force(spark):
    rnd = random.Random(3)
    words = ["ALPHA", "ALPHO", "BETA", "GAMMA", "GAMA", "DELTA"]
    provinces = ["NORTH", "SOUTH", "NORTH NEW"]
    left_rows, master_rows = [], []
    for i in range(120):
        p = rnd.choice(provinces)
        left_rows.append((f"L{i:03d}", p, rnd.choice(words), rnd.choice(words),
                          rnd.choice(words) + str(rnd.randrange(30))))
    for i in range(90):
        master_rows.append((1000 + i, rnd.choice(["North", "SOUTH", "NORTHERN"]), rnd.choice(words).lower(),
                            rnd.choice(words), rnd.choice(words) + str(rnd.randrange(30))
                            + rnd.choice(["", " (LAMA)"])))
    rules = MT.DEFAULT_RULES + (MT.BlockRule(("NORTH NEW",), "NORTH", prefix=True),)
    region = _region(spark, left_rows)
    master = _master(spark, master_rows)
    _, left_only, master_only = MT.exact_split(region, master)
    got = {r.subdistrict_a: (r.subdistrict_b, r.similarity_score)
           for r in MT.fuzzy_best_match(left_only, master_only, rules, group_rows=4).collect()}
    lo = {r.subdistrict_code for r in left_only.collect()}
    mo = {r.URBAN_ID for r in master_only.collect()}
    expect = _brute([r for r in left_rows if r[0] in lo], [m for m in master_rows if m[0] in mo], rules)
    assert got == expect
    # ties exist in this fixture, so the tie order is exercised
    assert len(got) > 50


def test_missing_names_ids_and_repeats(spark):
    """A row without a name is reported, a master without an id is no match, and
    rows that share an id or a code are told apart by their names."""
    region = _region(spark, [("L1", "P", "C", "D", None), ("L2", "P", "C", "D", "SAME"), ("L3", "P", "C", "D", "ALPHA1"),
                             ("L3", "P", "C", "D", "BETA1"), ("L4", "Q", "C", "D", "S")])
    master = _master(spark, [(None, "P", "C", "D", "SAME"), (7, "P", "C", "D", "ALPHA2"), (7, "P", "X", "Y", "ZZZ"), (8, "P", "C", "D", "BETA2")])
    mapped, left_only, master_only = MT.exact_split(region, master)
    assert mapped.count() == 0 and left_only.count() == 5 and master_only.count() == 3
    fuzzy = MT.fuzzy_best_match(left_only, master_only, names=True)
    got = sorted((r.subdistrict_a, r.subdistrict_b) for r in fuzzy.collect())
    assert [a for a, _ in got] == ["L2", "L3", "L3"] and got[1:] == [("L3", 7), ("L3", 8)]
    lost = {(r.subdistrict_code, r.reason) for r in MT.unmatched(left_only, fuzzy).collect()}
    assert lost == {("L1", "missing name"), ("L4", "no candidate")}
    some = MT.fuzzy_best_match(left_only, master_only, only_codes=("L2",), names=True)
    assert [r.subdistrict_a for r in some.collect()] == ["L2"]
    assert MT.unmatched(left_only, some, ("L2",)).collect() == []          # rows left out are not unmatched


def test_a_row_is_unmatched_by_code_and_names(spark):
    """Two rows of one code: the one without a name is reported though the other matched."""
    region = _region(spark, [("L1", "P", "C", "D", None), ("L1", "P", "C", "D", "ALPHA1"), ("L1", "Q", "C", "D", "ALPHA1")])
    master = _master(spark, [(7, "P", "C", "D", "ALPHA2")])
    _, left_only, master_only = MT.exact_split(region, master)
    fuzzy = MT.fuzzy_best_match(left_only, master_only, names=True)
    lost = sorted((r.subdistrict_code, r.reason) for r in MT.unmatched(left_only, fuzzy).collect())
    assert lost == [("L1", "missing name"), ("L1", "no candidate")]


# ---- the trie search ---------------------------------------------------------

def _search(a, members, floor=0.0):
    """(best score, strings that have it, members scored)."""
    from lumenflow.functions.jaro_trie import Search, tries_of
    search = Search(a)
    best, found = search.best(tries_of(members), floor)
    return best, sorted(found), search.scored


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc12", max_size=14), st.lists(st.text(alphabet="abc12", min_size=1, max_size=14), min_size=1, max_size=25))
def test_trie_search_equals_all_pairs(a, members):
    import numpy as np
    scores = {b: float(s) for b, s in zip(members, np.round(JW.jaro_winkler([a] * len(members), members), 9))}
    top = max(scores.values())
    best, strings, _ = _search(a, members)
    assert best == (top if top > 0 else 0.0)
    assert strings == (sorted({b for b in members if scores[b] == top}) if top > 0 else [])
    # a floor from elsewhere: nothing below it is found, all that reach it still are
    assert _search(a, members, top)[:2] == (top, strings if top > 0 else []) if top > 0 else True
    assert _search(a, members, top + 0.01)[1] == []


def test_trie_bounds_are_never_exceeded():
    from lumenflow.functions.jaro_trie import Search, Trie
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(1, 30)
        members = sorted({"".join(rng.choice("ab01") for _ in range(n)) for _ in range(rng.randrange(1, 20))})
        a = "".join(rng.choice("ab01") for _ in range(rng.randrange(1, 30)))
        top = max(JW.jaro_winkler([a] * len(members), members))
        assert Search(a).bound(Trie(members)) >= top - 1e-9


def test_trie_search_scores_few_members():
    """Names alike but for some digits, as in an address master; long ones too."""
    rng = random.Random(9)
    members = [f"EUROPE_CITY_{rng.randrange(25)}_DISTRICT_VILLAGE{rng.randrange(10**6):09d}" for _ in range(4000)]
    scored = 0
    for i in range(40):
        a = members[i][:6].replace("E_", "A_") + members[i][6:-3] + f"{rng.randrange(1000):03d}"
        best, strings, n = _search(a, members)
        want = JW.jaro_winkler([a] * len(members), members).round(9)
        assert best == want.max() and strings == sorted({b for b, s in zip(members, want) if s == best})
        scored += n
    assert scored < 0.2 * 40 * len(members)         # no member is close here: six digits at random
    long = ["x" * 40 + f"{i:03d}" * 20 for i in range(50)]
    assert _search("x" * 38 + "007" * 21, long)[1][0] in long


def test_many_rows_against_a_trie_equal_all_pairs():
    """Rows go down the trie together; names longer than a word of the masks too."""
    from lumenflow.functions.jaro_trie import Batch, Trie
    rng = random.Random(6)
    for size, alphabet in ((9, "ab1"), (30, "abcd_ 12"), (80, "abcd_ 12")):
        members = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, size))) for _ in range(30)]
        rows = ["".join(rng.choice(alphabet + "z") for _ in range(rng.randrange(size))) for _ in range(5)] + members[:2]
        trie = Trie(members)
        scores = np.array([JW.jaro_winkler([a] * len(trie.strings), trie.strings).round(9) for a in rows])
        top = scores.max(axis=1)
        for floors in (None, top * 0.9, top):
            batch = Batch(rows, trie, floors)
            row, member, score = batch.run()
            got = sorted(zip(row.tolist(), member.tolist(), score.tolist()))
            assert got == [(i, j, s) for i, line in enumerate(scores.tolist()) for j, s in enumerate(line) if s == top[i] > 0]
            assert (batch.scored <= len(trie.strings)).all()
        assert (Batch(rows, trie).floors() <= top).all() and len(Batch(rows, trie, top + 0.01).run()[0]) == 0


def test_names_with_many_equal_digits_against_a_trie():
    """A row has more of a character than any member, and places of it stay open for long."""
    from lumenflow.functions.jaro_trie import Batch, Trie
    rng = random.Random(1)

    def name(province):
        digits = "".join(rng.choice("0129") for _ in range(6)).rjust(9, "0")
        return f"{province}_NATION_{rng.choice([1, 11, 10, 21])}_{rng.choice(['MACHINERY', 'BUILDING'])}_CUSTOMER{rng.choice(['#', ''])}{digits}"

    for _ in range(12):
        trie = Trie([name("AMERICA") for _ in range(rng.choice([5, 40]))])
        rows = [name(rng.choice(["AMERICA", "AMERICA NORTH"])) for _ in range(20)]
        scores = np.array([JW.jaro_winkler([a] * len(trie.strings), trie.strings).round(9) for a in rows])
        for floors in (None, scores.max(axis=1)):
            row, member, _ = Batch(rows, trie, floors).run()
            assert sorted(zip(row.tolist(), member.tolist())) == [tuple(x) for x in np.argwhere(scores == scores.max(axis=1)[:, None]).tolist()]


def test_floors_come_from_more_than_one_chunk(spark):
    """The chunk of the highest bound is not the one of the best member: few pairs are scored."""
    rnd = random.Random(5)
    names = [f"NATION {rnd.randrange(20)}", f"NATION {rnd.randrange(20)}"]
    rows = [(f"L{i:03d}", "EUROPA", rnd.choice(names), rnd.choice(["BUILDING", "MACHINERY"]), f"CUSTOMER#{rnd.randrange(10**6):09d}")
            for i in range(60)]
    members = [(500 + i, "EUROPE", rnd.choice(names), rnd.choice(["BUILDING", "MACHINERY"]), f"CUSTOMER#{rnd.randrange(10**6):09d}")
               for i in range(900)]
    rules = (MT.BlockRule(("EUROPA",), "EUROPE"),)
    _, left_only, master_only = MT.exact_split(_region(spark, rows), _master(spark, members))
    report = {}
    got = {r.subdistrict_a: r.similarity_score
           for r in MT.fuzzy_best_match(left_only, master_only, rules, group_rows=100, report=report).collect()}
    texts = ["_".join(m[1:]) for m in members]
    assert got == {r[0]: JW.jaro_winkler(["_".join(r[1:])] * len(texts), texts).round(9).max() for r in rows}
    assert report["scored_pairs"] < 0.03 * report["block_pairs"], report["scored_pairs"] / report["block_pairs"]


def test_salted_hot_groups_give_the_same_answer(spark, monkeypatch):
    """With at most 3 region rows per scoring call every group is split
    into salts (members replicated); the result must not change."""
    rnd = random.Random(11)
    words = ["KAMPUNG", "KAMPONG", "DESA", "DUSUN"]
    left_rows = [(f"L{i:03d}", "TIMUR", rnd.choice(words), "KEC", rnd.choice(words) + str(rnd.randrange(9)))
                 for i in range(60)]
    master_rows = [(500 + i, "TIMUR", rnd.choice(words), "KEC", rnd.choice(words) + str(rnd.randrange(9)) + "X")
                   for i in range(40)]
    region, master = _region(spark, left_rows), _master(spark, master_rows)
    _, left_only, master_only = MT.exact_split(region, master)
    plain = {tuple(r) for r in MT.fuzzy_best_match(left_only, master_only, group_rows=8).collect()}
    monkeypatch.setattr(MT, "BLOCK_LEFT_ROWS", 3)
    salted = {tuple(r) for r in MT.fuzzy_best_match(left_only, master_only, group_rows=8).collect()}
    assert plain == salted and len(plain) == 60


def test_equal_names_are_searched_once(spark):
    """Rows with the same names share one search, members with the same names are one."""
    rows = [(f"L{i:03d}", "TIMUR", "KOTA", "KEC", f"DESA{i % 5}") for i in range(60)]
    members = [(500 - i, "TIMUR", "KOTA", "KEC", f"DESA{i % 4}X" + (" (LAMA)" if i % 2 else "")) for i in range(40)]
    region, master = _region(spark, rows), _master(spark, members)
    _, left_only, master_only = MT.exact_split(region, master)
    report = {}
    got = {r.subdistrict_a: (r.subdistrict_b, r.similarity_score)
           for r in MT.fuzzy_best_match(left_only, master_only, report=report).collect()}
    assert got == _brute(rows, members, ()) and len(got) == 60
    assert report["block_pairs"] <= 5 * 8 and report["scored_pairs"] <= report["block_pairs"]


def test_whole_file_document(spark, scratch):
    doc = {"provinsi": {"11": "A", "11": "A2"}, "kabupaten": {"11": {"01": "B"}},
           "kecamatan": {"1101": {"01": "C"}}, "kelurahan": {"110101": {"01": "D", "02": "E"}}}
    path = scratch("doc") + "/wilayah.json"
    import os
    os.makedirs(path)
    with open(path + "/part.json", "w") as f:
        f.write(json.dumps(doc, indent=2))          # pretty-printed: one document over many lines
    rows = sorted(tuple(r) for r in H.flatten(H.read_document(spark, path, whole_file=True)).collect())
    assert [r[-1] for r in rows] == ["D", "E"] and rows[0][1] == "A2"
