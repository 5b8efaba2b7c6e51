import collections
import math
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

from lumenflow.llm import pii, quality, toxicity, url_filter  # noqa: E402
from lumenflow.llm.queries import URL_RULES  # noqa: E402

SF = "/root/testdata/sf0.01"


# ---- urls ------------------------------------------------------------------

URLS = [
    (1, None, "", "", None, "allow"), (2, "no scheme", "", "", None, "allow"), (3, "", "", "", None, "allow"),
    (4, "HTTP://WWW.Example.NET/EN/x", "www.example.net", "/EN/x", "net/", "block"),
    (5, "http://example.net/en/?q#f", "example.net", "/en/", "example.net/en/", "allow"),
    (6, "http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    (7, "http://a.example.com/de/1", "a.example.com", "/de/1", "example.com/de/", "block"),
    (8, "http://a.example.com/de", "a.example.com", "/de", None, "allow"),
    (9, "http://x.net", "x.net", "", None, "allow"), (10, "http://x.net?y=/en/", "x.net", "", None, "allow"),
    (11, "a://b://c.net/x", "b:", "//c.net/x", None, "allow"), (12, "http://org/fr/ü", "org", "/fr/ü", "org/fr/", "allow"),
    (13, "http://ÄB.org/fr/#/", "Äb.org", "/fr/", "org/fr/", "allow"), (14, "http://example.net:80/en/", "example.net:80", "/en/", None, "allow"),
    (14, "http://example.net:80/en/", "example.net:80", "/en/", None, "allow"), (15, "://net/", "net", "/", "net/", "block"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u, *_ in URLS], "page_id long, url string, rule string, host string")
    got = url_filter.judge(pages, URL_RULES).select("page_id", "url", "host", "path", "rule", "verdict")
    assert cases.rows_of(got) == sorted(URLS, key=repr)


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, URL_RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge(one, []).first()["verdict"] == "allow"


def test_judge_replaces_columns_of_its_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "h", "p", "r", "v", 5)],
                                  "page_id long, url string, host string, path string, rule string, verdict string, other int")
    row = url_filter.judge(pages, URL_RULES).first()
    assert (row["host"], row["path"], row["rule"], row["verdict"], row["other"]) == ("a.net", "/x", "net/", "block", 5)


def test_a_level_sees_only_what_the_one_before_took(spark, monkeypatch):
    """The universe is scanned twice, however many levels there are."""
    written = []
    real = url_filter.materialize
    monkeypatch.setattr(url_filter, "materialize", lambda df, name: written.append(name) or real(df, name))
    universe = spark.createDataFrame([(f"k{i}",) for i in range(4000)], "key string")
    levels = url_filter.build_cascade(universe, [f"k{i}" for i in range(0, 4000, 6)])
    assert len(levels) > 2 and len(written) == len(levels)


def test_cascade_is_exact_over_the_universe(spark):
    rng = random.Random(2)
    names = [f"k{rng.randrange(10**9)}" for _ in range(3000)]
    listed = set(names[:700])
    universe = spark.createDataFrame([(n,) for n in names + names[:100]], "key string")
    levels = url_filter.build_cascade(universe, sorted(listed))
    assert len(levels) > 1
    got = universe.distinct().select("key", url_filter.member(levels, F.col("key")).alias("m")).collect()
    assert {r["key"] for r in got if r["m"]} == listed


# ---- quality ---------------------------------------------------------------

def base_expected(text):
    text = text or ""
    w = cases.words(text)
    lines = [x for x in text.split("\n") if cases.words(x)]
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))


def test_base_counts_equal_brute_force(spark):
    rows = cases.texts() + [
        (30, "a b c a b c x a b"), (31, "x\nx\n \n\nx \nx"), (32, "#$%&*|<> a#b"), (33, "a a a a"), (34, "a b c d a b c"),
        (35, "a b\x0ca b\x1fa b c"), (36, "\n".join(["one two three four"] * 30)), (37, " ".join(random.Random(1).choices("abc", k=300)))]
    got = quality.judge(cases.docs(spark, rows), quality.Model((0.0,) * quality.BUCKETS, -math.inf))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert cases.rows_of(got.select(*names)) == sorted(((i, *base_expected(t)) for i, t in rows), key=repr)
    assert all(r["kept"] == (not r["base_failed"]) for r in got.collect())
    assert got.where("not kept").count() == sum(base_expected(t)[-1] for _, t in rows)


def test_quality_score_is_the_mean_log_ratio(spark):
    ratios = [((i * 7919) % 1000) / 500 - 1 for i in range(quality.BUCKETS)]
    df = quality.with_words(cases.docs(spark))
    got = df.select("hashes", quality.Model(tuple(ratios), 0.0).score(F.col("hashes")).alias("s"), quality._buckets(F.col("hashes")).alias("b"))
    for r in got.collect():
        if not r["hashes"]:
            assert r["s"] is None
        else:
            assert len(r["b"]) == 2 * len(r["hashes"]) - 1
            assert r["s"] == pytest.approx(sum(ratios[b] for b in r["b"]) / len(r["b"]))


def test_quality_parts_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.judge(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("not base_failed")
    rate = {r["quality"]: r["k"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.97 and rate[0] < 0.2


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(cases.docs(spark), labels)
    assert model.cut == -math.inf
    assert quality.judge(cases.docs(spark, []), model).collect() == []


def test_quality_fits_all_labels(spark):
    n = 26_000
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    marked = quality.labelled(labels)
    assert marked.count() == n and marked.where("good = 1").count() == n // 2
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("word w"), F.col("id").cast("string")).alias("text"))
    counted = marked.where("good = 1 and not held").count()
    model = quality.learn(docs, marked)
    # "word" is in each text, so its bucket holds at least as many as there are
    bucket = docs.limit(1).select(quality._buckets(F.array(F.xxhash64(F.lit("word"))))[0].alias("b")).first()["b"]
    raw, share = n + n * 2 / quality.BUCKETS, counted / n
    assert model.ratios[bucket] == pytest.approx(math.log((raw * share + quality.PRIOR) / (raw * share + quality.PRIOR)), abs=0.01)


@pytest.mark.parametrize("bits", [None, 64])
def test_quality_joins_only_texts_that_may_be_targets(spark, monkeypatch, bits):
    """The join gets the target's texts and few others; the ratios are those of all texts,
    also with a bitmap so small that most texts pass it."""
    if bits:
        monkeypatch.setattr(quality, "MARKS", bits)
    n = 2_000
    rows = [(i, f"word w{i % 7} w{i}") for i in range(n)] + [(3, "w3 again"), (5, None), (None, "word"), (None, None)]
    docs = cases.docs(spark, rows)
    marked = quality.labelled(spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 200)], "doc_id long, quality int"))
    target = {r["doc_id"] for r in marked.where("good = 1 and not held").collect()}
    sent, real = [], type(docs).join

    def spy(self, other, on=None, how=None):
        if on == "doc_id" and "text" in self.columns:
            sent.append(self.count())
        return real(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", spy)
    model = quality.learn(docs, marked)
    assert bits or len(target) <= max(sent) < 200
    found = docs.select("doc_id", quality._buckets(F.transform(quality.words(F.col("text")), lambda w: F.xxhash64(w))).alias("b")).collect()
    raw, good = collections.Counter(), collections.Counter()
    for r in found:
        raw.update(r["b"])
        good.update(r["b"] if r["doc_id"] in target else [])
    assert {b: x for b, x in enumerate(model.ratios) if x} == {
        b: x for b, c in raw.items() if (x := round(math.log((good[b] + quality.PRIOR) / (c * good.total() / raw.total() + quality.PRIOR)), 9))}


@pytest.mark.parametrize("seed", range(4))
def test_cut_of_ranges_is_best_cut(spark, seed):
    rng = random.Random(seed)
    rows = [(round(rng.gauss(label, 1), 1 + 2 * (seed % 2)), label) for label in rng.choices([0, 1], k=700)]
    rows = rows[:0] if seed == 3 else rows
    assert quality.cut_of(spark.createDataFrame(rows, "score double, good int")) == quality.best_cut(rows)
    good = [r for r in rows if r[1]]
    assert quality.cut_of(spark.createDataFrame(good, "score double, good int")) == -math.inf


def test_best_cut():
    assert quality.best_cut([]) == -math.inf
    assert quality.best_cut([(0.0, 0), (1.0, 0), (2.0, 1), (3.0, 1)]) == 1.5
    assert quality.best_cut([(0.0, 0), (0.0, 1), (1.0, 1)]) <= 0.0


# ---- toxicity --------------------------------------------------------------

def test_folding():
    assert toxicity.fold("You 1D10T!! and ＦＯＯＬ, p\u0430thet1c $cum h@te") == " you idiot and fool pathetic scum hate "
    assert toxicity.fold("") == "  "


def test_exception_phrases_shield_terms():
    lexicon = toxicity.Lexicon({" kill ": 3.0}, [" kill switch "])
    a = lexicon.automaton()
    assert toxicity.evidence(a, toxicity.fold("press the kill switch"))[1] == 0
    assert toxicity.evidence(a, toxicity.fold("I kill you, not the kill switch"))[1] == 3.0
    assert toxicity.evidence(None, " x ") == (0.0, 0.0, 0.0, 0.0)


def test_shields_equal_comparing_all():
    rng = random.Random(6)
    for _ in range(300):
        spans = lambda n: sorted(((a := rng.randrange(30), a + rng.randrange(1, 9), 1.0) for _ in range(rng.randrange(n))), key=lambda x: x[1])
        hits, shields = spans(12), spans(6)
        want = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in shields)]
        assert toxicity._unshielded(hits, list(shields)) == want


def test_evidence_equals_a_plain_matcher():
    """All occurrences of all terms by str.find, those inside a phrase left out."""
    rng = random.Random(8)
    terms = {"ab": 1.5, "abc": 2.0, " ca": 0.5, "bb": 1.0}
    phrases = ["cabb", "ab c", " cab "]
    automaton = toxicity.Lexicon(terms, phrases).automaton()
    for _ in range(300):
        text = " " + "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 60))) + " "
        at = lambda w: [(i, i + len(w)) for i in range(len(text)) if text.startswith(w, i)]     # noqa: E731
        inside = [s for p in phrases for s in at(p)]
        hits = [w for t, w in terms.items() for a, b in at(t) if not any(x <= a and b <= y for x, y in inside)]
        got = toxicity.evidence(automaton, text)
        if not hits:
            assert got == (0.0, 0.0, 0.0, 0.0)
        else:
            assert got == pytest.approx((100 * sum(hits) / len(text), max(hits), __import__("math").log1p(sum(hits)), 100 * len(hits) / len(text)))


def test_long_texts_with_many_phrases_are_linear():
    import time
    lexicon = toxicity.Lexicon({" kill ": 3.0}, [" kill switch "])
    text = toxicity.fold("kill switch and kill " * 20_000)
    start = time.time()
    got = toxicity.evidence(lexicon.automaton(), text)
    assert got[1] == 3.0 and time.time() - start < 2


def _labelled(spark):
    rng, rows, labels = random.Random(4), [], []
    for i in range(200):
        w = cases.prose(i, 80).split(" ")
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(80)] = rng.choice(["blorgs", "BL0RGS", "blorg$"])
        elif i % 7 == 0:
            w[10:12] = ["fresh", "blorgs"]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return cases.docs(spark, rows + [(500, None), (501, ""), (None, "x")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_terms_and_exceptions(spark):
    docs, labels = _labelled(spark)
    lexicon = toxicity.learn(docs, labels, lambda c: F.lit(False))
    assert any("blorg" in t for t in lexicon.terms)
    got = {r["doc_id"]: r for r in toxicity.score(docs, lexicon).join(labels, "doc_id", "left").collect()}
    assert sum(r["predicted"] == r["toxic"] for r in got.values() if r["toxic"] is not None) >= 195
    assert got[500]["score"] == got[501]["score"] < 0.5 and len(got) == 203
    kept = toxicity.drop_toxic(docs, lexicon)
    assert kept.columns == docs.columns and kept.where("doc_id is null or doc_id >= 500").count() == 3


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = _labelled(spark)
    held = lambda c: c % 5 == 0      # noqa: E731
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id") % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score(docs, toxicity.learn(docs, t, held)) for t in (labels, flipped))
    assert cases.rows_of(one) == cases.rows_of(two)


def test_toxicity_without_both_classes(spark):
    docs, labels = _labelled(spark)
    none = toxicity.learn(docs, labels.where("toxic = 0"), lambda c: F.lit(False))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, none).count() == docs.count()
    assert toxicity.score(docs.limit(0), none).collect() == []


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    lexicon = toxicity.learn(docs, labels, toxicity.crc_held_out)
    held = labels.where(toxicity.crc_held_out(F.col("doc_id")))
    got = toxicity.score(docs.join(held.select("doc_id"), "doc_id"), lexicon).join(held, "doc_id").collect()
    right = {t: [r["predicted"] == t for r in got if r["toxic"] == t] for t in (0, 1)}
    assert sum(right[1]) / len(right[1]) > 0.85 and sum(right[0]) / len(right[0]) > 0.98


# ---- personal data ---------------------------------------------------------

PRIVATE = ('Mail of.55@mail9.example.com now +1 (377) 555-0271, 4111 1111 1111 1111 10.20.30.40 '
           'token = "87e15d78b9d8ef29b6c10061e3551a60fa07e990" Mrs. Anna Karenina met Mr Smith; Г-жа Иванова '
           'DE89 3704 0044 0532 0130 00 OF.55@MAIL9.EXAMPLE.COM!! 555-123-4567 123-45-6789 4111-1111-1111-1111')


def test_entities_are_found():
    kinds = collections.Counter(k for _, _, k, _ in pii.find(PRIVATE))
    assert kinds == {"email": 2, "phone": 2, "card": 2, "ipv4": 1, "secret": 1, "name": 3, "iban": 1, "ssn": 1}
    assert pii.find(None) == [] and pii.find("") == [] and pii.find("Version 2.0. of 12 items, page 3") == []


def test_surrogates_replace_consistently(spark):
    rows = [(1, PRIVATE), (2, "again of.55@mail9.example.com"), (3, None), (4, ""), (5, "nothing here"), (1, PRIVATE), (None, "x@y.example.org")]
    df = cases.docs(spark, rows).withColumn("n_entities", F.lit("clash"))
    got = pii.pseudonymise(df, b"key").collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert len(got) == 7 and by_id[3][0]["text"] is None and by_id[4][0]["text"] == "" and by_id[5][0]["text"] == "nothing here"
    a, b = (r["text"] for r in by_id[1])
    assert a == b and by_id[1][0]["n_entities"] == 13
    old, new = pii.find(PRIVATE), pii.find(a)
    assert [k for *_, k, _ in old] == [k for *_, k, _ in new]
    table = {}
    for (p, q, kind, normal), (x, y, _, other) in zip(old, new):
        assert normal != other and table.setdefault((kind, normal), other) == other
    assert len(set(table.values())) == len(table)
    assert by_id[2][0]["text"].split()[1].upper() in a.upper()
    assert "Mrs. " in a and " Mr " in a and a.count("@") == 2 and pii._luhn(new[2][3][:-1]) == int(new[2][3][-1])
    assert by_id[None][0]["text"].endswith(".org") and by_id[None][0]["text"] != "x@y.example.org"
    assert pii.pseudonymise(df.limit(0), b"key").collect() == []


def test_surrogates_stay_distinct_when_draws_collide(spark):
    import pyarrow as pa

    def narrow(entities, key, round_):
        """Draws that agree for all in round 0, for pairs in round 1, and hit an original."""
        def run(batches):
            for b in batches:
                n = [int(x) for x in b.column(1).to_pylist()]
                s = [str({0: 3, 1: 100 + x // 2}.get(round_, 1000 * round_ + x)) for x in n]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], names=["kind", "normal", "surrogate"])
        return entities.select("kind", "normal").mapInArrow(run, "kind string, normal string, surrogate string")

    entities = spark.createDataFrame([("n", str(i)) for i in range(40)] * 2, "kind string, normal string")
    got = pii.surrogates(entities, b"k", narrow).collect()
    assert len(got) == 40 == len({r["surrogate"] for r in got})
    assert not {r["surrogate"] for r in got} & {str(i) for i in range(40)}


def test_small_classes_get_surrogates(spark):
    """More than half of a class are originals, or it has a single value."""
    def bounded(entities, key, round_):
        assert round_ < 25
        return pii._drawn(entities, key, round_)

    rows = [("phone", f"+1{i:02d}") for i in range(60)] + [("ssn", str(i)) for i in range(6)] + [("secret", "-" * 20), ("email", "_@-.com")]
    rows += [("email", f"{a}@{b}.co") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnop"]
    got = pii.surrogates(spark.createDataFrame(rows, "kind string, normal string"), b"k", bounded).collect()
    given = {(r["kind"], r["surrogate"]) for r in got}
    assert len(got) == len(rows) == len(given) and not given & set(rows)
    assert all(r["surrogate"].startswith("+1") for r in got if r["kind"] == "phone")
    assert all(r["surrogate"].endswith(".co") for r in got if r["kind"] == "email" and r["normal"] != "_@-.com")
    assert pii.dress("phone", "+1 (50)", "+18234") == "+1 (82)34"


def test_phones_have_a_plausible_number_of_digits():
    assert pii.find("+150 and (+199), +1 2 3") == []
    assert [x[3] for x in pii.find("+49 30 123 4567, +12345678901234567890")] == ["+49301234567"]


def test_a_phone_leaves_the_address_behind_it():
    for text in ("+1 (826) 555-4081 190.137.223.204", "+49 30 123 4567 10.2.3.4.", "+1 826 555 4081 1.2.3.4 5"):
        assert [k for _, _, k, _ in pii.find(text)] == ["phone", "ipv4"], text
    assert pii.find("+1 (826) 555-4081 190.137.223.204")[0][3] == "+18265554081"
    # dots alone don't make an address
    assert [x[2:] for x in pii.find("+41 44.123.45.67 +1.826.555.4081")] == [("phone", "+41441234567"), ("phone", "+18265554081")]


def test_keys_of_letters_only_are_found():
    for secret in ("sk-" + "abcdefghij" * 2, "AKIA" + "ABCDEFGHIJKLMNOP", *(f"gh{c}_" + "abcdefghij" * 3 for c in "pousr")):
        assert pii.find(f"the key is {secret} here") == [(11, 11 + len(secret), "secret", secret)], secret


# the patterns as they were before they were made linear: the detector must find the same
_SLOW_MAIL = r"(?P<email>[\w.+%-]*\w[\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"


def _find_slowly(text):
    """The rules applied one position at a time, each pattern tried at each."""
    import re
    patterns = [(k, re.compile(_SLOW_MAIL if k == "email" else p)) for k, p in pii._PATTERNS]
    out, at = [], 0
    while at < len(text):
        hit = next(((k, m) for k, p in patterns if (m := p.match(text, at))), None)
        if hit is None:
            at += 1
            continue
        kind, m = hit
        a, b = m.span()
        if kind == "name":
            words = pii._NAME.match(m[0])[3].split(" ")
            if not words[0][0].isupper():
                at += 1
                continue
            if len(words) > 1 and not (words[1].istitle() or words[0].isupper() and words[1].isupper()):
                b -= len(words[1]) + 1
        if kind == "phone":
            if (b := pii._phone_end(text, a, b)) is None:
                at += 1
                continue
        out.append((a, b, kind, pii._normal(kind, text[a:b])))
        at = b
    return out


def test_find_equals_the_rules_one_position_at_a_time():
    rng = random.Random(12)
    parts = ["a.b", "@", "x.org", "d-e.co", ".", "+", "-", " ", "1", "555-123-4567", "10.2.3.4", "+49 30 123 4567", "Mr ", "Anna", "anna", "漢", "_",
             "%", "4111 1111 1111 1111", "123-45-6789", "DE89 3704 0044 0532 0130 00", '"', "abcdefghijklmnopqrstu", "sk-", "9f" * 17, "\n", "(555) "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        assert pii.find(text) == _find_slowly(text), text
    assert pii.find("(555) 123-4567foo@bar.com")[1][2] == "email"


@pytest.mark.parametrize("text", ["a" * 10**6, "漢" * 10**6, "aGVsbG8+Ly" * 10**5, "9" * 10**6, "." * 10**6, "a.b-" * 250_000, "@a.a" * 250_000,
                                  "+1" * 300_000, "1.2.3.4-" * 60_000, "'" + "a" * 10**6, "Mr " + "a" * 10**6, "ab" * 500_000 + "@", "f" * 10**6])
def test_long_words_take_linear_time(text):
    import time
    start = time.time()
    pii.find(text + " 1@")
    assert time.time() - start < 3


def test_texts_are_searched_once(spark):
    """What is replaced is what the one search found, spans and all."""
    rows = [(i, PRIVATE if i % 3 == 0 else f"plain {i}") for i in range(30)]
    got = pii.pseudonymise(cases.docs(spark, rows), b"key")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(r["n_entities"] for r in got.collect()) == [0] * 20 + [13] * 10
