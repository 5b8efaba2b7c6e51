"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding.

Folding undoes disguise: compatibility forms and case, letters of other
scripts that look Latin, digits and signs that stand for letters; marks become
spaces, so a term may ask for a word's edge.  Accents stay, as they carry
meaning.

``learn``  labelled rows -> a ``Lexicon``: terms (parts of words, or words) with
           their log odds, exception phrases in which terms do not count, and a
           logistic model of the length-normalised evidence
``score``  every whole text -> score, predicted
``drop_toxic``  the documents that are not predicted toxic

The fit uses at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled rows, the ones
with the smallest hash of their id; scoring reads all of every text.

Defined results: null and empty texts carry no evidence and get the model's
lowest score; rows repeat as they come; without labelled rows of both classes
all scores are 0; conflicting labels of an id count as toxic; other columns are
ignored (``score``) or kept (``drop_toxic``).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm.words import small_batches, text_lists
from lumenflow.session import materialize

MAX_TOXIC = 4_000           # labelled rows that the fit reads at most
MAX_CLEAN = 12_000
MAX_TERMS = 2_000           # terms of the lexicon
MIN_DOCS = 5                # toxic documents that must hold a term ...
MIN_SHARE = 0.005           # ... and their share of the toxic documents
MIN_LOG_ODDS = 1.5
MIN_G2 = 30.0               # and the evidence against chance (likelihood ratio), as very many terms are tried
GRAMS = range(3, 9)         # lengths of parts of words
EXCEPTION_DOCS = 3          # clean documents that must hold an exception phrase
CUT = 0.5

# fixed values: look-alike letters, and signs that stand for letters
_ALIKE = dict(zip("авеікмнорстухѕјԁɡαβεικμνορτυχγ", "abeikmhopctyxsjdgabeikmvoptuxy"))
_DIGITS = dict(zip("013457", "oieast"))
_SIGNS = {"!": "i", "@": "a", "$": "s"}
_MARKS = ".,;:\"'()|#&%*?!@$\n\t\r\x0b\x0c-_=+/\\<>[]{}~^`"
_TABLE = {ord(a): b for a, b in (_ALIKE | _DIGITS).items()} | {ord(a): " " for a in _MARKS}
_SIGN = re.compile(r"[!@$](?=[^\W\d_])")


def fold(text: str) -> str:
    """Folded words, parted by one space, with a space at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "!" in text or "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: _SIGNS[m[0]], text)
    return " " + " ".join(text.translate(_TABLE).split()) + " "


@dataclass
class Lexicon:
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def automaton(self):
        """None for an empty lexicon."""
        import ahocorasick
        if not self.terms:
            return None
        a = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            a.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), 0.0))
        a.make_automaton()
        return a


def _unshielded(hits: list, shields: list) -> list:
    """Hits that lie in no shield.  Both come in the order of their ends; from the last
    on, the least start of the shields that end at or behind a hit decides."""
    kept, least = [], math.inf
    for hit in reversed(hits):
        while shields and shields[-1][1] >= hit[1]:
            least = min(least, shields.pop()[0])
        if hit[0] < least:
            kept.append(hit)
    return kept[::-1]


def evidence(automaton, folded: str) -> tuple[float, float, float, float]:
    """(weight per 100 characters, largest weight, log weight, matches per 100
    characters); a term inside an exception phrase does not count."""
    hits, shields = [], []
    for end, (size, weight) in (automaton.iter(folded) if automaton else ()):
        (hits if weight else shields).append((end + 1 - size, end + 1, weight))
    if shields:
        hits = _unshielded(hits, shields)
    if not hits:
        return 0.0, 0.0, 0.0, 0.0
    total = sum(h[2] for h in hits)
    return 100 * total / len(folded), max(h[2] for h in hits), math.log1p(total), 100 * len(hits) / len(folded)


def _parts(word: str) -> tuple[str, ...]:
    padded = f" {word} "
    return tuple({padded[i:i + n] for n in GRAMS for i in range(len(padded) - n + 1)})


def training_rows(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """The bounded sample: (text, toxic), labels of held-out ids never read."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = (marked.where("toxic = 1").orderBy(*order).limit(MAX_TOXIC)
            .unionByName(marked.where("toxic = 0").orderBy(*order).limit(MAX_CLEAN)))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(some), "doc_id").select("text", "toxic"))     # at most MAX_TOXIC + MAX_CLEAN ids


def _texts(batches):
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for a, texts in text_lists(batch, "text"):
            yield from zip(texts, labels[a:a + len(texts)])


def _term_counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    terms = sorted(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()),
         pa.array([clean[t] for t in terms], pa.int64())], names=["term", "toxic", "clean"])


def _count_terms(batches):
    toxic, clean, known = Counter(), Counter(), {}
    for text, label in _texts(batches):
        parts: set[str] = set()
        for word in set(fold(text or "").split()):
            if word not in known:
                known[word] = _parts(word)
            parts.update(known[word])
        (toxic if label else clean).update(parts)
        if len(known) > 5_000:
            known.clear()
        if len(toxic) + len(clean) > 120_000:       # counts so far; they are summed after the shuffle
            yield _term_counts(toxic, clean)
            toxic, clean = Counter(), Counter()
    yield _term_counts(toxic, clean)


def _phrases(terms: dict[str, float]):
    """Word pairs around a term, by class, once a text."""
    def run(batches):
        automaton = Lexicon(terms).automaton()
        toxic, clean = Counter(), Counter()
        for text, label in _texts(batches):
            folded, found = fold(text or ""), set()
            for end, (size, _) in automaton.iter(folded):
                a = folded.rfind(" ", 0, max(end + 1 - size, 0) + 1)
                b = folded.find(" ", end)
                if a < 0 or b < 0 or b <= a:
                    continue
                before, after = folded.rfind(" ", 0, max(a, 0)), folded.find(" ", b + 1)
                if before >= 0:
                    found.add(folded[before:b + 1])
                if after >= 0:
                    found.add(folded[a:after + 1])
            (toxic if label else clean).update(found)
        yield _term_counts(toxic, clean)
    return run


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps, classes weighted 2 : 1."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    weight, b = np.where(y == 1, 2.0, 1.0), np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        hessian = z.T @ (z * (weight * p * (1 - p))[:, None]) + np.eye(len(b))
        step = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - b)
        b = b + step
        if abs(step).max() < 1e-9:
            break
    return centre, scale, b


def learn(docs: DataFrame, labels: DataFrame, held_out) -> Lexicon:
    """``held_out``: a function of the id column, true for rows not to learn from."""
    with small_batches(docs.sparkSession):
        return _learn(docs, labels, held_out)


def _learn(docs: DataFrame, labels: DataFrame, held_out) -> Lexicon:
    rows = materialize(training_rows(docs, labels, held_out), "labelled")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon()
    spread = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    least = max(MIN_DOCS, MIN_SHARE * n_toxic)
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0)))
    n_all, share = n_toxic + n_clean, n_toxic / (n_toxic + n_clean)

    def cell(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    a, b = F.col("toxic"), F.col("clean")
    g2 = 2 * (cell(a, (a + b) * share) + cell(b, (a + b) * (1 - share))
              + cell(F.lit(n_toxic) - a, (n_all - a - b) * share) + cell(F.lit(n_clean) - b, (n_all - a - b) * (1 - share)))
    strong = (spread.mapInArrow(_count_terms, "term string, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where(F.col("toxic") >= least).withColumn("weight", odds)
              .where((F.col("weight") >= MIN_LOG_ODDS) & (g2 >= MIN_G2)))
    # a part of a longer term with the same documents says nothing more
    inner = strong.select(F.explode(F.array(F.expr("substring(term, 2)"), F.expr("substring(term, 1, length(term) - 1)"))).alias("term"), "toxic", "clean").distinct()
    own = strong.join(inner, ["term", "toxic", "clean"], "left_anti")
    top = own.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term").limit(MAX_TERMS).select("term", "weight").collect()
    terms = {r["term"]: r["weight"] for r in top}
    if not terms:
        return Lexicon()
    shields = (spread.mapInArrow(_phrases(terms), "term string, toxic long, clean long")
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where((F.col("toxic") == 0) & (F.col("clean") >= max(EXCEPTION_DOCS, MIN_SHARE * n_clean)))
               .orderBy(F.desc("clean"), "term").limit(MAX_TERMS).collect())
    lexicon = Lexicon(terms, [r["term"] for r in shields if r["term"] not in terms])

    def measure(batches):
        automaton = lexicon.automaton()
        found = [(*evidence(automaton, fold(text or "")), float(label)) for text, label in _texts(batches)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.float64()) for i in range(5)],
                                         names=["a", "b", "c", "d", "y"])

    table = spread.mapInArrow(measure, "a double, b double, c double, d double, y double").orderBy("a", "b", "c", "d", "y").collect()
    m = np.array([tuple(r) for r in table])
    lexicon.centre, lexicon.scale, lexicon.weights = _fit(m[:, :4], m[:, 4])
    return lexicon


def _scores(batch: pa.RecordBatch, automaton, lexicon: Lexicon) -> np.ndarray:
    if lexicon.weights is None:
        return np.zeros(batch.num_rows)
    x = np.array([evidence(automaton, fold(t or "")) for _, texts in text_lists(batch, "text") for t in texts]).reshape(-1, 4)
    z = np.c_[np.ones(len(x)), (x - lexicon.centre) / lexicon.scale] @ lexicon.weights
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, predicted) of every row; labels, language, source and id
    are not looked at."""
    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            p = _scores(batch, automaton, lexicon)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= CUT).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def crc_held_out(doc_id):
    """A fifth of the ids, by CRC-32 of their decimal form."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows that are not predicted toxic; all columns.  Each row is judged
    where it lies, so nothing is shuffled."""
    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, automaton, lexicon) < CUT, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
