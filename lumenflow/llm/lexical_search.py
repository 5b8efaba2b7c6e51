"""Ranked lexical search over a length-stratified index.

A document's normaliser ``m`` depends on its length only; a term that occurs tf
times in it scores ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``.  So within
the documents of equal ``m``, a *stratum*, a term's impact is a function of tf
alone.

``build_index``  documents -> the index, two written tables and two numbers.
Documents are taken as they lie, in shards of ``SHARD_BYTES`` of text; a shard's
documents are grouped by ``m``, and a stratum is one row: its document ids and its
postings, grouped by term and then by tf.  Nothing is shuffled but the dictionary
(term, number of documents), one row a term and shard.

``search``  queries -> the ``k`` best documents of each.  A task reads strata,
``VISIT_BYTES`` of them at a time, and bounds each for each query: every term of
the query at its largest tf there.  Each query visits the strata with its highest
bounds first, then the rest in falling order while the bound reaches the k-th
score that the task has found so far; the others are not scored.  A visit computes
the impact once per (term, tf) group, lays it over the group's documents and
multiplies by the weights of the visiting queries.  Tasks return at most ``k`` rows a
query, and the best ``k`` of these are the result.

Scores are 64-bit integers; the products run in doubles where no sum can reach
2**53 (all are exact then) and in integers elsewhere.  Terms are known by 64-bit
hashes.  Queries go to the tasks in batches of about ``BATCH_TERMS`` terms, a batch
a pass over the index.

Defined results: a null text has no term; a document or query without terms, or
whose terms all weigh nothing, is in no result; equal scores are ordered by id, a null
id last; rows that repeat are documents of their own, and so are queries unless id and
text are the same; a very long document is a shard of its own; an empty table of either
kind gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenflow.llm.words import small_batches, span_hash, spans, text_column, text_slices
from lumenflow.session import materialize

K = 20
SHARD_BYTES = 4 << 20       # text of a shard
VISIT_BYTES = 24 << 20      # postings whose bounds are compared at once
FIRST_VISITS = 2            # strata that each query visits before any is passed over
BATCH_TERMS = 400_000       # terms of the queries that one pass answers
CELLS = 1 << 21             # terms x queries of a weight matrix
ROWS = 256                  # documents of a stratum scored at once

_U = np.uint64
_GAP = np.zeros(256, bool)
_GAP[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _terms(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes of several texts, index of each text's first term)."""
    raw = _LOWER[raw]
    s, e, first = spans(_GAP[raw], offs)
    return span_hash(raw, s, e), first


def _slices(batches):
    """(ids, term hashes, first term of each, bytes) of slices of documents."""
    for batch in batches:
        ids = batch.column(0).cast(pa.int64())
        for a, b, raw, offs in text_slices(text_column(batch, "text")):
            yield ids.slice(a, b - a), *_terms(raw, offs), len(raw)


@dataclass(frozen=True)
class Index:
    strata: DataFrame       # _STRATUM
    dictionary: DataFrame   # term long, df long
    n_docs: int             # N: documents with a term
    n_terms: int            # L: all their terms


# a stratum's arrays are little-endian buffers: ids 8 bytes each with a byte mask of
# nulls, and per (term, tf) group the term (8), tf (4) and number of documents (4), then
# the places of the documents in ids (4)
_STRATUM = "m long, ids binary, null_ids binary, terms binary, tfs binary, sizes binary, places binary"


def normaliser(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    # Python integers where the product could pass 64 bits
    wide = len(n) and int(n.max()) * 25 * n_docs >= 1 << 62
    n = n.astype(object) if wide else n.astype(np.int64)
    return (75 + (25 * n * n_docs) // max(n_terms, 1)).astype(np.int64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of equal rows of sorted columns."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _strata_of(ids: list, terms: list, counts: list, n_docs: int, n_terms: int) -> pa.RecordBatch:
    """The strata of one shard."""
    ids = pa.concat_arrays(ids)
    missing = np.asarray(ids.is_null())
    ids = np.asarray(ids.fill_null(0))
    terms, n = np.concatenate(terms), np.concatenate(counts)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((terms, doc))
    terms, doc = terms[order], doc[order]
    head = _runs(doc, terms) if len(terms) else np.empty(0, np.int64)
    tf = np.diff(np.append(head, len(terms)))
    terms, doc = terms[head], doc[head]
    m = normaliser(n, n_docs, n_terms)
    # documents by stratum; a document's place is its number within it
    by_m = np.argsort(m, kind="stable")
    first_doc = _runs(m[by_m])
    stratum = np.empty(len(n), np.int64)
    stratum[by_m] = np.repeat(np.arange(len(first_doc)), np.diff(np.append(first_doc, len(n))))
    place = np.empty(len(n), np.int64)
    place[by_m] = np.arange(len(n)) - np.repeat(first_doc, np.diff(np.append(first_doc, len(n))))
    order = np.lexsort((tf, terms, stratum[doc]))
    s, terms, tf, places = stratum[doc][order], terms[order], tf[order], place[doc][order].astype(np.uint32)
    head = _runs(s, terms, tf) if len(s) else np.empty(0, np.int64)
    sizes = np.diff(np.append(head, len(s))).astype(np.uint32)
    docs_at = np.append(first_doc, len(n))
    posts_at = np.searchsorted(s, np.arange(len(first_doc) + 1))
    groups_at = np.searchsorted(s[head], np.arange(len(first_doc) + 1))
    g_terms, g_tf = terms[head], tf[head].astype(np.uint32)
    rows = []
    for k in range(len(first_doc)):
        d, g, p = (slice(x[k], x[k + 1]) for x in (docs_at, groups_at, posts_at))
        own = by_m[d]
        rows.append((int(m[own[0]]), ids[own].tobytes(), missing[own].tobytes(), g_terms[g].tobytes(),
                     g_tf[g].tobytes(), sizes[g].tobytes(), places[p].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.binary() if i else pa.int64()) for i in range(7)],
        names=["m", "ids", "null_ids", "terms", "tfs", "sizes", "places"])


def build_index(docs: DataFrame) -> Index:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def measure(batches):
        docs, total = 0, 0
        for _, terms, first, _ in _slices(batches):
            docs, total = docs + int(np.count_nonzero(np.diff(first))), total + len(terms)
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([total])], names=["docs", "terms"])

    def strata(n_docs: int, n_terms: int):
        def run(batches):
            ids, terms, counts, size = [], [], [], 0
            for own, found, first, n in _slices(batches):
                ids.append(own)
                terms.append(found)
                counts.append(np.diff(first))
                size += n
                if size >= SHARD_BYTES:
                    yield _strata_of(ids, terms, counts, n_docs, n_terms)
                    ids, terms, counts, size = [], [], [], 0
            if ids:
                yield _strata_of(ids, terms, counts, n_docs, n_terms)
        return run

    with small_batches(docs.sparkSession):
        total = rows.mapInArrow(measure, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
        n_docs, n_terms = total[0] or 0, total[1] or 0
        written = materialize(rows.mapInArrow(strata(n_docs, n_terms), _STRATUM), "strata")
        counted = written.select("terms", "sizes").mapInArrow(_document_counts, "term long, df long")
        dictionary = materialize(counted.groupBy("term").agg(F.sum("df").alias("df")), "dictionary")
    return Index(written, dictionary, n_docs, n_terms)


def _document_counts(batches):
    """(term, documents) summed over a batch of strata."""
    for batch in batches:
        terms = np.concatenate([np.frombuffer(x, _U) for x in batch.column(0).to_pylist()] or [np.empty(0, _U)])
        sizes = np.concatenate([np.frombuffer(x, np.uint32) for x in batch.column(1).to_pylist()] or [np.empty(0, np.uint32)])
        keys, at = np.unique(terms, return_inverse=True)
        df = np.bincount(at, weights=sizes, minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(df)], names=["term", "df"])


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, qkey, term, times): the distinct terms of each query; id and
    ``qkey``, a hash of its text, name a query."""
    def run(batches):
        for batch in batches:
            ids, qkeys = batch.column(0), batch.column(1)
            for a, b, raw, offs in text_slices(text_column(batch, "text")):
                terms, first = _terms(raw, offs)
                for k in range(a, b):
                    own, times = np.unique(terms[first[k - a]:first[k - a + 1]], return_counts=True)
                    row = pa.array(np.full(len(own), k))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(row), qkeys.take(row), pa.array(own.view(np.int64)), pa.array(times.astype(np.int64))],
                        names=["item_id", "qkey", "term", "times"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64(text).alias("qkey"), text.alias("text"))
    return rows.dropDuplicates(["item_id", "qkey"]).mapInArrow(run, "item_id long, qkey long, term long, times long")


@dataclass(frozen=True)
class _Block:
    """Some queries: their vocabulary and the weights of its terms."""
    keys: list              # (item_id, qkey) of each
    vocabulary: np.ndarray  # sorted term hashes
    weights: np.ndarray     # terms x queries: w * times


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(rows: list, n_docs: int) -> list[_Block]:
    """Rows (item_id, qkey, term, times, df) of whole queries as blocks of at most
    ``CELLS`` cells, a block at least one query."""
    queries: dict = {}
    for item, qkey, term, times, df in rows:
        queries.setdefault((item, qkey), []).append((term, _weight(n_docs, df) * times))
    blocks, keys, vocabulary = [], [], set()

    def close():
        known = np.sort(np.array(list(vocabulary), np.int64).view(_U))
        top = max(sum(w for _, w in queries[k]) for k in keys) * 10**6
        weights = np.zeros((len(known), len(keys)), np.float64 if top < 1 << 53 else np.int64)
        for j, k in enumerate(keys):
            at = np.searchsorted(known, np.array([t for t, _ in queries[k]], np.int64).view(_U))
            weights[at, j] = [w for _, w in queries[k]]
        blocks.append(_Block(list(keys), known, weights))

    for key in sorted(queries, key=lambda k: (k[0] is None, k)):
        more = vocabulary | {t for t, _ in queries[key]}
        if keys and len(more) * (len(keys) + 1) > CELLS:
            close()
            keys, more = [], {t for t, _ in queries[key]}
        keys.append(key)
        vocabulary = more
    if keys:
        close()
    return blocks


class _Stratum:
    """A stratum's postings of the terms of one block."""

    def __init__(self, row: tuple, block: _Block) -> None:
        m, self.ids, self.missing, terms, tfs, sizes, places = row
        at = np.minimum(np.searchsorted(block.vocabulary, terms), len(block.vocabulary) - 1)
        held = block.vocabulary[at] == terms
        self.term, tf = at[held], tfs[held].astype(np.int64)
        # the impact, once for each group of equal term and tf
        self.impact = (10**9 * tf) // (1000 * tf + 12 * m)
        self.sizes = sizes[held].astype(np.int64)
        self.places = places[np.repeat(held, sizes)]

    def bounds(self, block: _Block) -> np.ndarray:
        """No document here scores more: each term at its largest tf, which is the
        last of its groups."""
        last = np.flatnonzero(np.diff(self.term, append=-1))
        return self.impact[last].astype(block.weights.dtype) @ block.weights[self.term[last]]

    def scores(self, block: _Block, visitors: np.ndarray):
        """(first place, scores) of ``ROWS`` documents by visitors at a time."""
        terms, column = np.unique(self.term, return_inverse=True)
        weights = block.weights[np.ix_(terms, visitors)]
        column, impact = np.repeat(column, self.sizes), np.repeat(self.impact, self.sizes)
        order = np.argsort(self.places, kind="stable")
        places, column, impact = self.places[order].astype(np.int64), column[order], impact[order]
        for a in range(0, len(self.ids), ROWS):
            lo, hi = np.searchsorted(places, [a, a + ROWS])
            if lo == hi:
                continue
            grid = np.zeros((min(ROWS, len(self.ids) - a), len(terms)), weights.dtype)
            grid[places[lo:hi] - a, column[lo:hi]] = impact[lo:hi]
            yield a, grid @ weights


class _Best:
    """The best k (score, id) of each query that a task has seen."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.least = k, np.ones(queries)
        none = np.empty(0, np.int64)
        self.found = [(none, none, none) for _ in range(queries)]      # score, null id, id

    def add(self, j: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        scores, missing, ids = (np.concatenate(x) for x in zip(self.found[j], (scores, missing, ids)))
        order = np.lexsort((ids, missing, -scores))[:self.k]
        self.found[j] = scores[order], missing[order], ids[order]
        if len(order) == self.k:
            self.least[j] = max(1, scores[order[-1]])


def _visit(rows: list, block: _Block, best: _Best) -> None:
    strata = [_Stratum(row, block) for row in rows]
    bounds = np.array([s.bounds(block) for s in strata])
    seen = np.zeros(bounds.shape, bool)

    def score(k: int, visitors: np.ndarray) -> None:
        s = strata[k]
        seen[k, visitors] = True
        for a, found in s.scores(block, visitors):
            good = found >= best.least[visitors]
            for i in np.flatnonzero(good.any(axis=0)):
                at = np.flatnonzero(good[:, i])
                best.add(visitors[i], found[at, i].astype(np.int64), s.missing[a + at].astype(np.int64), s.ids[a + at])

    first = np.zeros(bounds.shape, bool)
    top = np.argsort(-bounds, axis=0, kind="stable")[:FIRST_VISITS]
    np.put_along_axis(first, top, True, axis=0)
    for wanted in (first, None):
        for k in np.argsort(-bounds.max(axis=1), kind="stable").tolist():
            visitors = np.flatnonzero((bounds[k] >= best.least) & ~seen[k] & (True if wanted is None else wanted[k]))
            if len(visitors):
                score(k, visitors)


def _search_strata(blocks, k: int):
    def decoded(batch):
        kinds = (np.int64, bool, _U, np.uint32, np.uint32, np.uint32)
        for m, *buffers in zip(*(c.to_pylist() for c in batch.columns)):
            yield (m, *(np.frombuffer(x, t) for x, t in zip(buffers, kinds))), sum(map(len, buffers))

    def run(batches):
        mine = blocks.value
        best = [_Best(len(b.keys), k) for b in mine]
        rows, size = [], 0

        def visit():
            for block, found in zip(mine, best):
                _visit(rows, block, found)

        for batch in batches:
            for row, n in decoded(batch):
                rows.append(row)
                size += n
                if size >= VISIT_BYTES:
                    visit()
                    rows, size = [], 0
        if rows:
            visit()
        out = [(*block.keys[j], None if gone else doc, score)
               for block, found in zip(mine, best) for j, top in enumerate(found.found)
               for score, gone, doc in zip(*(x.tolist() for x in top))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)],
                                         names=["item_id", "qkey", "doc_id", "score"])
    return run


def search(index: Index, queries: DataFrame, k: int = K) -> DataFrame:
    """(item_id, qkey, rank, doc_id, score): the ``k`` documents of highest score
    above 0 of each query (all, if fewer)."""
    spark: SparkSession = queries.sparkSession
    schema = "item_id long, qkey long, doc_id long, score long"
    known = materialize(query_terms(queries).join(index.dictionary, "term"), "queries")
    n_batches = -(-known.count() // BATCH_TERMS)
    batch = F.pmod(F.xxhash64("item_id", "qkey", F.lit(1)), F.lit(max(1, n_batches)))
    found = spark.createDataFrame([], schema)
    for b in range(n_batches):
        rows = known.where(batch == b).select("item_id", "qkey", "term", "times", "df").collect()
        blocks = spark.sparkContext.broadcast(_blocks([tuple(r) for r in rows], index.n_docs))
        with small_batches(spark, 64):      # strata are large rows
            found = found.unionByName(materialize(index.strata.mapInArrow(_search_strata(blocks, k), schema), "found"))
        blocks.unpersist()
    order = Window.partitionBy("item_id", "qkey").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    # row_number up to a constant is cut in each task before the shuffle as well
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "qkey", "rank", "doc_id", "score"))
