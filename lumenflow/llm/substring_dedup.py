"""Substring dedup: repeated passages found with suffix automata of shards.

A window is ``WINDOW`` consecutive words of one document; every word covered by
a window whose words also start anywhere else goes, all occurrences included.

1. ``anchors``: each window chooses one of its ``GRAM``-word grams, the one with
   the smallest hash (the last of equal ones).  Equal windows choose the same
   gram at the same place, so they meet under its hash.  The consecutive
   windows that choose the same occurrence form one passage; passages part the
   windows of a document, and are about one for every 15 words.
2. Anchors that occur once are dropped.  Passages that are equal as a whole are
   repeated as a whole.
3. The different passages of an anchor are the reference shard of their windows.
   A shard's passages are read into one suffix automaton, whose states know how
   often their words occur; each passage then streams through it for its
   matching statistics, the longest suffix at each word that occurs elsewhere,
   and the spans where it reaches ``WINDOW`` are marked.  A shard is bounded by
   ``SHARD_WORDS``; automata stay in the task that owns the shard, and passages
   are dealt to it by anchor rather than every automaton to every document,
   which would be work with the square of the corpus.
4. An anchor with more than ``WIDE`` different passages (the edge of a passage
   that very many documents share) would not fit one shard: its windows are
   counted by their hash instead, in as many tasks as there are.
5. The marked spans go back to the documents, which are rewritten whole.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` as they stand; a null or empty
text has none (and the hash of the empty string); documents of fewer than
``WINDOW`` words keep all; rows that repeat lose every window; an empty table
gives none; other columns are untouched by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.llm.words import small_batches, span_hash, text_column, text_slices, word_spans
from lumenflow.session import materialize

WINDOW = 35
GRAM = 8
SHARD_WORDS = 40_000
WIDE = 4_000                # different passages of an anchor that one automaton may read

_U = np.uint64
_PLACE = 28                 # bits of a gram's place in the key that orders grams
_ANCHOR = "doc_id long, tkey long, anchor long, passage long, start int, n int"


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    m = x
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def passages(words: np.ndarray, first: np.ndarray):
    """(text, first window, windows, anchor, hash) of each passage of some texts."""
    n = len(words)
    if n < WINDOW:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),) * 2
    at = np.arange(n - GRAM + 1)
    gram = span_hash(words, at, at + GRAM)
    key = (gram >> _U(_PLACE) << _U(_PLACE)) | _U((1 << _PLACE) - 1) - at.astype(_U)
    chosen = (1 << _PLACE) - 1 - (_sliding_min(key, WINDOW - GRAM + 1) & _U((1 << _PLACE) - 1)).astype(np.int64)
    text = np.searchsorted(first, np.arange(len(chosen)), side="right") - 1
    inside = np.arange(len(chosen)) + WINDOW <= first[text + 1]
    window = np.flatnonzero(inside)
    if not len(window):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),) * 2
    new = np.ones(len(window), bool)
    new[1:] = (chosen[window[1:]] != chosen[window[:-1]]) | (text[window[1:]] != text[window[:-1]])
    head = np.flatnonzero(new)
    start = window[head]
    count = np.diff(np.append(head, len(window)))
    return text[start], start, count, gram[chosen[start]], span_hash(words, start, start + count + WINDOW - 1)


def anchors(docs: DataFrame) -> DataFrame:
    """The passages of every document: ``_ANCHOR``; ``start`` is a word index."""
    def run(batches):
        for batch in batches:
            ids, tkeys = batch.column(0), batch.column(1)
            for a, _, raw, offs in text_slices(text_column(batch, "text")):
                s, e, first = word_spans(raw, offs)
                text, start, count, anchor, whole = passages(span_hash(raw, s, e), first)
                row = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), tkeys.take(row), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array((start - first[text]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["doc_id", "tkey", "anchor", "passage", "start", "n"])

    return _keyed(docs).mapInArrow(run, _ANCHOR)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with occurrence counts."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.times = [-1], [0], [0]

    def _state(self, size: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.times.append(0)
        return len(self.size) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of (p's longest) + word, cut out of a longer one if need be."""
        nxt, size, link = self.next, self.size, self.link
        q = nxt[p][word]
        if size[q] == size[p] + 1:
            return q
        clone = self._state(size[p] + 1, link[q], dict(nxt[q]))
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def add(self, words: list[int], times: int) -> None:
        nxt, size, link = self.next, self.size, self.link
        last = 0
        for word in words:
            if word in nxt[last]:
                last = self._split(last, word)
            else:
                new = self._state(size[last] + 1, 0, {})
                p = last
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, word)
                last = new
            self.times[last] += times

    def finish(self) -> None:
        """Counts of shorter words include those of the longer ones they end."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.times[self.link[state]] += self.times[state]
        self.times[0] = 2

    def statistics(self, words: list[int]) -> np.ndarray:
        """At each word, the length of the longest suffix that occurs twice."""
        nxt, size, link, times = self.next, self.size, self.link, self.times
        out, state, length = np.empty(len(words), np.int64), 0, 0
        for i, word in enumerate(words):
            state, length = nxt[state][word], length + 1
            while times[state] < 2:
                state = link[state]
                length = size[state]
            out[i] = length
        return out


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


_SPAN = "anchor long, passage long, lo int, hi int"


def _match_shards(batches):
    """Marked windows [lo, hi) of the passages of a stream sorted by anchor."""
    def marked(shard):
        automaton = SuffixAutomaton()
        for _, _, times, words in shard:
            automaton.add(words, times)
        automaton.finish()
        rows = []
        for anchor, passage, _, words in shard:
            lo, hi = _runs(automaton.statistics(words)[WINDOW - 1:] >= WINDOW)
            rows += [(anchor, passage, int(a), int(b)) for a, b in zip(lo, hi)]
        return rows

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["anchor", "passage", "lo", "hi"])

    shard, size, rows = [], 0, []
    for batch in batches:
        for item in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= SHARD_WORDS and item[0] != shard[-1][0]:      # an anchor stays whole
                rows += marked(shard)
                shard, size = [], 0
            shard.append(item)
            size += len(item[3])
        if rows:
            yield batch_of(rows)
            rows = []
    rows = marked(shard) if shard else []
    if rows:
        yield batch_of(rows)


def _windows(batches):
    """Hash and place of every window of the passages."""
    for batch in batches:
        for anchor, passage, times, words in zip(*(c.to_pylist() for c in batch.columns)):
            words = np.array(words, np.int64).view(_U)
            at = np.arange(len(words) - WINDOW + 1)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(span_hash(words, at, at + WINDOW).view(np.int64)), pa.array(np.full(n, anchor)),
                 pa.array(np.full(n, passage)), pa.array(np.full(n, times)), pa.array(at.astype(np.int32))],
                names=["hash", "anchor", "passage", "times", "lo"])


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, passage, times, words) of the passages ``wanted``, each taken
    from one document that holds it."""
    lists = wanted.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("anchor", "passage", "times", "start", "n")).alias("items"))
    texts = _keyed(docs).alias("d").join(
        lists.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tkey") == F.col("w.tkey"))).select(
        "text", "items")

    def run(batches):
        for batch in batches:
            column = text_column(batch, "text")
            items = batch.column(1).to_pylist()
            out = []
            for a, b, raw, offs in text_slices(column):
                s, e, first = word_spans(raw, offs)
                words = span_hash(raw, s, e).view(np.int64)
                for k in range(a, b):
                    own = words[first[k - a]:first[k - a + 1]]
                    out += [(i["anchor"], i["passage"], i["times"], own[i["start"]:i["start"] + i["n"] + WINDOW - 1]) for i in items[k]]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                    names=["anchor", "passage", "times", "words"])

    # rows that repeat id and text bring the same passage twice
    return (texts.mapInArrow(run, "anchor long, passage long, times long, words array<long>")
            .dropDuplicates(["anchor", "passage"]))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, spans): word ranges [from, to) that repeated windows cover."""
    with small_batches(docs.sparkSession):
        found = materialize(anchors(docs), "anchors")
    # written, so that the join deals both sides itself and can split a hot anchor
    often = materialize(found.groupBy("anchor").agg(F.count("*").alias("total")).where("total > 1").select("anchor"), "often")
    found = materialize(found.join(often, "anchor", "left_semi"), "repeated")
    kinds = found.groupBy("anchor", "passage").agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "tkey", "start", "n")).alias("at"))
    kinds = materialize(kinds.select("anchor", "passage", "times", "at.*"), "kinds")
    whole = kinds.where("times > 1").select("anchor", "passage", F.lit(0).alias("lo"), F.col("n").alias("hi"))

    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    with small_batches(docs.sparkSession):
        held = materialize(_words_of(docs, kinds.join(several.select("anchor"), "anchor", "left_semi")), "passages")
    routed = held.join(several, "anchor")
    narrow = routed.where(F.col("kinds") <= WIDE).select("anchor", "passage", "times", "words")
    spans = narrow.repartition("anchor").sortWithinPartitions("anchor", "passage").mapInArrow(_match_shards, _SPAN)
    wide = (routed.where(F.col("kinds") > WIDE).select("anchor", "passage", "times", "words")
            .mapInArrow(_windows, "hash long, anchor long, passage long, times long, lo int"))
    again = wide.groupBy("hash").agg(F.sum("times").alias("n")).where("n > 1").select("hash")
    counted = wide.join(again, "hash", "left_semi").select("anchor", "passage", "lo", (F.col("lo") + 1).alias("hi"))

    marks = whole.unionByName(spans).unionByName(counted).distinct()
    return (found.join(marks, ["anchor", "passage"])
            .select("doc_id", "tkey", (F.col("start") + F.col("lo")).alias("a"), (F.col("start") + F.col("hi") + (WINDOW - 1)).alias("b"))
            .groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("a", "b")).alias("spans")))


def _with_spans(docs: DataFrame, columns: list[str]) -> DataFrame:
    spans = repeated_spans(docs).select(F.col("doc_id").alias("_lf_id"), F.col("tkey").alias("_lf_key"), F.col("spans").alias("_lf_spans"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = docs.select(*columns).withColumns({"_lf_own": F.col("doc_id").cast("long"), "_lf_text": F.xxhash64(text)})
    return mine.join(spans, F.col("_lf_own").eqNullSafe(F.col("_lf_id")) & (F.col("_lf_text") == F.col("_lf_key")), "left").select(*columns, "_lf_spans")


def _kept_texts(batch: pa.RecordBatch):
    """(words, words removed, kept words joined by one space) of each row."""
    spans = batch.column(batch.schema.get_field_index("_lf_spans")).to_pylist()
    for a, b, raw, offs in text_slices(text_column(batch, "text")):
        data = raw.tobytes()
        s, e, first = word_spans(raw, offs)
        for k in range(a, b):
            ws, we = s[first[k - a]:first[k - a + 1]], e[first[k - a]:first[k - a + 1]]
            gone = np.zeros(len(ws) + 1, np.int32)
            for span in spans[k] or ():
                gone[span["a"]] += 1
                gone[span["b"]] -= 1
            keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            yield len(ws), len(ws) - len(keep), b" ".join([data[x:y] for x, y in zip(ws[keep].tolist(), we[keep].tolist())])


def repeat_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    def run(batches):
        for batch in batches:
            rows = [(n, gone, hashlib.sha256(kept).hexdigest()) for n, gone, kept in _kept_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_spans(docs, ["doc_id", "text"]).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows cut out of the text (kept words joined by
    one space; texts that lose nothing stay as they are); all columns."""
    names, schema = docs.columns, docs.schema
    place = names.index("text")

    def run(batches):
        for batch in batches:
            old = text_column(batch, "text")
            new = [kept.decode("utf-8", "replace") if gone else None for _, gone, kept in _kept_texts(batch)]
            column = pa.array([o.as_py() if n is None else n for o, n in zip(old, new)], batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([column if i == place else batch.column(i) for i in range(len(names))], names=names)

    return _with_spans(docs, names).mapInArrow(run, T.StructType(schema.fields))
