"""MinHash near-deduplication by improved consistent weighted sampling (ICWS).

A text is the weighted set of its ``N_GRAM``-word shingles; a shingle weighs
(times in the text) x (inverse document frequency).  Two texts are linked if
their weighted Jaccard similarity, sum of minima over sum of maxima, is at
least ``threshold``; classes are the connected components of the links.

Document frequency: the share of all documents that hold the shingle, exact
where it is at least ``COMMON`` of them and taken as ``COMMON`` below, so that
what two copies alone share weighs no less than what is unique to one.  The
frequency scales the weight between 1 (in every document) and 2.

ICWS: for a shingle and a sample number, r and c ~ Gamma(2, 1), b ~ U(0, 1);
t = floor(ln w / r + b), a = c exp(-r (t - b) - r), and the shingle with the
smallest a is the sample (shingle, t).  Write r = X + Y, b = X / r, c = A + V
with Y = ln(c / A): then A, V, X are independent Exp(1) variables, and
a = A exp(-r t).  At the commonest weight (once in the text, not common in the
corpus: ln w = 0) t is 0 and a is A, so the smallest hash decides; only the
other shingles need the full formula.

Samples form ``BANDS`` bands of ``ROWS``.  Texts that share a band belong to one
family (links from the smallest member of a text's bands' groups to the text and to the
other groups' smallest, and components of these links, so a group costs as many rows as
it has members).  All texts of a
family are compared exactly, in blocks of ``BLOCK`` texts: a task gets two
blocks, compares every pair by one matrix product and returns a spanning forest
of the links, so no pair of texts is ever a row and no link's class is lost.
A large family is many pairs of blocks, dealt over the tasks; equal texts are
one member.

Defined results: a text without words (null, empty, white space) is a class of
its own; a text of fewer than five words is one shingle; rows with the same
words are one class; an empty table gives an empty result; a row with a null
``doc_id`` takes part and is never the one that stays unless alone; other
columns are untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm.components import components
from lumenflow.llm.words import mix, small_batches, span_hash, text_column, text_slices, word_hashes, word_spans
from lumenflow.session import materialize

N_GRAM = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 5
COMMON = 0.01               # document frequency below which the weight no longer rises
BLOCK = 192                 # texts of a family that are compared at once, twice that a task
STRIP = 4096                # columns of a block's matrix at once
BLOCK_BYTES = 6 << 20       # text whose shingles a task counts at once
SEED = 20240607

_U = np.uint64
_rng = np.random.default_rng(SEED)
_GRAM = _rng.integers(1, 1 << 63, N_GRAM, dtype=np.uint64) * _U(2) + _U(1)
_MULTIPLY = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_UNIT = 2.0 ** -52


def shingle_hashes(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts (``first``: index of each text's first word,
    total at the end): (hashes, index of each text's first shingle)."""
    n = np.diff(first)
    count = np.where(n >= N_GRAM, n - N_GRAM + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(at[-1]) - np.repeat(at[:-1] - first[:-1], count)
    padded = np.concatenate([words, np.zeros(N_GRAM, _U)])
    size = np.repeat(np.minimum(n, N_GRAM), count)
    h = size.astype(_U)
    for k in range(N_GRAM):
        h = h + np.where(k < size, padded[start + k], _U(0)) * _GRAM[k]
    return mix(h), at


def _distinct(shingles: np.ndarray, at: np.ndarray):
    """Per text its distinct shingles, with their counts."""
    text = np.repeat(np.arange(len(at) - 1, dtype=_U), np.diff(at))
    bits = _U(max(1, int(len(at) - 1).bit_length()))
    # one sort key: the text, then the shingle without its lowest bits (two
    # shingles of a text that differ in those only would, at worst, stay apart)
    order = np.argsort((text << (_U(64) - bits)) | (shingles >> bits))
    s, d = shingles[order], text[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(s)))
    return s[first], count, np.searchsorted(d[first], np.arange(len(at), dtype=_U))


def _weights_log(s: np.ndarray, count: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """ln of weight / 2 (the weight of a shingle that is rare and there once)."""
    logs = np.log(count)
    keys, scale = common
    if len(keys):
        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
        hit = keys[at] == s
        logs[hit] += np.log(scale[at[hit]] / 2)
    return logs


def _exp1(x: np.ndarray) -> np.ndarray:
    """Exp(1) variables from hashes, increasing in them."""
    return -np.log1p(-((x >> _U(12)).astype(np.float64) + 0.5) * _UNIT)


def sample(s: np.ndarray, logs: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k-th ICWS sample of each text, as one hash of (shingle, t)."""
    n = len(at) - 1
    v = s * _MULTIPLY[k] + _ADD[k]
    plain = logs == 0
    out, least = np.zeros(n, _U), np.full(n, np.inf)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    low = np.minimum.reduceat(np.where(plain, v, _U(0xFFFFFFFFFFFFFFFF)), at[full])
    any_plain = np.maximum.reduceat(plain, at[full])
    out[full] = mix(low)
    least[full] = np.where(any_plain, _exp1(low), np.inf)
    odd = np.flatnonzero(~plain)
    if len(odd):
        text = np.searchsorted(at, odd, side="right") - 1
        vo, w = v[odd], logs[odd]
        a1, x = _exp1(vo), _exp1(mix(vo ^ _U(0xA5A5A5A5DEADBEEF)))
        # a >= A exp(-(ln w + X)) for heavier shingles, >= A for lighter ones
        near = np.flatnonzero(a1 * np.where(w > 0, np.exp(-w - x), 1.0) <= least[text])
        text, vo, w, a1, x = text[near], vo[near], w[near], a1[near], x[near]
        c = a1 + _exp1(mix(vo ^ _U(0x5A5A5A5A0BADF00D)))
        r = x + np.log(c / a1)
        t = np.floor(w / r + x / r)
        a = a1 * np.exp(-r * t)
        order = np.lexsort((vo, a, text))
        text, a, vo, t = text[order], a[order], vo[order], t[order]
        best = np.flatnonzero(np.diff(text, prepend=-1))
        best = best[a[best] < least[text[best]]]
        out[text[best]] = mix(vo[best] ^ mix(t[best].astype(np.int64).astype(_U)))
    return out


def _slices(batches):
    """(rows, word hashes, first word of each, bytes) of each slice of texts."""
    for batch in batches:
        for a, b, raw, offs in text_slices(text_column(batch, "text")):
            s, e, first = word_spans(raw, offs)
            yield batch.slice(a, b - a), span_hash(raw, s, e), first, len(raw)


def _counted(batches):
    """Blocks of slices: (documents, shingles with the number of documents).  What is left
    at the end joins the block before it: a block of few documents would name nearly all
    of its shingles (a task of less than one block still does)."""
    held, parts, docs, size = None, [], 0, 0
    for part, words, first, n in _slices(batches):
        parts.append(_distinct(*shingle_hashes(words, first))[0])
        docs, size = docs + part.num_rows, size + n
        if size >= BLOCK_BYTES:
            if held:
                yield held
            held = (docs, *np.unique(np.concatenate(parts), return_counts=True))
            parts, docs, size = [], 0, 0
    if docs:
        keys, count = np.unique(np.concatenate(parts), return_counts=True)
        if held:
            before, docs = held, docs + held[0]
            keys, at = np.unique(np.concatenate([before[1], keys]), return_inverse=True)
            count = np.bincount(at, weights=np.concatenate([before[2], count]), minlength=len(keys)).astype(np.int64)
        held = (docs, keys, count)
    if held:
        yield held


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in at least ``COMMON`` of the documents, weight scale 1..2).

    Two passes.  First, each block of documents names the shingles in at least
    half that share of the block; one that reaches the share overall must have
    been named by blocks that hold half of that count, so at most
    2 x (shingles a document) / ``COMMON`` stay, whatever the corpus's size.
    Second, these are counted exactly.  The result obeys the same bound
    (a few MB) and is broadcast.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"))

    def name(batches):
        for n, keys, count in _counted(batches):
            least = max(1, int(np.ceil(COMMON * n / 2)))
            hot = count >= least
            k = np.append(keys[hot].view(np.int64), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array(np.append(count[hot], 0).astype(np.int64)),
                 pa.array(np.full(len(k), least - 1, np.int64)),
                 pa.array(np.append(np.zeros(len(k) - 1, np.int64), n))],
                names=["shingle", "n", "slack", "docs"])

    named = materialize(rows.mapInArrow(name, "shingle long, n long, slack long, docs long"), "named")
    n_docs, slack = named.where("docs > 0").agg(F.sum("docs"), F.sum("slack")).first()
    if not n_docs:
        return np.empty(0, _U), np.empty(0)
    least = COMMON * n_docs
    able = (named.where("docs = 0").groupBy("shingle").agg(F.sum("n").alias("n"), F.sum("slack").alias("s"))
            .where(F.col("n") + slack - F.col("s") >= least).select("shingle"))
    keys = np.sort(np.array([r[0] for r in able.collect()], np.int64).view(_U))

    def count(batches):
        top = np.zeros(1 << 20, bool)
        top[keys >> _U(44)] = True
        total = np.zeros(len(keys), np.int64)
        for _, words, first, _ in _slices(batches):
            s, at = shingle_hashes(words, first)
            maybe = np.flatnonzero(top[s >> _U(44)])
            where = np.minimum(np.searchsorted(keys, s[maybe]), len(keys) - 1)
            hit = keys[where] == s[maybe]
            text = np.searchsorted(at, maybe[hit], side="right")
            pairs = np.unique(text.astype(np.int64) * len(keys) + where[hit])     # once a document
            np.add.at(total, pairs % len(keys), 1)
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[some])],
                                         names=["shingle", "n"])

    if not len(keys):
        return np.empty(0, _U), np.empty(0)
    exact = rows.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = exact.where(F.col("n") >= least).collect()
    keys = np.array([r[0] for r in found], np.int64).view(_U)
    order = np.argsort(keys)
    share = np.array([r[1] for r in found], float)[order] / n_docs
    return keys[order], 1 + np.log(1 / share) / np.log(1 / COMMON)


_SIGNED = "doc_id long, tkey long, node binary, bands array<long>"


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, text): an id may repeat, id and text together name a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def signatures(docs: DataFrame, common) -> DataFrame:
    """(doc_id, tkey, node, bands): ``node`` is 128 bits of the word sequence
    (null without words), ``bands`` a hash of each band's samples."""

    def sign(batches):
        table = common.value
        for part, words, first, _ in _slices(batches):
            n = part.num_rows
            s, count, at = _distinct(*shingle_hashes(words, first))
            logs = _weights_log(s, count, table)
            bands = np.empty((n, BANDS), _U)
            for b in range(BANDS):
                h = np.full(n, b, _U)
                for k in range(b * ROWS, (b + 1) * ROWS):
                    h = mix(h * _U(0x9E3779B97F4A7C15) + sample(s, logs, at, k))
                bands[:, b] = h
            some = np.diff(first) > 0
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(_nodes(words, first), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()),
                                          pa.array(bands.ravel().view(np.int64)),
                                          mask=pa.array(~some))],
                names=["doc_id", "tkey", "node", "bands"])

    return _keyed(docs).mapInArrow(sign, _SIGNED)


def _nodes(words: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    some = np.flatnonzero(np.diff(first) > 0)
    one = span_hash(words, first[some], first[some + 1])
    two = span_hash(mix(words ^ _U(0x0123456789ABCDEF)), first[some], first[some + 1])
    out: list[bytes | None] = [None] * (len(first) - 1)
    for i, x, y in zip(some.tolist(), one.tolist(), two.tolist()):
        out[i] = x.to_bytes(8, "big") + y.to_bytes(8, "big")
    return out


def similarity(x: np.ndarray, y: np.ndarray, common) -> float:
    """Weighted Jaccard similarity of two word-hash sequences."""
    found = block_similarity([x, y], common)
    return float(found[0, 1])


def block_similarity(texts: list[np.ndarray], common) -> np.ndarray:
    """Weighted Jaccard similarities of all texts of a small block.

    A shingle's weights in two texts are its counts times one factor, so the
    sum of minima is a product of 0/1 matrices whose columns are (shingle,
    1st time), (shingle, 2nd time), ..., scaled by the factor.  Columns that
    one text alone has add nothing and are left out; the rest is multiplied in
    strips, so the working memory doesn't follow the texts' lengths."""
    n = len(texts)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    s, count, at = _distinct(*shingle_hashes(np.concatenate([*texts, np.empty(0, _U)]), first))
    factor = np.exp(_weights_log(s, np.ones(len(s)), common))
    weight = np.bincount(np.repeat(np.arange(n), np.diff(at)), weights=factor * count, minlength=n)
    text = np.repeat(np.repeat(np.arange(n), np.diff(at)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    key = mix(np.repeat(s, count) + nth.astype(_U) * _U(0x9E3779B97F4A7C15))
    keys, column, times = np.unique(key, return_inverse=True, return_counts=True)
    scale = np.empty(len(keys))
    scale[column] = np.sqrt(np.repeat(factor, count))
    shared = np.flatnonzero(times > 1)
    place = np.full(len(keys), -1)
    place[shared] = np.arange(len(shared))
    held = place[column] >= 0
    text, column = text[held], column[held]
    order = np.argsort(place[column], kind="stable")
    text, column = text[order], column[order]
    both = np.zeros((n, n))
    for a in range(0, len(shared), STRIP):
        lo, hi = np.searchsorted(place[column], [a, a + STRIP])
        strip = np.zeros((n, min(STRIP, len(shared) - a)))
        strip[text[lo:hi], place[column[lo:hi]] - a] = scale[column[lo:hi]]
        both += strip @ strip.T
    np.fill_diagonal(both, weight)
    union = weight[:, None] + weight[None, :] - both
    return np.divide(both, union, out=np.zeros((n, n)), where=union > 0)


def _forest(close: np.ndarray) -> list[tuple[int, int]]:
    """Links of a block that keep its components: at most one fewer than texts."""
    root = list(range(len(close)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in zip(*np.nonzero(np.triu(close, 1))):
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[b] = a
            out.append((int(i), int(j)))
    return out


def _link_blocks(common, threshold: float):
    """Links of each block of a stream sorted by block (family, lo, hi)."""
    def links(nodes: list[bytes], texts: list) -> list[tuple[bytes, bytes]]:
        hashes = list(word_hashes(pa.array(texts, pa.large_string())))
        sims = block_similarity(hashes, common.value)
        return [(nodes[i], nodes[j]) for i, j in _forest(sims >= threshold - 1e-9)]

    def run(batches):
        key, nodes, texts, out = None, [], [], []
        for batch in batches:
            for fam, lo, hi, node, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (fam, lo, hi) != key:
                    out += links(nodes, texts) if len(nodes) > 1 else []
                    key, nodes, texts = (fam, lo, hi), [], []
                nodes.append(node)
                texts.append(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])
                out = []
        out += links(nodes, texts) if len(nodes) > 1 else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])
    return run


def _search(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(signatures, classes of the linked nodes), both written."""
    spark: SparkSession = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs))
    signed = materialize(signatures(docs, common), "signed")
    # copies are one member of the search, stood for by one row
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "tkey")).alias("row"), F.first("bands").alias("bands"))

    # families: a link from each member of a band's group to the smallest one
    band_rows = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", F.xxhash64("band", "value").alias("bucket"))
    shared = band_rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("a")).where("n > 1")
    # written, so that the join deals both sides itself and can split a hot group
    shared = materialize(shared.select("bucket", "a"), "shared")
    # a node and the smallest members of its groups are one family: a link from the
    # smallest of these to the node and to each of the others (one a band at most)
    minima = band_rows.join(shared, "bucket").groupBy("node").agg(F.collect_set("a").alias("others"), F.min("a").alias("low"))
    ends = minima.select("low", F.explode(F.array_distinct(F.concat("others", F.array("node")))).alias("b"))
    families = components(ends.select(F.col("low").alias("a"), "b"))
    sizes = families.groupBy("comp").agg(F.count("*").alias("n"))
    placed = families.join(sizes, "comp").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.join(nodes.select("node", "row.*"), "node")

    texts = _keyed(docs).alias("d").join(
        placed.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tkey") == F.col("w.tkey"))).select(
        "node", "text", "comp", "block", "blocks").dropDuplicates(["node"])
    pairs = texts.select("comp", "block", "node", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = pairs.select("comp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "text")
    links = (pairs.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi", "node")
             .mapInArrow(_link_blocks(common, threshold), "a binary, b binary"))
    return signed, components(links)


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, tkey, class_id, class_size, kept) of every row."""
    with small_batches(docs.sparkSession):
        signed, classes = _search(docs, threshold)
    named = materialize(signed.join(classes, "node", "left").select(
        "doc_id", "tkey", F.coalesce("comp", "node").alias("comp")), "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey"))
    tops = named.where("comp is not null").groupBy("comp").agg(first.alias("top"), F.count("*").alias("class_size"))
    out = named.join(tops.where("class_size > 1"), "comp", "left")
    alone = F.col("class_size").isNull()
    return out.select(
        "doc_id", "tkey", F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("tkey") == F.col("top.tkey")))).alias("kept"))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size, kept): ``class_id`` is the smallest id of
    the class; the row with that id stays."""
    return _classes(docs, threshold).drop("tkey")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class; all columns of ``docs``.  Rows that repeat
    both id and text stay or go together (``exact_dedup`` folds them)."""
    names = docs.columns
    gone = _classes(docs, threshold).where("not kept").select(
        F.col("doc_id").alias("_lf_i"), F.col("tkey").alias("_lf_k")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = docs.withColumns({"_lf_id": F.col("doc_id").cast("long"), "_lf_key": F.xxhash64(text)})
    return mine.join(gone, F.col("_lf_id").eqNullSafe(F.col("_lf_i")) & (F.col("_lf_key") == F.col("_lf_k")),
                     "left_anti").select(*names)
