"""Substring dedup over bytes by suffix arrays, sorted deep-shallow.

Every byte of a text that a ``WINDOW``-byte string covers goes if that string also
starts earlier: in a document of smaller id, or before it in the same one.  Overlaps
count, matches never cross documents, and windows are judged on the input.

1. ``passages``: each window chooses one of its ``GRAM``-byte grams, the one with the
   smallest hash (the last of equal ones).  Equal windows choose the same gram at the
   same distance, so they meet under its hash, the *anchor*.  Consecutive windows of
   one choice are a passage, about one for every 35 bytes.  These are the sampled
   suffixes; anchors that occur once are dropped.
2. Passages that are the same string at the same anchor are one *kind*, known by its
   first occurrence; only kinds bring their bytes to the sort.
3. The kinds of an anchor are a group.  The suffix array of a group's strings from the
   anchor on, and that of the reversed strings before it, are sorted deep-shallow: a
   multikey quicksort on eight bytes at a time down to depth ``SHALLOW``, all segments
   of a task at once, then a blind trie for each segment that still agrees.  Common
   prefixes of neighbours are then measured on the bytes.
4. Two windows with d bytes before the anchor are equal if the common suffix before it
   is d or longer and the common prefix from it on ``WINDOW - d``.  So the window's
   class is a pair of runs of the two arrays, and all but the earliest of a class are
   marked.  Later occurrences of a kind are marked whole, as its first is earlier.
5. The marked spans go back to the documents, which are rewritten whole.

Hot groups.  A group of more than ``GROUP`` kinds (the edge of a passage that very many
documents share) is dealt over several tasks by a salt.  What each task marks is right,
as an earlier copy is an earlier copy; only runs of windows that it left unmarked go to
a next round, where the group is parted by more of the windows' own bytes: windows of
d in [lo, hi] agree only if the lo bytes before the anchor and the WINDOW - hi bytes from it
on do.  The ranges narrow by ``WIDTHS``, the last is the whole window, and a group of equal
windows shrinks by the factor ``GROUP`` a round, so it ends.

Defined results: a null or empty text has no bytes (and the hash of the empty string);
texts shorter than ``WINDOW`` keep all; rows that repeat id and text are the same place
and none is before the other; rows of one id with other texts are ordered by a hash of
the text; a null id comes last; very long texts are cut into parts that share
``WINDOW - 1`` bytes, so no window is lost; an empty table gives none; other columns are
untouched by ``remove_repeats``, where a character that loses a byte goes whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.llm.words import mix, small_batches, span_hash, text_column, text_slices
from lumenflow.session import fresh_path, materialize
from lumenflow.sinks import storage

WINDOW = 100
GRAM = 20
SHALLOW = 32                # bytes that the quicksort compares
GROUP = 2_000               # kinds of an anchor that one task sorts at once
SHARD = 16_000              # kinds that a task holds, whole groups
PART = 1 << 20              # bytes of a long text that are looked at together
WIDTHS = (16, 4, 1)         # ranges of d by which hot groups are parted

_U = np.uint64
_PLACE = _U(32)
_LOW = _U((1 << 32) - 1)
_FOUND = "doc_id long, tkey long, anchor long, passage long, start int, n int, p int"
_PIECE = "key long, members long, none boolean, doc_id long, tkey long, start int, n int, p int, piece binary"


# ---- sampling ----------------------------------------------------------------

def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def passages(raw: np.ndarray, offs: np.ndarray):
    """(text, start, windows, bytes before the anchor, anchor, hash) of each passage
    of some texts; ``start`` counts from the first text."""
    if len(raw) < WINDOW:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, _U),) * 2
    at = np.arange(len(raw) - GRAM + 1)
    gram = span_hash(raw, at, at + GRAM)
    key = (gram >> _PLACE << _PLACE) | (_LOW - at.astype(_U))
    chosen = (_LOW - (_sliding_min(key, WINDOW - GRAM + 1) & _LOW)).astype(np.int64)
    text = np.searchsorted(offs, np.arange(len(chosen)), side="right") - 1
    window = np.flatnonzero(np.arange(len(chosen)) + WINDOW <= offs[text + 1])
    if not len(window):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, _U),) * 2
    new = np.ones(len(window), bool)
    new[1:] = (chosen[window[1:]] != chosen[window[:-1]]) | (text[window[1:]] != text[window[:-1]])
    head = np.flatnonzero(new)
    start, n = window[head], np.diff(np.append(head, len(window)))
    p = chosen[start] - start
    whole = mix(span_hash(raw, start, start + n + WINDOW - 1) + p.astype(_U))
    return text[start], start, n, p, gram[chosen[start]], whole


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def sampled(docs: DataFrame) -> DataFrame:
    """The passages of every document: ``_FOUND``."""
    def parts(batch):
        for a, b, raw, offs in text_slices(text_column(batch, "text")):
            if b - a > 1 or len(raw) <= PART:
                yield a, 0, raw, offs
            else:
                for x in range(0, len(raw) - WINDOW + 1, PART):
                    some = raw[x:x + PART + WINDOW - 1]
                    yield a, x, some, np.array([0, len(some)])

    def run(batches):
        for batch in batches:
            ids, tkeys = batch.column(0), batch.column(1)
            for a, shift, raw, offs in parts(batch):
                text, start, n, p, anchor, whole = passages(raw, offs)
                row = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), tkeys.take(row), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array((start - offs[text] + shift).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(p.astype(np.int32))],
                    names=["doc_id", "tkey", "anchor", "passage", "start", "n", "p"])

    return _keyed(docs).mapInArrow(run, _FOUND)


# ---- deep-shallow sorting ------------------------------------------------------

class _Strings:
    """Byte strings ``blob[start:start + length]``, read by words of eight bytes."""

    def __init__(self, blob: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        self.blob = np.concatenate([blob, np.zeros(8, np.uint8)])
        self.start, self.length = start, length
        self.view = np.ndarray((len(self.blob) - 7,), ">u8", self.blob, strides=(1,))

    def words(self, which: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Eight bytes of each at its depth, zeros beyond its end."""
        left = np.clip(self.length[which] - depth, 0, 8)
        word = self.view[np.minimum(self.start[which] + depth, len(self.view) - 1)].astype(_U)
        drop = (8 * (8 - left)).astype(_U)
        return np.where(left > 0, word >> np.minimum(drop, _U(63)) << np.minimum(drop, _U(63)), _U(0))

    def text(self, i: int, depth: int) -> bytes:
        return self.blob[self.start[i] + depth:self.start[i] + self.length[i]].tobytes()

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of pairs."""
        most = np.minimum(self.length[x], self.length[y])
        out, open_ = most.copy(), np.arange(len(x))
        depth = 0
        while len(open_):
            at = np.full(len(open_), depth)
            other = self.words(x[open_], at) ^ self.words(y[open_], at)
            # index of the first byte that differs
            byte = np.zeros(len(open_), np.int64)
            rest = other.copy()
            for step in (4, 2, 1):
                high = rest >> _U(64 - 8 * step) == 0
                byte += np.where(high, step, 0)
                rest = np.where(high, rest << _U(8 * step), rest)
            apart = other != 0
            out[open_[apart]] = np.minimum(most[open_[apart]], depth + byte[apart])
            depth += 8
            open_ = open_[~apart & (most[open_] > depth)]
        return out


def multikey_quicksort(strings: _Strings, order: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Sort the segments ``order[lo:hi]`` in place by their first ``SHALLOW`` bytes and
    return the segments that still agree.

    A character is a word of eight bytes.  All segments take a step at once: each is
    parted by its middle string's word into less, equal and greater, and the equal part
    moves on by a word."""
    deep: list[tuple[int, int]] = []
    depth = np.zeros(len(lo), np.int64)
    while len(lo):
        size = hi - lo
        segment = np.repeat(np.arange(len(lo)), size)
        place = np.arange(len(segment)) + np.repeat(lo - (np.cumsum(size) - size), size)
        mine = order[place]
        word = strings.words(mine, depth[segment])
        pivot = word[np.cumsum(size) - size + size // 2][segment]
        part = segment * 3 + np.where(word < pivot, 0, np.where(word > pivot, 2, 1))
        order[place] = mine[np.argsort(part, kind="stable")]
        count = np.bincount(part, minlength=3 * len(lo)).reshape(-1, 3)
        end = lo[:, None] + np.cumsum(count, axis=1)
        begin = end - count
        down = np.repeat(depth[:, None], 3, axis=1)
        down[:, 1] += 8
        some = count > 1
        done = some & (down >= SHALLOW)
        deep += list(zip(begin[done].tolist(), end[done].tolist()))
        some &= ~done
        lo, hi, depth = begin[some], end[some], down[some]
    return deep


class _Node:
    __slots__ = ("depth", "sons", "some")

    def __init__(self, depth: int, some: int) -> None:
        self.depth, self.sons, self.some = depth, {}, some


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie(texts: list[bytes]) -> list[int]:
    """The order of some strings.  Inner nodes hold only a depth and a branch for each
    byte there (-1: the string ends); a string walks down by these bytes alone, is
    compared once with the string it arrives at, and branches off where they part.
    Equal strings are one leaf."""
    root: _Node | list[int] = [0]
    for i in range(1, len(texts)):
        text = texts[i]
        node = root
        while isinstance(node, _Node):
            son = node.sons.get(text[node.depth] if node.depth < len(text) else -1)
            if son is None:
                break
            node = son
        some = node.some if isinstance(node, _Node) else node[0]
        known = texts[some]
        if text == known:
            node.append(i)
            continue
        depth = _common(text, known)
        parent, node = None, root
        while isinstance(node, _Node) and node.depth < depth:
            parent, node = node, node.sons[text[node.depth]]
        mine = text[depth] if depth < len(text) else -1
        if isinstance(node, _Node) and node.depth == depth:
            node.sons[mine] = [i]
            continue
        branch = _Node(depth, some)
        branch.sons = {mine: [i], known[depth] if depth < len(known) else -1: node}
        if parent is None:
            root = branch
        else:
            parent.sons[text[parent.depth]] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack += [node.sons[c] for c in sorted(node.sons, reverse=True)]
        else:
            out += node
    return out


def suffix_array(strings: _Strings, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the string before; -1 where a group starts) of
    strings that lie by group."""
    n = len(group)
    order = np.arange(n)
    lo = np.flatnonzero(np.diff(group, prepend=-1))
    hi = np.append(lo[1:], n)
    several = hi - lo > 1
    for a, b in multikey_quicksort(strings, order, lo[several], hi[several]):
        own = order[a:b].copy()
        depth = SHALLOW if (strings.length[own] >= SHALLOW).all() else 0    # shorter ones end at different places
        order[a:b] = own[blind_trie([strings.text(i, depth) for i in own.tolist()])]
    common = np.full(n, -1)
    inside = np.ones(n, bool)
    inside[lo] = False
    at = np.flatnonzero(inside)
    common[at] = strings.common(order[at - 1], order[at])
    return order, common


# ---- windows of a task's groups ------------------------------------------------

class _Shard:
    """Whole groups of pieces, as columns; ``group`` is dense and sorted."""

    def __init__(self, batch: pa.Table) -> None:
        column = {name: batch.column(name).combine_chunks() for name in batch.column_names}
        num = lambda name: np.asarray(column[name])        # noqa: E731
        self.key, self.members, self.none, self.tkey = num("key"), num("members"), num("none"), num("tkey")
        self.missing = column["doc_id"].is_null()
        self.doc_id = np.asarray(column["doc_id"].fill_null(0))
        self.start, self.n, self.p = (num(c).astype(np.int64) for c in ("start", "n", "p"))
        salt = num("salt")
        new = np.ones(len(self.key), bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (salt[1:] != salt[:-1])
        self.group = np.cumsum(new) - 1
        pieces = column["piece"].cast(pa.large_binary())
        _, offsets, data = pieces.buffers()
        self.offs = np.frombuffer(offsets, np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        self.blob = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)

    def marks(self) -> np.ndarray:
        """marks[i, d]: the window of piece i with d bytes before the anchor also
        starts earlier."""
        n, o = len(self.key), self.offs[:-1]
        right, right_common = suffix_array(_Strings(self.blob, o + self.p, self.n + WINDOW - 1 - self.p), self.group)
        left, left_common = suffix_array(_Strings(self.blob[::-1], len(self.blob) - o - self.p, self.p), self.group)
        right_rank, left_rank = np.empty(n, np.int64), np.empty(n, np.int64)
        right_rank[right], left_rank[left] = np.arange(n), np.arange(n)
        places = (self.start + self.p, self.tkey, self.doc_id, self.none)
        by_place = np.lexsort(places)
        step = np.zeros(n, bool)
        for c in places:
            step[1:] |= c[by_place][1:] != c[by_place][:-1]
        when = np.empty(n, np.int64)
        when[by_place] = np.cumsum(step)
        out = np.zeros((n, WINDOW), bool)
        low = self.p - self.n + 1
        for d in range(int(low.min()), int(self.p.max()) + 1):
            mine = by_place[(low[by_place] <= d) & (d <= self.p[by_place])]
            if len(mine) < 2:
                continue
            before = np.cumsum(left_common < d)
            after = np.cumsum(right_common < WINDOW - d)
            _, first, which = np.unique(before[left_rank[mine]] * n + after[right_rank[mine]], return_index=True, return_inverse=True)
            out[mine, d] = when[mine] > when[mine[first[which]]]
        return out


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the runs of True in each row."""
    edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, lo = np.nonzero(edge == 1)
    return row, lo, np.nonzero(edge == -1)[1]


_SORTED = "doc_id long, tkey long, a int, b int, key long, none boolean, start int, n int, p int, piece binary"


def _sort_shards(hot: int, shard: int):
    """Marked byte spans [a, b) of a stream sorted by group, ``shard`` pieces at a time,
    and of the groups of more than ``hot`` pieces, which are dealt over several tasks, the
    runs of windows left unmarked."""
    names = [c.split(" ")[0] for c in _SORTED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def judged(table: pa.Table):
        s = _Shard(table)
        marks = s.marks()
        ids = pa.array(s.doc_id, mask=np.asarray(s.missing))
        row, lo, hi = _runs(marks)                          # in d; offsets fall as d rises
        a, b = s.start[row] + s.p[row] - hi + 1, s.start[row] + s.p[row] - lo + WINDOW
        empty = [pa.nulls(len(row), t) for t in types[4:]]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row)), pa.array(s.tkey[row]), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *empty], names=names)
        d = np.arange(WINDOW)
        rest = ~marks & (d >= (s.p - s.n + 1)[:, None]) & (d <= s.p[:, None]) & (s.members > hot)[:, None]
        row, lo, hi = _runs(rest)
        first = s.p[row] - hi + 1                           # offset of the run's first window
        x = s.offs[:-1][row] + first
        size = hi - lo + WINDOW - 1
        pieces = [s.blob[i:i + k].tobytes() for i, k in zip(x.tolist(), size.tolist())]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row)), pa.array(s.tkey[row]), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.int32()),
             pa.array(s.key[row]), pa.array(s.none[row]), pa.array((s.start[row] + first).astype(np.int32)),
             pa.array((hi - lo).astype(np.int32)), pa.array((s.p[row] - first).astype(np.int32)), pa.array(pieces, pa.binary())], names=names)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < shard:
                continue
            table = pa.Table.from_batches(held)
            key, salt = (np.asarray(table.column(c).combine_chunks()) for c in ("key", "salt"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))
            if len(new):                                        # the last group may go on
                cut = int(new[-1]) + 1
                for a in _pieces_of(np.append(0, new + 1), shard):
                    yield from judged(table.slice(a[0], a[1] - a[0]))
                held = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
        if rows:
            yield from judged(pa.Table.from_batches(held))

    return run


def _pieces_of(starts: np.ndarray, shard: int):
    """Ranges of whole groups of about ``shard`` rows, up to the last start."""
    a = 0
    while a < len(starts) - 1:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + shard, side="right")) - 1)
        yield int(starts[a]), int(starts[b])
        a = b


def _parted(width: int):
    """Pieces by ranges of ``width`` of d, under a key that holds the bytes which all
    windows of the range have."""
    def run(batches):
        for batch in batches:
            out = []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("key", "none", "doc_id", "tkey", "start", "n", "p", "piece"))
            for key, none, doc_id, tkey, start, n, p, piece in zip(*columns):
                k = 0
                while k < n:
                    band = (p - k) // width
                    lo, hi = band * width, band * width + width - 1
                    end = min(n, p - lo + 1)                # windows k .. end - 1 have d in the band
                    sure = piece[p - lo:p] + b"\0" + piece[p:max(p, p + WINDOW - hi)]
                    code = hashlib.blake2b(key.to_bytes(8, "big", signed=True) + bytes([width, band]) + sure, digest_size=8).digest()
                    out.append((int.from_bytes(code, "big", signed=True), none, doc_id, tkey, start + k, end - k, p - k,
                                piece[k:end + WINDOW - 1]))
                    k = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                names=["key", "none", "doc_id", "tkey", "start", "n", "p", "piece"])
    return run


# ---- the search ----------------------------------------------------------------

def _bytes_of(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """``_PIECE`` of each kind, its bytes taken from its first occurrence."""
    lists = kinds.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("anchor", "members", "start", "n", "p")).alias("items"))
    texts = _keyed(docs).alias("d").join(
        lists.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tkey") == F.col("w.tkey"))).select(
        "d.doc_id", "d.tkey", "text", "items")

    def run(batches):
        for batch in batches:
            ids, tkeys, items = batch.column(0), batch.column(1), batch.column(3)
            for a, b, raw, offs in text_slices(text_column(batch, "text")):
                data = raw.tobytes()
                some = items.slice(a, b - a)
                count = np.diff(np.asarray(some.offsets))
                anchor, members, start, n, p = (x for x in some.flatten().flatten())
                row = np.repeat(np.arange(a, b), count)
                x = offs[row - a] + np.asarray(start)
                y = x + np.asarray(n) + WINDOW - 1
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [anchor, members, ids.take(take).is_null(), ids.take(take), tkeys.take(take), start, n, p,
                     pa.array([data[i:j] for i, j in zip(x.tolist(), y.tolist())], pa.binary())],
                    names=["key", "members", "none", "doc_id", "tkey", "start", "n", "p", "piece"])

    return texts.mapInArrow(run, _PIECE)


def _grouped(pieces: DataFrame) -> DataFrame:
    """Pieces in the order ``_sort_shards`` reads them, large groups salted."""
    parts = F.ceil(F.col("members") / GROUP)
    salt = F.pmod(F.xxhash64("doc_id", "tkey", "start", F.lit(13)), parts).cast("long")
    return pieces.withColumn("salt", salt).repartition("key", "salt").sortWithinPartitions("key", "salt")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, spans): byte ranges [a, b) that go, some overlapping."""
    spark = docs.sparkSession
    sampled_at = fresh_path(spark, "sampled")
    with small_batches(spark):
        sampled(docs).write.parquet(sampled_at)
    found = spark.read.parquet(sampled_at)
    # written, so that the join deals both sides itself and can split a hot anchor
    often = materialize(found.groupBy("anchor").agg(F.count("*").alias("total")).where("total > 1").select("anchor"), "often")
    repeated = materialize(found.join(often, "anchor", "left_semi"), "repeated")
    storage.delete(spark, sampled_at)       # the largest table, not read again

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey", "start", "n", "p")).alias("at")
    kinds = materialize(repeated.groupBy("anchor", "passage").agg(F.count("*").alias("times"), first)
                        .select("anchor", "passage", "times", "at.*"), "kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("members")).where("members > 1")
    with small_batches(spark):
        pieces = materialize(_bytes_of(docs, kinds.join(several, "anchor")), "pieces")

    spans, widths = [], iter(WIDTHS)
    while True:
        judged = materialize(_grouped(pieces).mapInArrow(_sort_shards(GROUP, SHARD), _SORTED), "sorted")
        spans.append(judged.where("a is not null").select("doc_id", "tkey", "a", "b"))
        rest = judged.where("piece is not null").select("key", "none", "doc_id", "tkey", "start", "n", "p", "piece")
        if rest.isEmpty():
            break
        width = next(widths, None)
        if width:
            rest = materialize(rest.mapInArrow(_parted(width), rest.schema), "parted")
        sizes = rest.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        pieces = rest.join(sizes, "key").select(*[c.split(" ")[0] for c in _PIECE.split(", ")])

    again = kinds.where("times > 1").select(
        "anchor", "passage", F.struct("doc_id", "tkey", "start").alias("first"))
    later = (repeated.join(again, ["anchor", "passage"])
             .where(~F.struct("doc_id", "tkey", "start").eqNullSafe(F.col("first")))
             .select("doc_id", "tkey", F.col("start").alias("a"), (F.col("start") + F.col("n") + (WINDOW - 1)).alias("b")))
    for some in spans:
        later = later.unionByName(some)
    return later.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _with_spans(docs: DataFrame, columns: list[str]) -> DataFrame:
    spans = repeated_spans(docs).select(F.col("doc_id").alias("_lf_id"), F.col("tkey").alias("_lf_key"), F.col("spans").alias("_lf_spans"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = docs.select(*columns).withColumns({"_lf_own": F.col("doc_id").cast("long"), "_lf_text": F.xxhash64(text)})
    return mine.join(spans, F.col("_lf_own").eqNullSafe(F.col("_lf_id")) & (F.col("_lf_text") == F.col("_lf_key")), "left").select(*columns, "_lf_spans")


def _kept(batch: pa.RecordBatch):
    """(bytes, bytes removed, removed runs, bytes that stay) of each row."""
    spans = batch.column(batch.schema.get_field_index("_lf_spans"))
    for x, y, raw, offs in text_slices(text_column(batch, "text")):
        for k in range(x, y):
            text = raw[offs[k - x]:offs[k - x + 1]]
            own = spans[k].values
            if own is None:
                yield len(text), 0, 0, text.tobytes()
                continue
            a, b = (np.asarray(c) for c in own.flatten())
            cover = np.zeros(len(text) + 1, np.int32)
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
            gone = np.cumsum(cover[:-1]) > 0
            runs = np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)
            yield len(text), int(np.count_nonzero(gone)), int(runs), text[~gone].tobytes()


def repeat_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    def run(batches):
        for batch in batches:
            rows = [(n, gone, runs, hashlib.sha256(kept).hexdigest()) for n, gone, runs, kept in _kept(batch)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs, ["doc_id", "text"]).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes cut out of the text; all columns."""
    names, schema = docs.columns, docs.schema
    place = names.index("text")

    def run(batches):
        for batch in batches:
            new = [kept.decode("utf-8", "ignore") if gone else None for _, gone, _, kept in _kept(batch)]
            old = text_column(batch, "text")
            column = pa.array([o.as_py() if n is None else n for o, n in zip(old, new)], batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([column if i == place else batch.column(i) for i in range(len(names))], names=names)

    return _with_spans(docs, names).mapInArrow(run, T.StructType(schema.fields))
