"""Best-fit packing of token pieces, certified by dual feasible functions.

``token_pieces``  texts -> pieces of at most ``max_tokens`` ids
``pack``          pieces -> sequences: best-fit decreasing in groups; the bin
                  count of a group is certified by a lower bound; groups with a
                  gap exchange the documents of their open bins (certified ones
                  those of their emptiest bin) and pack again
``sequences``     packed pieces -> the id lists themselves

Defined results: a null or empty text is the one id ``eos``; rows that repeat a
``doc_id`` are separate documents; an empty table gives no pieces; other
columns of the input are ignored.  A piece's ``start`` counts its document's
ids before it, offsets in a sequence are gapless from 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.llm.words import small_batches, span_hash, text_column, text_slices
from lumenflow.session import materialize

MAX_TOKENS = 4096
GROUP_ROWS = 50_000          # pieces that one packing task holds
ROUNDS = 6                   # packings at most; one that saves nothing ends them
CACHE_WORDS = 1_000_000      # encoded word parts that a Python worker remembers (about 40 MB)

# Byte classes.  A boundary between two of ASCII letter, digit and mark always
# parts two pre-tokens; an apostrophe may join what follows it, a byte over
# 0x7F may belong to anything, so neither is parted from its neighbours there.
_SPACE, _LETTER, _DIGIT, _MARK, _QUOTE, _OTHER = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[0x80:] = _OTHER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[ord("'")] = _QUOTE
_PART = np.zeros((6, 6), bool)
for _a in (_LETTER, _DIGIT, _MARK):
    for _b in (_LETTER, _DIGIT, _MARK):
        _PART[_a, _b] = _a != _b or _a == _DIGIT
    _PART[_a, _QUOTE] = _a in (_LETTER, _DIGIT)
_PART = _PART.ravel()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


class _Encoder:
    """Ids of word parts, remembered as sorted arrays."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        found: list[np.ndarray] = []
        for a in range(0, len(parts), 1000):        # an encoding takes far more room than its ids
            found += [np.array(g.ids, np.uint32)
                      for g in self.tokenizer.encode_batch(parts[a:a + 1000], add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.concatenate(found)
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        self.first = np.insert(self.first, at, len(self.flat) + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.keys = np.insert(self.keys, at, keys)
        self.flat = np.concatenate([self.flat, flat])

    def _ids_of(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Flat ids of the parts, and the number of ids of each part."""
        hashes = span_hash(raw, starts, ends)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            data = raw.tobytes()
            if len(self.keys) + int((~known).sum()) > CACHE_WORDS:   # all of these must be there
                self.forget()
                known[:] = False
            new = where[~known]
            self._learn(keys[~known], [data[a:b].decode("utf-8", "replace")
                                       for a, b in zip(starts[new], ends[new])])
            at = np.searchsorted(self.keys, keys)
        count = self.count[at][back]
        first = self.first[at][back]
        total = int(count.sum())
        before = np.cumsum(count) - count
        return self.flat[np.arange(total) + np.repeat(first - before, count)], count

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, exactly as encoding the text at once gives."""
        for a, b, raw, offs in text_slices(column):
            kind = _CLASS[raw]
            cut = np.zeros(len(raw) + 1, bool)
            if len(raw):
                cut[1:-1] = _PART[kind[:-1].astype(np.intp) * 6 + kind[1:]]
                cut[1:-1] |= (kind[:-1] == _SPACE) | (kind[1:] == _SPACE)
            cut[offs] = True
            edge = np.flatnonzero(cut)
            starts, ends = edge[:-1], edge[1:]
            solid = kind[starts] != _SPACE
            starts, ends = starts[solid], ends[solid]
            ids, count = self._ids_of(_LOWER[raw], starts, ends) if len(starts) else (np.empty(0, np.uint32), np.empty(0, np.int64))
            sums = np.concatenate([[0], np.cumsum(count)])
            bounds = sums[np.searchsorted(starts, offs)]
            special = b"<|" in raw.tobytes()
            for k in range(b - a):
                if special:
                    text = raw[offs[k]:offs[k + 1]].tobytes().decode("utf-8", "replace")
                    if any(s in text for s in _SPECIAL):
                        yield np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                        continue
                yield ids[bounds[k]:bounds[k + 1]]


@lru_cache(maxsize=2)
def encoder(path: str) -> _Encoder:
    return _Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, eos: int = 1,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, lane[, ids]) of every document."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64()), ("lane", pa.int32())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def cut(batches):
        enc, lane = encoder(tokenizer), 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids, enc.texts(text_column(batch, "text"))):
                ids = np.append(ids, np.uint32(eos)).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), max_tokens)):
                    part = ids[at:at + max_tokens]
                    lane = (lane + 1) % 4096
                    rows.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes()), lane,
                                 *([part.astype(np.int32)] if with_ids else ())))
            columns = list(zip(*rows)) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)],
                                             schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, lane int"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(cut, ddl + ", ids array<int>" * with_ids))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins.  Two families of dual feasible functions:
    small items dropped while their complements fill a bin, and rounding to
    k-ths; the plain volume is the member of the first with nothing dropped."""
    if not len(lengths):
        return 0
    sizes, n = np.unique(lengths.astype(np.int64), return_counts=True)
    best = -(-int((sizes * n).sum()) // capacity)
    for small in np.unique(np.concatenate([sizes[sizes <= capacity // 2], [capacity // 2]])):
        f = np.where(sizes > capacity - small, capacity, np.where(sizes < small, 0, sizes))
        best = max(best, -(-int((f * n).sum()) // capacity))
    for k in range(1, 33):
        up = (k + 1) * sizes
        whole = up % capacity == 0
        # in units of capacity * k: x where (k + 1) x is whole, else floor((k + 1) x) / k
        f = np.where(whole, sizes * k, (up // capacity) * capacity)
        best = max(best, -(-int((f * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins.  ``open_`` has a bit
    for each amount of room that some bin has left, so the tightest bin that
    still takes an item is one shift and one lowest set bit."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, count = 0, 0
    for i in order.tolist():
        size = int(lengths[i])
        fits = open_ >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                open_ &= ~(1 << room)
        else:
            room, b, count = capacity, count, count + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            stacks[left].append(b)
            open_ |= 1 << left
    return bins, offsets, count


_PACKED = ("doc_id long, piece int, start long, length long, ids_crc32 long, lane int, "
           "grp long, bin long, offset long, loose boolean")


def _pack_group(capacity: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "piece", "lane"], kind="stable").reset_index(drop=True)
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        # a certified group only gives up what all its bins round up to
        given = fill < capacity if count > lower_bound(lengths, capacity) else (np.arange(count) == fill.argmin()) & (fill < capacity)
        return frame.assign(bin=bins, offset=offsets, loose=given[bins])
    return run


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.

    Groups hold about ``group_rows`` pieces, spread by a hash that includes a
    per-task counter, so a document id that is repeated endlessly is spread
    too.  A group whose bin count equals its bound can't be packed better by
    itself; it gives up its emptiest bin.  The others give up all bins that
    aren't full.  What was given up is dealt over new, larger groups and packed
    again while that saves bins.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "lane"]
    with small_batches(pieces.sparkSession):        # the texts are encoded here
        pieces = materialize(pieces.select(*names), "pieces")
    n = pieces.count()
    settled: list[DataFrame] = []
    before: tuple[DataFrame, int] | None = None
    todo = pieces
    for round_ in range(ROUNDS):
        groups = max(1, -(-n // (group_rows << round_)))
        spread = F.pmod(F.xxhash64("doc_id", "piece", "lane", F.lit(round_)), F.lit(groups))
        packed = materialize(
            todo.select(*names, spread.alias("grp")).groupBy("grp")
            .applyInPandas(_pack_group(max_tokens), _PACKED)
            .withColumn("sequence_id", F.lit(round_ << 56) + F.shiftleft("grp", 28) + F.col("bin")), "packed")
        head = F.when(F.col("offset") == 0, 1).otherwise(0)         # one row of each bin
        total, n, loose_bins = packed.agg(F.sum(head), F.sum(F.col("loose").cast("int")),
                                          F.sum(F.when(F.col("loose"), head).otherwise(0))).first()
        if before and total >= before[1]:       # nothing saved: the earlier packing stands
            settled.append(before[0])
            break
        if not n or groups == 1 or round_ == ROUNDS - 1:
            settled.append(packed)
            break
        settled.append(packed.where("not loose"))
        before = packed.where("loose"), loose_bins
        todo = before[0]
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS,
              eos: int = 1) -> DataFrame:
    """(sequence_id, ids): the packed id lists; ids are at most ``max_tokens`` a row."""
    ids = token_pieces(docs, tokenizer, max_tokens, eos, with_ids=True).select("doc_id", "piece", "ids_crc32", "ids")
    once = ids.dropDuplicates(["doc_id", "piece", "ids_crc32"])
    return (packed.join(once, ["doc_id", "piece", "ids_crc32"])
            .groupBy("sequence_id")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                       lambda x: x["ids"])).alias("ids")))
