"""Words of whole Arrow batches, cut and hashed with numpy.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``, as it
stands (null: no words).  Texts are handled in slices of ``SLICE_BYTES`` or
so, so that the working arrays of a task stay small however large a batch is;
a single longer text is a slice of its own.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
SLICE_ROWS = 1 << 15
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = {_BASE: np.ones(1, _U), _INVERSE: np.ones(1, _U)}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` mod 2**64, doubled on demand."""
    p = _powers[base]
    while len(p) < n:
        p = np.concatenate([p, p * _U(pow(base, len(p), 1 << 64))])
        _powers[base] = p
    return p[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): spreads every input bit over the word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each non-empty span, from one prefix sum."""
    if not len(starts):
        return np.empty(0, _U)
    n = len(values)
    terms = (values.astype(_U) + _U(1)) * _power(_BASE, n)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row, bytes, offsets) per slice of a string column."""
    raw, offs = text_bytes(column)
    row, n = 0, len(offs) - 1
    while row < n:
        end = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), row + SLICE_ROWS, n)
        yield row, end, raw[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def spans(is_gap: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs without gap bytes that do not cross a text: (starts, ends,
    index of each text's first run, with the total at the end)."""
    n = len(is_gap)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~is_gap
    start, end = solid.copy(), solid.copy()
    start[1:] &= is_gap[:-1]
    end[:-1] &= is_gap[1:]
    first, last = offs[:-1][offs[:-1] < offs[1:]], offs[1:][offs[:-1] < offs[1:]] - 1
    start[first] = solid[first]
    end[last] = solid[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def word_spans(raw: np.ndarray, offs: np.ndarray):
    return spans(SPACE[raw], offs)


def word_hashes(column: pa.Array):
    """Per text of a column: the hashes of its words, in order."""
    for _, _, raw, offs in text_slices(column):
        s, e, first = word_spans(raw, offs)
        h = span_hash(raw, s, e)
        for a, b in zip(first[:-1], first[1:]):
            yield h[a:b]


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000


@contextlib.contextmanager
def small_batches(spark, rows: int = BATCH_ROWS):
    """While an operator's own jobs run, a task exchanges at most ``rows``
    texts with Python at once (either process holds a batch, or two, beside its
    work); the session's setting is put back."""
    before = spark.conf.get(BATCH, None)
    if before is None or int(before) <= 0 or int(before) > rows:
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    return column


def text_lists(batch: pa.RecordBatch, name: str, rows: int = 256):
    """(first row, texts as Python strings) of a few rows at a time, so that a
    task never holds a whole batch twice."""
    column = text_column(batch, name)
    for a in range(0, len(column), rows):
        yield a, column.slice(a, rows).to_pylist()
