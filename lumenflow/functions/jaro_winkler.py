"""Jaro-Winkler similarity, vectorised over Arrow batches of string pairs.

Spark has no built-in for it, so this is the project's one Python scorer;
it runs as a ``pandas_udf`` (one numpy pass per Arrow batch, never one
Python call per pair).

Definition (fixed values; they decide ties, so they must stay as they are):
  * match window: max(len1, len2) // 2 - 1, not below 0
  * each character of the first string takes the first unmatched equal
    character of the second string inside the window
  * transpositions: half the number of out-of-order matched pairs,
    integer division
  * jaro = (m / len1 + m / len2 + (m - t) / m) / 3, 0 when m = 0
  * prefix: common prefix length, at most 4, weight 0.1
  * the prefix boost is applied only when jaro > 0.7
  * no long-string adjustment
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType

PREFIX_MAX = 4
PREFIX_WEIGHT = 0.1
BOOST_THRESHOLD = 0.7
SCORE_DIGITS = 9          # scores are rounded before ranking
HIST_BUCKETS = 64         # character histogram buckets (code point mod 64)


def _codes(strings: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a padded (n, maxlen) int32 matrix, and the lengths."""
    lens = np.fromiter((len(s) for s in strings), dtype=np.int64, count=len(strings))
    width = int(lens.max()) if len(strings) else 0
    out = np.full((len(strings), max(width, 1)), pad, dtype=np.int32)
    if width:
        flat = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
        col = np.arange(width)
        inside = col[None, :] < lens[:, None]
        idx = np.where(inside, starts[:, None] + col[None, :], 0)
        if flat.size:
            out = np.where(inside, flat[idx], pad).astype(np.int32)
    return out, lens


_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
WORD = 64


def jaro_winkler(a: list[str], b: list[str]) -> np.ndarray:
    """Similarity of a[k] and b[k] for every k."""
    n = len(a)
    if n == 0:
        return np.zeros(0)
    A, la = _codes(a, -1)
    B, lb = _codes(b, -2)
    short = lb <= WORD
    if short.all():
        return _finish(A, la, B, lb, *_match_bits(A, la, B, lb))
    out = np.empty(n)
    for part in (short, ~short):
        if part.any():
            sa, sb = A[part], B[part]
            sa, sb = sa[:, :max(int(la[part].max()), 1)], sb[:, :max(int(lb[part].max()), 1)]
            match = _match_bits if part is short else _match_dense
            out[part] = _finish(sa, la[part], sb, lb[part], *match(sa, la[part], sb, lb[part]))
    return out


def _finish(A, la, B, lb, used_a, used_b) -> np.ndarray:
    """Score from the matched positions of both strings."""
    n = A.shape[0]
    m = used_a.sum(axis=1)
    ca = A[used_a]          # k-th matched character of a, row by row
    cb = B[used_b]          # k-th matched character of b, in b's order
    row_of = np.repeat(np.arange(n), m)
    half = np.bincount(row_of, weights=(ca != cb), minlength=n).astype(np.int64)
    t = half // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - t) / np.maximum(m, 1)) / 3.0, 0.0)
    k = min(PREFIX_MAX, A.shape[1], B.shape[1])
    same = (A[:, :k] == B[:, :k])
    prefix = np.cumprod(same, axis=1).sum(axis=1) if k else np.zeros(n)
    return np.where(jaro > BOOST_THRESHOLD, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def _match_bits(A, la, B, lb):
    """Greedy window matching with one 64-bit position mask per character
    of b (b at most 64 characters): per position of a, the lowest free
    equal character inside the window is ``cand & -cand``."""
    n, w1 = A.shape
    w2 = B.shape[1]
    # dense ids for the characters present (pads -1 and -2 included)
    top = int(max(A.max(), B.max())) + 3
    present = np.zeros(top, dtype=bool)
    present[A.ravel() + 2] = True
    present[B.ravel() + 2] = True
    ids = np.cumsum(present) - 1
    ai = ids[A + 2]
    bi = ids[B + 2]
    rows = np.arange(n)
    table = np.zeros((n, int(ids[-1]) + 1), dtype=np.uint64)
    for j in range(w2):
        table[rows, bi[:, j]] |= _ONE << np.uint64(j)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    used_b = np.zeros(n, dtype=np.uint64)
    used_a = np.zeros((n, w1), dtype=bool)
    for i in range(w1):
        lo = np.maximum(i - window, 0)
        hi = np.minimum(lb, i + window + 1)
        hi_mask = np.where(hi >= WORD, _ALL, (_ONE << np.minimum(hi, WORD - 1).astype(np.uint64)) - _ONE)
        lo_mask = (_ONE << np.minimum(lo, WORD - 1).astype(np.uint64)) - _ONE
        wmask = np.where((hi > lo) & (i < la), hi_mask & ~lo_mask, np.uint64(0))
        cand = table[rows, ai[:, i]] & wmask & ~used_b
        low = cand & (~cand + _ONE)
        used_b |= low
        used_a[:, i] = low != 0
    bits = (used_b[:, None] >> np.arange(w2, dtype=np.uint64)[None, :]) & _ONE
    return used_a, bits.astype(bool)


def _match_dense(A, la, B, lb):
    """Same matching with boolean matrices, for any length."""
    n, w1 = A.shape
    w2 = B.shape[1]
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    used_b = np.zeros((n, w2), dtype=bool)
    used_a = np.zeros((n, w1), dtype=bool)
    jpos = np.arange(w2)[None, :]
    lo_base = -window[:, None]
    rows_all = np.arange(n)
    for i in range(w1):
        live = i < la
        if not live.any():
            break
        lo = np.maximum(0, i + lo_base)
        hi = np.minimum(lb[:, None], i + window[:, None] + 1)
        cand = (B == A[:, i:i + 1]) & ~used_b & (jpos >= lo) & (jpos < hi) & live[:, None]
        hit = cand.any(axis=1)
        if hit.any():
            first = cand.argmax(axis=1)
            r = rows_all[hit]
            used_b[r, first[hit]] = True
            used_a[r, i] = True
    return used_a, used_b


def char_histogram(strings: list[str]) -> np.ndarray:
    """(n, 64) counts of characters by code point mod 64.  Summing
    ``min`` over buckets bounds the number of common characters from
    above, for any alphabet."""
    codes, lens = _codes(strings, -1)
    n = len(strings)
    if not n:
        return np.zeros((0, HIST_BUCKETS), dtype=np.int32)
    valid = codes >= 0
    rows = np.broadcast_to(np.arange(n)[:, None], codes.shape)[valid]
    flat = rows * HIST_BUCKETS + codes[valid] % HIST_BUCKETS
    return np.bincount(flat, minlength=n * HIST_BUCKETS).reshape(n, HIST_BUCKETS).astype(np.int32)


# --- Spark wrappers ---------------------------------------------------------

@F.pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Rounded similarity; null when either side is null."""
    ok = a.notna() & b.notna()
    out = np.full(len(a), np.nan)
    if ok.any():
        out[ok.to_numpy()] = np.round(
            jaro_winkler(a[ok].tolist(), b[ok].tolist()), SCORE_DIGITS)
    return pd.Series(out).where(ok, None)


def bound(common, la, lb, prefix):
    """The best score for at most ``common`` equal characters: no transposition
    and the full boost of the common prefix."""
    m = np.minimum(common, np.minimum(la, lb)).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + 1.0) / 3.0, 0.0)
    return np.where(jaro > BOOST_THRESHOLD, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint16).reshape(len(packed), HIST_BUCKETS)


@F.pandas_udf(DoubleType())
def node_bound_udf(hist: pd.Series, length: pd.Series, head: pd.Series, node_hist: pd.Series,
                   shortest: pd.Series, longest: pd.Series, node_head: pd.Series) -> pd.Series:
    """The best score that any member of a node could reach for a row: equal
    characters at most the histograms' minimum, the best length of the node's
    range, the common prefix (all of it where the members' prefixes differ)."""
    if not len(hist):
        return pd.Series([], dtype="float64")
    common = np.minimum(_matrix(hist), _matrix(node_hist)).sum(axis=1, dtype=np.int64)
    la, lo, hi = (x.to_numpy(np.int64) for x in (length, shortest, longest))
    prefix = np.fromiter((PREFIX_MAX if y is None else _common_prefix(x, y) for x, y in zip(head, node_head)),
                         np.int64, len(hist))
    best = np.zeros(len(hist))
    for lb in (lo, hi, np.clip(common, lo, hi)):
        best = np.maximum(best, bound(common, la, lb, prefix))
    return pd.Series(best)


def _common_prefix(x: str, y: str) -> int:
    n = 0
    for c, d in zip(x, y):
        if c != d:
            break
        n += 1
    return n


@F.pandas_udf(BinaryType())
def pack_histogram_udf(counts: pd.Series) -> pd.Series:
    """A histogram as 64 16-bit counts (names are far shorter than 65,535)."""
    return pd.Series([np.minimum(np.asarray(c), 65535).astype(np.uint16).tobytes() for c in counts])


@F.pandas_udf(ArrayType(IntegerType()))
def char_histogram_udf(s: pd.Series) -> pd.Series:
    values = s.fillna("").tolist()
    return pd.Series(list(char_histogram(values)))
