"""Fill-in-the-middle by rotations of blocks inside one buffer.

A text is cut at two places into prefix, middle and suffix.  Cuts lie between
units, ``[A-Za-z]+|[^A-Za-z]`` from left to right over code points, so a word is
never cut and neither is a character's UTF-8 sequence; they are drawn from a
SHA-256 of the seed and the document's id.  One scan marks where units start.

The three sentinels are inserted into one byte buffer, each before its segment
and in the text's order, ``<P>`` prefix ``<M>`` middle ``<S>`` suffix.  An
exchange of two neighbouring blocks is then a rotation, done by three reversals:
each block, and both together.

* ``psm``   the last two blocks change places: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``   the suffix goes before the other two: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain`` the text as it stands

``restore`` finds the sentinels in an output, runs the rotation the other way
round and takes the sentinels out; what comes back is the text, byte for byte.
A sentinel can't arise where text and sentinel meet, as it starts with ``<`` and
ends with ``>``.

Defined results: a null or empty text, and one that holds a sentinel, is plain; a
document's result depends on its id and text only, so rows that repeat come out
alike; a null id is drawn for as the empty string; very long texts are handled
one at a time, in a buffer of their own size; an empty table gives none;
``fim_texts`` keeps all other columns and replaces ``form`` and ``fim`` where the
input has columns of these names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenflow.llm.words import text_column, text_slices

# fixed values: the sentinels
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
PLAIN_FROM = 90             # of 100: draws from here on leave the text plain
SPM_BELOW = 20              # of 100: draws below put the suffix first

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units of a UTF-8 text start."""
    if not len(raw):
        return np.empty(0, np.int64)
    letter = _LETTER[raw]
    first = (raw & 0xC0) != 0x80
    first[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(first)


def n_chars(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _reverse(view: np.ndarray, a: int, b: int) -> None:
    """Reverse ``view[a:b]`` in place, half of it at a time."""
    half = (b - a) // 2
    left = view[a:a + half].copy()
    view[a:a + half] = view[b - half:b][::-1]
    view[b - half:b] = left[::-1]


def rotate(buffer: bytearray, a: int, b: int, c: int) -> None:
    """Exchange the blocks ``[a, b)`` and ``[b, c)`` in place, by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    _reverse(view, a, b)
    _reverse(view, b, c)
    _reverse(view, a, c)


@dataclass(frozen=True)
class Filled:
    n: int                  # units of the text
    form: str
    output: bytes
    prefix_chars: int | None
    middle_chars: int | None


def transform(text: bytes, doc_id: int | None, seed: int = SEED) -> Filled:
    raw = np.frombuffer(text, np.uint8)
    starts = unit_starts(raw)
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return Filled(n, "plain", text, None, None)
    cuts = np.append(starts, len(text))
    lo, hi = (int(cuts[k]) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    buffer = bytearray(text)
    for at, mark in ((hi, SUFFIX), (lo, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix, end = len(PREFIX) + lo, len(PREFIX) + len(MIDDLE) + hi, len(buffer)
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    rotate(buffer, 0 if form == "spm" else middle, suffix, end)
    return Filled(n, form, bytes(buffer), n_chars(raw[:lo]), n_chars(raw[lo:hi]))


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` turned into ``output``."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    p, s, m = (output.index(mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    if form == "spm":
        rotate(buffer, s, p, len(buffer))
        m -= p
        s, p = len(buffer) - p, 0
    else:
        rotate(buffer, s, m, len(buffer))
        s, m = s + len(buffer) - m, s
    for at, mark in ((s, SUFFIX), (m, MIDDLE), (p, PREFIX)):
        del buffer[at:at + len(mark)]
    return bytes(buffer)


def _filled(batch: pa.RecordBatch, ids: pa.Array, seed: int):
    """(text, result) of each row of a batch."""
    row = 0
    for _, _, raw, offs in text_slices(text_column(batch, "text")):
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            text = raw[a:b].tobytes()
            yield text, transform(text, ids[row].as_py(), seed)
            row += 1


def fim_report(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256) of every document; the last is of what ``restore`` gives."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            rows = [(f.n, f.form, f.prefix_chars, f.middle_chars, hashlib.sha256(f.output).hexdigest(),
                     hashlib.sha256(restore(f.output, f.form)).hexdigest()) for _, f in _filled(batch, ids, seed)]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def _added(docs: DataFrame, name: str) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField("form", T.StringType()), T.StructField(name, T.StringType())])


def fim_texts(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``form`` and the transformed text ``fim``."""
    docs = docs.drop("form", "fim")
    schema = _added(docs, "fim")

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            rows = [f for _, f in _filled(batch, ids, seed)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f.form for f in rows], pa.string()),
                 pa.array([f.output for f in rows], pa.binary()).cast(pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def restored_texts(filled: DataFrame) -> DataFrame:
    """``filled`` (of ``fim_texts``) with the text rebuilt from ``form`` and
    ``fim`` alone, as ``restored``; a null text comes back empty."""
    rows = filled.drop("restored")
    schema = T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())])

    def run(batches):
        for batch in batches:
            forms, outputs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("form", "fim"))
            texts = [restore(o.encode(), f) for o, f in zip(outputs, forms)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
