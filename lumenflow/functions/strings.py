"""String helpers, all built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text inside round brackets, every occurrence, brackets included; the
# surrounding spaces are left alone.
PARENTHESISED = r"\([^)]*\)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_key(*cols: Column | str) -> Column:
    """Plain concatenation without separator; any null part gives null."""
    return F.concat(*[_col(c).cast("string") for c in cols])


def strip_parenthesised(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), PARENTHESISED, "")


def text_upper(c: Column | str, null_text: str = "NONE") -> Column:
    """Upper-case the text form of a value.

    A null becomes ``null_text`` first: the matching step turns missing
    master names into text before comparing, so a null name can still be
    compared (and is matched as that text).
    """
    return F.upper(F.coalesce(_col(c).cast("string"), F.lit(null_text)))


def clean_name(c: Column | str, null_text: str = "NONE") -> Column:
    """Upper-cased text form with bracketed parts removed."""
    return strip_parenthesised(text_upper(c, null_text))


def prefix_ilike(c: Column | str, prefix: str) -> Column:
    """Case-insensitive ``LIKE '<prefix>%'``; ``_`` and ``%`` in the prefix
    stay wildcards, as in SQL."""
    return _col(c).ilike(prefix + "%")


def join_names(*cols: Column | str, sep: str = "_") -> Column:
    """``a_b_c_d``; null if any part is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c))
    return F.concat(*parts)
