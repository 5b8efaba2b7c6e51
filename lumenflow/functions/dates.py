"""Month and quarter helpers.

Months travel as ``yyyy-MM`` strings (the run parameter and the partition
key of the monthly table) and as the first day of the month (``DateType``).
Column helpers stay JVM-side; the ``*_label`` Python helpers compute run
literals in the driver so that partition filters are static.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_PATTERN = "yyyy-MM"


def month_start(month_label: Column | str) -> Column:
    """``'2024-01'`` -> date 2024-01-01 (null stays null)."""
    label = F.col(month_label) if isinstance(month_label, str) else month_label
    return F.to_date(F.concat(label, F.lit("-01")))


def month_label(date_col: Column | str) -> Column:
    """date -> ``'yyyy-MM'``."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.date_format(d, MONTH_PATTERN)


def month_shift(date_col: Column | str, months: int) -> Column:
    """Calendar month arithmetic on a date (``add_months`` keeps a date)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.add_months(d, months)


def quarter_label(date_col: Column | str, quarters_ahead: int = 0) -> Column:
    """date -> ``'<year>-<quarter>'`` such as ``'2024-1'`` (no zero padding)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    if quarters_ahead:
        d = F.add_months(d, 3 * quarters_ahead)
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.quarter(d).cast("string"))


# --- driver-side literals -------------------------------------------------

def parse_month(label: str) -> _dt.date:
    year, month = label.split("-")
    return _dt.date(int(year), int(month), 1)


def shift_label(label: str, months: int) -> str:
    d = parse_month(label)
    idx = d.year * 12 + (d.month - 1) + months
    return f"{idx // 12:04d}-{idx % 12 + 1:02d}"


def quarter_months(label: str) -> list[str]:
    """The three month labels of the calendar quarter holding ``label``."""
    d = parse_month(label)
    first = (d.month - 1) // 3 * 3 + 1
    return [f"{d.year:04d}-{m:02d}" for m in range(first, first + 3)]


def previous_quarter_months(label: str) -> list[str]:
    return quarter_months(shift_label(quarter_months(label)[0], -1))
