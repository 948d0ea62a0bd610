"""Scalar helpers used by the models.

Every helper returns a Column built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. ANSI mode is assumed on: casts of bad
text and out-of-range array indexes are written with their ``try_`` /
``get`` forms, which give NULL instead of failing the task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Epoch origin as a zone-less timestamp, so the conversion below does
# not depend on the session time zone.
_EPOCH_NTZ = "1970-01-01 00:00:00"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_text(c: ColumnOrName) -> Column:
    """Upper-case text; NULL stays NULL."""
    return F.upper(_col(c))


def to_day(c: ColumnOrName) -> Column:
    """Calendar day of a date or timestamp."""
    return F.to_date(_col(c))


# Text date layouts accepted besides ISO ``yyyy-M-d`` (with or without a
# time part), in the order tried (fixed values).
TEXT_DATE_FORMATS = ("M/d/yyyy",)


def text_to_date(c: ColumnOrName) -> Column:
    """Date from text (ISO first, then US month/day/year); text that is
    not a date becomes NULL."""
    col = _col(c)
    return F.coalesce(F.try_to_date(col), *[F.try_to_date(col, f) for f in TEXT_DATE_FORMATS])


def iso_week(c: ColumnOrName) -> Column:
    """ISO-8601 week number (weeks start Monday, week 1 holds a Thursday)."""
    return F.weekofyear(_col(c))


def calendar_year(c: ColumnOrName) -> Column:
    return F.year(_col(c))


def calendar_month(c: ColumnOrName) -> Column:
    return F.month(_col(c))


def null_default(c: ColumnOrName, value) -> Column:
    """``COALESCE(c, value)``."""
    return F.coalesce(_col(c), F.lit(value))


def lit_ntz(value: dt.datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def epoch_millis_to_ntz(ms: ColumnOrName) -> Column:
    """Epoch milliseconds to a zone-less timestamp (UTC wall clock).

    0 and NULL both mean "no time" and give NULL.
    """
    millis = F.nullif(_col(ms), F.lit(0))
    return F.timestamp_add("MILLISECOND", millis, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def safe_index(arr: ColumnOrName, i: int) -> Column:
    """0-based array element, NULL when the array is shorter or NULL."""
    return F.get(_col(arr), F.lit(i))


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace (spaces, tabs, line breaks).

    ``trim`` removes spaces only, so two anchored regex replacements are
    used instead.
    """
    return F.regexp_replace(F.regexp_replace(_col(c), r"^\s+", ""), r"\s+$", "")


def last_token(c: ColumnOrName, sep: str = ",") -> Column:
    """Last ``sep``-separated token, stripped. No separator -> whole text."""
    return strip_ws(F.element_at(F.split(_col(c), sep), -1))


def null_tokens(c: ColumnOrName, tokens: Iterable[str]) -> Column:
    """NULL where the text is one of ``tokens`` (exact, case-sensitive)."""
    col = _col(c)
    tokens = list(tokens)
    if not tokens:
        return col
    return F.when(col.isin(tokens), F.lit(None)).otherwise(col)


def present(c: ColumnOrName, numeric: bool = False) -> Column:
    """Required-field test: not NULL, and for doubles also not NaN."""
    col = _col(c)
    cond = col.isNotNull()
    if numeric:
        cond = cond & ~F.isnan(col)
    return cond


def audit_loaded_at(loaded_at: dt.datetime | None) -> Column:
    """Build timestamp: the given literal, or the query's current time."""
    if loaded_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return lit_ntz(loaded_at)
