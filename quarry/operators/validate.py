"""Lenient typing of raw text rows.

A row is quarantined, not lost, when it has the wrong number of fields
(the reader's corrupt-record column is set), when a non-NULL text does
not cast to its target type, or when a text value is longer than the
storage limit. NULL input is not an error. Good rows come out typed;
quarantined rows keep their raw text and a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.schemas import MAX_TEXT

REASON = "_reject_reason"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def reject_reason(schema: T.StructType, corrupt_col: str | None = None, max_text: int = MAX_TEXT) -> Column:
    """First failing rule of a row of raw text columns, NULL if the row is good."""
    checks: list[tuple[Column, str]] = []
    if corrupt_col:
        checks.append((_q(corrupt_col).isNotNull(), "malformed"))
    for f in schema.fields:
        raw = _q(f.name)
        if isinstance(f.dataType, T.StringType):
            checks.append((F.length(raw) > max_text, f"too_long:{f.name}"))
        else:
            checks.append((raw.isNotNull() & raw.try_cast(f.dataType).isNull(), f"bad_value:{f.name}"))
    reason = F.lit(None).cast("string")
    for cond, label in reversed(checks):
        reason = F.when(cond, F.lit(label)).otherwise(reason)
    return reason


def typed_columns(schema: T.StructType) -> list[Column]:
    return [
        (_q(f.name) if isinstance(f.dataType, T.StringType) else _q(f.name).try_cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]


def classify(raw: DataFrame, schema: T.StructType, corrupt_col: str | None = None, max_text: int = MAX_TEXT) -> DataFrame:
    """Raw text columns plus the reject reason (NULL for good rows)."""
    return raw.withColumn(REASON, reject_reason(schema, corrupt_col, max_text))


def split_good_bad(
    raw: DataFrame, schema: T.StructType, corrupt_col: str | None = None, max_text: int = MAX_TEXT
) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, quarantined raw rows with a reason).

    Both sides come from one classified plan; write them in one job with
    ``sinks.writers.write_split`` to scan the input once.
    """
    tagged = classify(raw, schema, corrupt_col, max_text)
    good = tagged.where(F.col(REASON).isNull()).select(*typed_columns(schema))
    keep = [f.name for f in schema.fields] + ([corrupt_col] if corrupt_col else [])
    bad = tagged.where(F.col(REASON).isNotNull()).select(*[_q(c) for c in keep], F.col(REASON))
    return good, bad
