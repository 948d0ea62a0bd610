"""Equi joins with size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest lookup table broadcast by a hint.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 62  # taken for a plan without an estimate


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (no job is run).

    For file scans this is the file size scaled to the read columns; it
    ignores filters, so it errs on the large side. A plan without
    statistics counts as large.
    """
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # no plan statistics: not known to be small
        return UNKNOWN_BYTES


def proven_rows(df: DataFrame) -> int | None:
    """Catalyst's bound on the number of rows (rows given by the driver, limits,
    global aggregates); None where the plan has none. No job is run."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def source_bytes(df: DataFrame) -> int:
    """Catalyst's sizes of the tables that ``df`` reads, added up (no job)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def bounded_broadcast(
    df: DataFrame,
    max_bytes: int = BROADCAST_MAX_BYTES,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``df`` with a broadcast hint only where its plan proves it small.

    Building the join starts no job. A plan with a bound on its rows (the
    seed, other rows of the driver, limits) gets the hint if that bound and
    the size estimate are low. Any other lookup goes without a hint: the
    planner broadcasts a file below the session's
    ``spark.sql.autoBroadcastJoinThreshold``, adaptive execution one that
    turns out to be below it, and everything else is joined by shuffle.
    """
    rows = proven_rows(df)
    if rows is None or rows > max_rows or estimated_bytes(df) > max_bytes:
        return df
    return F.broadcast(df)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Column | Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join a fact table to a lookup table, broadcast if its plan, its files or
    its size at run time say that it is small."""
    return facts.join(bounded_broadcast(lookup), on=on, how=how)
