"""Grouped measures used by the marts.

All are built-in aggregate functions, so Spark plans a partial
(map-side) aggregate before each shuffle; exact distinct counts stay
exact (``count(DISTINCT ...)``), never approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows() -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1))


def count_when(cond: Column) -> Column:
    """``COUNT_IF(cond)``; a group with no true row gives 0."""
    return F.count_if(cond)


def sum_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def exact_distinct(c: Column | str) -> Column:
    """Exact distinct count, NULLs ignored."""
    return F.count_distinct(F.col(c) if isinstance(c, str) else c)


def grouped(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """``GROUP BY keys`` with named measures."""
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
