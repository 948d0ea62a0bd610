"""Global ranks and positions over a whole DataFrame.

``RANK() OVER (ORDER BY m DESC)`` and ``ROW_NUMBER() OVER (ORDER BY m
DESC, key)`` without a PARTITION BY put every row into one task. For
aggregated groups (states, counties) that is the right plan: one lazy
window, no job while the query is built.

``large=True`` is for inputs of any size, and gives the same numbers:

* rank: rows collapse to distinct values with their counts first, so a
  value that holds a third of all rows is one row from then on. The
  distinct values are dealt into ranges of the order; a window inside each
  range and the ranges' totals give the number of rows before a value,
  which is joined back on the value;
* position: rows are dealt into ranges of ``(value, keys)``. The keys make
  that order unique, so a hot value spreads over many ranges.

Several ranks at once are one such pass: the values of all metrics are
stacked with their counts, dealt into ranges of (metric, value) together, and
each metric has its own range totals.

``large=None`` decides by what is known: what is read from little data is
ranked by the window, without a job; other groups are checkpointed, which
marts on large tables would compute once for each rank otherwise, and counted.

The dealt rows are checkpointed (``spark.checkpoint.dir``) with the number
of their range, so every later step sees the same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import source_bytes
from quarry.session import ensure_checkpoint_dir

ROWS_PER_TASK = 2_000_000
WINDOW_BYTES = 1 << 30  # groups of tables of this size together are ranked in one task without a count

_PART, _ROWS, _BEFORE = "__part", "__rows", "__before"


def _order(value: str, keys: Sequence[str], descending: bool, nulls_first: bool) -> list[Column]:
    v = F.col(value)
    if descending:
        first = v.desc_nulls_first() if nulls_first else v.desc_nulls_last()
    else:
        first = v.asc_nulls_first() if nulls_first else v.asc_nulls_last()
    return [first] + [F.col(k).asc_nulls_first() for k in keys]


def add_rank(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    rank_col: str | None = None,
    position_col: str | None = None,
    descending: bool = True,
    nulls_first: bool = True,
    large: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``RANK()`` and/or ``ROW_NUMBER()`` over the whole DataFrame.

    Order is ``value`` (descending, NULLs first by default), then the
    unique ``keys`` ascending as the tie-break for positions. Ranks and
    positions are bigint.
    """
    order = _order(value, keys, descending, nulls_first)
    if large:
        ensure_checkpoint_dir(df.sparkSession)
        if position_col:
            df = _numbered(df, order, F.lit(1), position_col, rows_per_task)
        return _ranked_values(df, value, order[0], rank_col, rows_per_task) if rank_col else df
    if position_col:
        df = df.withColumn(position_col, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    if rank_col:
        df = df.withColumn(rank_col, F.rank().over(Window.orderBy(order[0])).cast("bigint"))
    return df


def _numbered(df: DataFrame, order: list[Column], weight: Column, out: str, rows_per_task: int) -> DataFrame:
    """``out`` = total weight of the rows up to and including each row."""
    df = df.checkpoint(eager=True)
    parts = max(1, math.ceil(df.count() / rows_per_task))
    dealt = df.repartitionByRange(parts, *order).withColumn(_PART, F.spark_partition_id()).checkpoint(eager=True)
    totals = dealt.groupBy(_PART).agg(F.sum(weight).alias(_ROWS))  # one row a range
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PART, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_BEFORE))
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        dealt.join(F.broadcast(offsets), _PART)
        .withColumn(out, (F.col(_BEFORE) + F.sum(weight).over(inside)).cast("bigint"))
        .drop(_PART, _BEFORE)
    )


def _ranked_values(df: DataFrame, value: str, order: Column, rank_col: str, rows_per_task: int) -> DataFrame:
    counts = df.groupBy(F.col(value).alias("__value")).agg(F.count("*").alias("__n"))
    values = _numbered(counts.withColumnRenamed("__value", value), [order], F.col("__n"), "__upto", rows_per_task)
    ranks = values.select(F.col(value).alias("__value"), (F.col("__upto") - F.col("__n") + 1).cast("bigint").alias(rank_col))
    return df.join(ranks, df[value].eqNullSafe(ranks["__value"])).drop("__value")


def checked_groups(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, bool]:
    """(``df``, whether it has too many rows for a window in one task)."""
    if source_bytes(df) <= WINDOW_BYTES:
        return df, False
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return df, df.count() > rows_per_task


def _ranked_together(df: DataFrame, ranks: dict[str, str], descending: bool, nulls_first: bool, rows_per_task: int) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    columns = list(ranks.values())
    own = [f"__value{i}" for i in range(len(columns))]  # a column for each metric's type
    one = lambda i: F.struct(F.lit(i).alias("__metric"), *[
        (F.col(c) if i == j else F.lit(None).cast(df.schema[c].dataType)).alias(own[j]) for j, c in enumerate(columns)
    ])
    stacked = df.select(F.explode(F.array(*[one(i) for i in range(len(columns))])).alias("s")).select("s.*")
    counts = stacked.groupBy("__metric", *own).agg(F.count("*").alias("__n")).checkpoint(eager=True)
    order = [_order(c, [], descending, nulls_first)[0] for c in own]
    parts = max(1, math.ceil(counts.count() / rows_per_task))
    dealt = counts.repartitionByRange(parts, F.col("__metric"), *order).withColumn(_PART, F.spark_partition_id()).checkpoint(eager=True)
    totals = dealt.groupBy("__metric", _PART).agg(F.sum("__n").alias(_ROWS))  # a row for each range and metric
    before = Window.partitionBy("__metric").orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__metric", _PART, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_BEFORE))
    inside = Window.partitionBy("__metric", _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.col(_BEFORE) + F.sum("__n").over(inside) - F.col("__n") + 1
    ranked = dealt.join(F.broadcast(offsets), ["__metric", _PART]).withColumn("__rank", rank.cast("bigint")).checkpoint(eager=True)
    for i, (out_col, c) in enumerate(ranks.items()):
        found = ranked.where(F.col("__metric") == i).select(F.col(own[i]).alias("__value"), F.col("__rank").alias(out_col))
        df = df.join(found, F.col(c).eqNullSafe(F.col("__value"))).drop("__value")
    return df


def add_ranks(
    df: DataFrame,
    ranks: dict[str, str],
    keys: Sequence[str],
    descending: bool = True,
    nulls_first: bool = True,
    large: bool | None = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Several independent ranks: ``{output column: value column}``."""
    if large is None:
        df, large = checked_groups(df, rows_per_task)
    if large:
        return _ranked_together(df, ranks, descending, nulls_first, rows_per_task)
    for out_col, value in ranks.items():
        df = add_rank(df, value, keys, rank_col=out_col, descending=descending, nulls_first=nulls_first)
    return df
