"""Data-quality checks (Q1-Q3) returned as ordinary DataFrames.

Each check is one aggregate pass over its table (partial aggregation
before the shuffle), never a collect; the outputs are small summaries
with one row per (table, column, check).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import lit_ntz

# Freshness limits of the raw sources.
WARN_AFTER = dt.timedelta(hours=24)
ERROR_AFTER = dt.timedelta(hours=48)

SUMMARY_COLUMNS = ["table_name", "column_name", "check_name", "failures", "status"]


def _status(failures):
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL count per column in a single scan, one output row per column."""
    counts = df.agg(*[
        F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias(f"c{i}") for i, c in enumerate(columns)
    ])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, c in enumerate(columns)
    ]))
    return counts.select(stacked.alias("s")).select(
        F.lit(table).alias("table_name"),
        F.col("s.column_name").alias("column_name"),
        F.lit("not_null").alias("check_name"),
        F.col("s.failures").alias("failures"),
        _status(F.col("s.failures")).alias("status"),
    )


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values present more than once (NULLs ignored), with their counts."""
    c = F.col(f"`{column}`")
    return (
        df.where(c.isNotNull())
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """One summary row: how many values break uniqueness."""
    return unique_summary(unique_violations(df, column), table, column)


def unique_summary(violations: DataFrame, table: str, column: str) -> DataFrame:
    """The summary row of a unique check, from the values that break it."""
    return violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("check_name"),
        F.col("failures"),
        _status(F.col("failures")).alias("status"),
    )


def freshness(
    df: DataFrame,
    table: str,
    loaded_at: str,
    as_of: dt.datetime,
    warn_after: dt.timedelta = WARN_AFTER,
    error_after: dt.timedelta = ERROR_AFTER,
) -> DataFrame:
    """Age of the newest row against ``as_of``: pass / warn / error.

    ``age <= warn_after`` passes, ``age <= error_after`` warns, anything
    older errors; an empty table (no loaded-at value) is an error.
    """
    newest = df.agg(F.max(F.col(f"`{loaded_at}`").cast("timestamp_ntz")).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), lit_ntz(as_of))
    return newest.select(
        F.lit(table).alias("table_name"),
        F.col("max_loaded_at"),
        age.cast("bigint").alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age <= int(warn_after.total_seconds()), F.lit("pass"))
        .when(age <= int(error_after.total_seconds()), F.lit("warn"))
        .otherwise(F.lit("error"))
        .alias("status"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def freshness_by(
    df: DataFrame,
    source: Column,
    loaded_at: str,
    as_of: dt.datetime,
    warn_after: dt.timedelta = WARN_AFTER,
    error_after: dt.timedelta = ERROR_AFTER,
) -> DataFrame:
    """Freshness of many sources held in one table, one row per source
    (a grouped max with partial aggregation, not one scan per source)."""
    newest = df.groupBy(source.alias("table_name")).agg(
        F.max(F.col(f"`{loaded_at}`").cast("timestamp_ntz")).alias("max_loaded_at")
    )
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), lit_ntz(as_of))
    return newest.select(
        "table_name",
        "max_loaded_at",
        age.cast("bigint").alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age <= int(warn_after.total_seconds()), F.lit("pass"))
        .when(age <= int(error_after.total_seconds()), F.lit("warn"))
        .otherwise(F.lit("error"))
        .alias("status"),
    )


def unique_many(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """``unique`` for several columns in one scan of the table.

    One grouping-sets aggregate counts every value of every column (each
    set groups one column; ``grouping_id`` tells the sets apart), then a
    single global aggregate counts, per column, the values seen more
    than once. NULLs are ignored as in ``unique``.
    """
    if len(columns) == 1:
        return unique(df, table, columns[0])
    k = len(columns)
    cols = [F.col(f"`{c}`") for c in columns]
    counted = df.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid")
    )
    dup = counted.where(F.col("__n") > 1)
    full = (1 << k) - 1
    per_column = dup.agg(*[
        F.count_if((F.col("__gid") == F.lit(full ^ (1 << (k - 1 - i)))) & cols[i].isNotNull()).cast("bigint").alias(f"c{i}")
        for i in range(k)
    ])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(columns)
    ]))
    return per_column.select(stacked.alias("s")).select(
        F.lit(table).alias("table_name"),
        F.col("s.column_name").alias("column_name"),
        F.lit("unique").alias("check_name"),
        F.col("s.failures").alias("failures"),
        _status(F.col("s.failures")).alias("status"),
    )
