"""Projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def passthrough(df: DataFrame) -> DataFrame:
    """``SELECT *`` (a view over the table; pruning still reaches the scan)."""
    return df.select("*")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep and rename columns in ``mapping`` order: ``{source: target}``."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])
