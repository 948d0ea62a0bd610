"""Sheet-style text export.

Each file starts with ``PREAMBLE_LINES`` lines of notes and a header on
the next line; the header is discarded and columns are named by
position. Files are read in parallel blocks, records with line breaks in
quoted cells included (``csv_blocks``); only the first block of each file
holds the preamble, so the lines are dropped there. A file with quotes
inside a cell is read line by line. The first block of a file must hold
all preamble lines (any block size above a few KB does).

Text stays as it is: a quoted empty field is an empty string, not NULL
(extracts are written fully quoted). An unquoted empty field reads as
NULL, which is how Spark's CSV parser treats it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.schemas import RIG_SHEET_COLUMNS
from quarry.sources import csv_blocks

# 10 note lines, then the header line (line 11).
PREAMBLE_LINES = 10
HEADER_LINES = 1

_LINES = T.StructType([T.StructField("value", T.StringType()), T.StructField("file_path", T.StringType())])


def _drop_leading(skip: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            first = pdf["block_start"].eq(0)
            keep = pd.Series(True, index=pdf.index)
            if first.any():
                # Position of each line within its file's first split.
                pos = pdf[first].groupby("file_path", sort=False).cumcount()
                offset = pdf.loc[first, "file_path"].map(seen).fillna(0).astype("int64")
                keep.loc[first] = (pos + offset) >= skip
                for path, n in pdf[first].groupby("file_path", sort=False).size().items():
                    seen[path] = seen.get(path, 0) + int(n)
            yield pdf.loc[keep, ["value", "file_path"]]
    return run


def read_sheet_lines(spark: SparkSession, paths: str | Sequence[str], skip: int = PREAMBLE_LINES + HEADER_LINES,
                     stream: bool = False) -> DataFrame:
    """Data lines of the sheet exports (``value``, ``file_path``).

    With ``stream`` the folder ``paths`` is read as a file stream (new
    files only, tracked by the query's checkpoint)."""
    if stream:
        raw = spark.readStream.text(paths)
    else:
        raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    lines = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    return lines.mapInPandas(_drop_leading(skip), schema=_LINES).where(F.length(F.trim("value")) > 0)


def parse_positional(lines: DataFrame, names: Sequence[str] = RIG_SHEET_COLUMNS) -> DataFrame:
    """Split each CSV record into text columns named by position.

    Records with a different field count keep their text in
    ``_corrupt_record`` (and NULL fields), so they can be quarantined.
    """
    return csv_blocks.parse(lines, names, "_corrupt_record")


def read_sheet_records(spark: SparkSession, paths: str | Sequence[str], skip: int = PREAMBLE_LINES + HEADER_LINES) -> DataFrame:
    """Data records of the sheet exports (``value``, ``file_path``)."""
    records, ill = csv_blocks.read_records(spark, [paths] if isinstance(paths, str) else paths, skip)
    rows = records.select("value", "file_path").where(F.length(F.trim("value")) > 0)
    return rows.unionByName(read_sheet_lines(spark, ill, skip)) if ill else rows


def read_rig_sheet(spark: SparkSession, paths: str | Sequence[str], stream: bool = False) -> DataFrame:
    """The rig sheet as text columns with its 12 positional names (a
    ``stream`` is read line by line)."""
    return parse_positional(read_sheet_lines(spark, paths, stream=True) if stream else read_sheet_records(spark, paths))
