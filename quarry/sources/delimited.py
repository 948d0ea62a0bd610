"""Lenient delimited-file loads.

Files are read with every column as text plus a corrupt-record column,
so a row with the wrong number of fields is kept (flagged) rather than
silently dropped, and the whole schema is always read (the corrupt
column is only reliable when no column is pruned). Columns are found by
their header names, in whatever order the file has them; a missing one is
an error. Quoted fields may hold line breaks; files larger than a task's
share are cut into blocks and read by many tasks (``csv_blocks``), others, and
files with quotes inside a field, by one task each. Per-source NULL tokens are applied before typing;
``operators.validate`` then splits typed good rows from quarantined ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import null_tokens
from quarry.sources import csv_blocks

CORRUPT = "_corrupt_record"
# A value that never occurs in the data, so the reader itself turns no
# text into NULL (a quoted empty field stays an empty string).
NO_NULL_TEXT = "\u0000"


def read_text_columns(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    header: bool = True,
    null_values: Iterable[str] = (),
    quote: str = '"',
    multiline: bool = True,
    blocks: bool | None = None,
) -> DataFrame:
    """Read CSV as text columns (by header name, without a header by
    position) with NULL tokens applied. ``blocks`` tells whether files are read
    by many tasks each (if not given: those that are larger than a task's
    share, ``spark.sql.files.maxPartitionBytes``); the rows are the same.

    A missing path fails at analysis, as a missing input file should; so
    does a file without one of the columns. Files read together must have
    one header.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = {"header": header, "quote": quote, "escape": quote, "multiLine": multiline, "columnPruning": False}
    wanted = [f.name for f in schema.fields]

    def read(path: str) -> DataFrame:
        names = wanted
        if header:
            names = spark.read.options(**options).csv(path).columns
            missing = sorted(set(wanted) - set(names))
            if missing or len(set(names)) < len(names):
                raise ValueError(f"{path}: no column {missing}" if missing else f"{path}: a column name comes twice")
        if multiline and quote == '"' and (blocks if blocks is not None else larger_than_a_task(spark, path)):
            by_blocks = _blocks(spark, path, names, header)
            if by_blocks is not None:
                return by_blocks.select(*[F.col(f"`{n}`") for n in wanted], CORRUPT)
        found = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])
        rows = (
            spark.read.schema(found)
            .options(**options)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("nullValue", NO_NULL_TEXT)
            .option("enforceSchema", False)
            .csv(path)
        )
        return rows.select(*[F.col(f"`{n}`") for n in wanted], CORRUPT)

    df = read(paths[0])
    for path in paths[1:]:
        df = df.unionByName(read(path))
    return _without_tokens(df, null_values)


def larger_than_a_task(spark: SparkSession, path: str) -> bool:
    """Whether a file at ``path`` is larger than what a task reads at most."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return any(f.getLen() > most for f in found or [])


def _blocks(spark: SparkSession, path: str, names: list[str], header: bool) -> DataFrame | None:
    """The rows of the files at ``path``, read by blocks; None if a quote in them stands inside a field."""
    records, ill = csv_blocks.read_records(spark, [path])
    if ill:
        return None
    if header:  # the first record of each file
        first = F.broadcast(records.where("block = 0").groupBy("file_path").agg(F.min("seq").alias("first")))
        records = records.join(first, "file_path").where("block <> 0 or seq <> first")
    return csv_blocks.parse(records, names, CORRUPT)


def stream_text_columns(spark: SparkSession, folder: str, schema: T.StructType, null_values: Iterable[str] = (), quote: str = '"') -> DataFrame:
    """The files of a drop folder as a stream of text columns. Files must have
    the declared columns in order; another header is an error."""
    found = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    options = {"header": True, "quote": quote, "escape": quote, "multiLine": True, "columnPruning": False, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": CORRUPT, "nullValue": NO_NULL_TEXT, "enforceSchema": False}
    return _without_tokens(spark.readStream.schema(found).options(**options).csv(folder), null_values)


def _without_tokens(df: DataFrame, null_values: Iterable[str]) -> DataFrame:
    tokens = list(null_values)
    if not tokens:
        return df
    return df.select(*[
        (null_tokens(F.col(f"`{f.name}`"), tokens).alias(f.name) if f.name != CORRUPT else F.col(CORRUPT))
        for f in df.schema.fields
    ])
