"""Loads into raw tables.

* ``stamp_metadata``: load columns added as literals / build time;
* ``ensure_table``: create the target from a declared schema if absent
  (the schema is frozen from then on: appends must match it), with one
  partition for each load if asked, and in it one for each day;
* ``stage``: the classified extract as a columnar file, so that its source
  is read once; its rows are counted by the write itself;
* ``write_split``: quarantine the rejected rows, then add the good ones as the
  partition of their load, or replace the table's rows with them. A load that
  runs again under its id replaces what it wrote, in both places;
* ``write_quoted_csv``: fully quoted CSV extract with a header.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import audit_loaded_at
from quarry.operators.validate import REASON
from quarry.schemas import schema_from_dtypes
from quarry.session import ensure_checkpoint_dir

#: Partition column of tables that loads add to.
LOAD_ID = "load_id"
#: Partition column, within a load, of event tables: the day of the event.
EVENT_DAY = "event_day"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"  # dynamic: only the partitions that come


def stamp_metadata(df: DataFrame, values: dict[str, object], loaded_at: dt.datetime | None = None,
                   loaded_at_col: str = "ingestion_timestamp") -> DataFrame:
    """Append the load timestamp and constant metadata columns, in order."""
    cols: list[Column] = [audit_loaded_at(loaded_at).alias(loaded_at_col)]
    cols += [F.lit(v).alias(k) for k, v in values.items()]
    return df.select("*", *cols)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 comment: str | None = None, properties: dict[str, str] | None = None,
                 dtypes: dict[str, str] | None = None, by_load: bool = False, by_day: bool = False) -> bool:
    """Create ``name`` with ``schema`` unless it exists. True if created.
    With an extract's ``dtypes`` the table has its columns, typed as in
    ``schema`` where declared there. ``by_load`` adds the partition column
    ``load_id``, which exactly-once loads need; ``by_day`` (with it) also
    ``event_day``, by which questions about some days read only those."""
    if spark.catalog.tableExists(name):
        return False
    if dtypes:
        schema = schema_from_dtypes(dtypes, schema)
    parts = [T.StructField(LOAD_ID, T.StringType())] if by_load else []
    if by_load and by_day:
        parts.append(T.StructField(EVENT_DAY, T.DateType()))
    schema = T.StructType([*schema.fields, *parts])
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format(fmt).mode("ignore")
    if parts:
        writer = writer.partitionBy(*[f.name for f in parts])
    if properties:
        for k, v in properties.items():
            writer = writer.option(k, v)
    writer.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
    return True


@dataclass
class LoadResult:
    rows_in: int
    rows_loaded: int
    rows_rejected: int
    table_rows: int | None = None


def load_count_columns() -> list[Column]:
    """rows_in, rows_loaded and rows_rejected of a classified plan, as aggregates."""
    return [
        F.count(F.lit(1)).cast("bigint").alias("rows_in"),
        F.count_if(F.col(REASON).isNull()).cast("bigint").alias("rows_loaded"),
        F.count_if(F.col(REASON).isNotNull()).cast("bigint").alias("rows_rejected"),
    ]


def load_counts(classified: DataFrame) -> DataFrame:
    """(rows_in, rows_loaded, rows_rejected) of a classified plan, one row."""
    return classified.agg(*load_count_columns())


def stage(classified: DataFrame) -> tuple[DataFrame, LoadResult]:
    """The classified extract written once, as columns, to the shared
    checkpoint folder (the files are read once, and the writes after it each
    read only their rows), and its counts, which that write observes."""
    spark = classified.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/load-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    seen = Observation()
    observed = classified.observe(seen, *load_count_columns())
    observed.toDF(*[f"c{i}" for i in range(len(classified.columns))]).write.parquet(path)
    staged = spark.read.parquet(path).toDF(*classified.columns)
    if staged.isEmpty():  # a plan known to be empty may run without its observation
        return staged, LoadResult(0, 0, 0)
    counts = seen.get
    return staged, LoadResult(counts["rows_in"], counts["rows_loaded"], counts["rows_rejected"])


def partitioning(columns: list[str]) -> list[str]:
    """Those of a table's columns that ``ensure_table`` partitions by."""
    return next((p for p in ([LOAD_ID, EVENT_DAY], [LOAD_ID]) if columns[-len(p):] == p), [])


def add_rows(good: DataFrame, table: str, load_id: str, refresh: bool = False, event_time: str | None = None) -> None:
    """Adds rows to ``table`` (or, with ``refresh``, replaces its rows by
    them). In a table partitioned by load they are the partition ``load_id``,
    put in place as a whole when the write ends: writing it again replaces it.
    If the table is partitioned by day too, the day is that of ``event_time``;
    the rows of a day are brought together, a large day in several files."""
    spark = good.sparkSession
    columns = spark.table(table).columns
    parts = partitioning(columns)
    by_load = bool(parts)
    if by_load:
        good = good.withColumn(LOAD_ID, F.lit(load_id))
    if EVENT_DAY in parts:
        if event_time is None:
            raise ValueError(f"{table} is partitioned by day: name the time of its events")
        good = good.withColumn(EVENT_DAY, F.to_date(F.col(f"`{event_time}`"))).hint("rebalance", F.col(EVENT_DAY))
    if good.columns != columns:
        raise ValueError(f"{table} has the columns {columns}, the load {good.columns}")
    kept = spark.conf.get(OVERWRITE_MODE)
    # By day a replay may hold other days than before: static mode clears the load's partitions, not only those that come.
    spark.conf.set(OVERWRITE_MODE, "dynamic" if parts == [LOAD_ID] and not refresh else "static")
    try:
        if EVENT_DAY in parts and not refresh:
            load = load_id.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_ID} = '{load}', {EVENT_DAY}) SELECT * FROM {{rows}}", rows=good.drop(LOAD_ID))
        else:
            good.write.insertInto(table, overwrite=by_load or refresh)
    finally:
        spark.conf.set(OVERWRITE_MODE, kept)


def write_split(staged: DataFrame, counts: LoadResult, good_cols: list[Column], table: str, quarantine_path: str, load_id: str,
                refresh: bool = False, event_time: str | None = None) -> None:
    """Write rejected rows to ``quarantine_path`` (parquet, replaced), then
    the good rows to ``table``. Columns are matched by name."""
    if counts.rows_rejected:
        staged.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(quarantine_path)
    add_rows(staged.where(F.col(REASON).isNull()).select(*good_cols), table, load_id, refresh, event_time)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target).close()


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """CSV extract with a header, every field quoted and quotes doubled; text stays as it is."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
