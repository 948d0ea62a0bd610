"""Uniqueness over appended loads (Q2), without grouping the whole table again.

Beside a raw table stands a table of its keys: for each load, its distinct
non-NULL keys with their counts, bucketed by the key's hash. A load adds its
own keys only. All loads hold a key in the same bucket, so keys that stand
more than once are found bucket by bucket: neither a check of the whole table
nor one of a load moves the keys.

A load's keys are its partition there, as its rows are in the raw table, so a
replay replaces them. Keys of loads that the raw table does not hold (a write
that failed after its keys were in, rows replaced by a refresh) do not count.

Each load adds up to one file a bucket; choose ``buckets`` for the keys that
the table will hold in the end, at some millions a bucket.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import quality
from quarry.sinks import writers

KEY, N = "key", "n_records"
BUCKETS = 64


def name_of(table: str, column: str) -> str:
    return f"{table}__keys_{column.lower()}"


def ensure(spark: SparkSession, table: str, column: str, key_type: T.DataType | None = None, buckets: int = BUCKETS) -> str:
    """The key table of ``table.column``, created if absent; its name."""
    name = name_of(table, column)
    if not spark.catalog.tableExists(name):
        key_type = key_type or spark.table(table).schema[column].dataType
        schema = T.StructType([T.StructField(KEY, key_type), T.StructField(N, T.LongType()), T.StructField(writers.LOAD_ID, T.StringType())])
        empty = spark.createDataFrame([], schema)
        empty.write.format("parquet").mode("ignore").partitionBy(writers.LOAD_ID).bucketBy(buckets, KEY).saveAsTable(name)
    return name


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def add(good: DataFrame, table: str, column: str, load_id: str) -> None:
    """The keys of a load (its rows ``good``) as its partition of the key table."""
    spark = good.sparkSession
    name = ensure(spark, table, column, good.schema[column].dataType)
    c = F.col(f"`{column}`")
    keys = good.where(c.isNotNull()).groupBy(c.alias(KEY)).agg(F.count(F.lit(1)).alias(N))
    writers.add_rows(keys.repartition(_buckets(spark, name), KEY), name, load_id)
    spark.catalog.refreshTable(name)


def _loads(spark: SparkSession, table: str) -> list[str]:
    """Ids of the loads that ``table`` holds, from its partitions' names."""
    spec = spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", rf"(?:^|/){writers.LOAD_ID}=([^/]*)", 1).alias("l"))
    return [unquote(r["l"]) for r in spec.distinct().collect()]


def covers(spark: SparkSession, table: str, column: str) -> bool:
    """Whether every load that ``table`` holds has its keys in the key table."""
    name = name_of(table, column)
    if not spark.catalog.tableExists(name) or not writers.partitioning(spark.table(table).columns):
        return False
    return set(_loads(spark, table)) <= set(_loads(spark, name))


def _held(spark: SparkSession, table: str, column: str) -> DataFrame:
    """Keys of the loads that ``table`` holds."""
    return spark.table(name_of(table, column)).where(F.col(writers.LOAD_ID).isin(_loads(spark, table)))


def violations(spark: SparkSession, table: str, column: str) -> DataFrame:
    """(value, n_records) of the keys that stand more than once."""
    return _repeated(_held(spark, table, column))


def violations_of_load(spark: SparkSession, table: str, column: str, load_id: str) -> DataFrame:
    """(value, n_records) of the keys of one load that stand more than once,
    there or together with other loads. Only buckets meet, no key is moved
    (a small load's keys may be sent to all tasks, as the planner decides)."""
    held = _held(spark, table, column)
    mine = spark.table(name_of(table, column)).where(F.col(writers.LOAD_ID) == load_id).select(KEY)
    return _repeated(held.join(mine, KEY, "left_semi"))


def _repeated(keys: DataFrame) -> DataFrame:
    total = keys.groupBy(F.col(KEY).alias("value")).agg(F.sum(N).alias("n_records"))
    return total.where(F.col("n_records") > 1)


def unique(spark: SparkSession, table: str, column: str, label: str | None = None) -> DataFrame:
    """``quality.unique`` of ``table.column`` from its key table."""
    return quality.unique_summary(violations(spark, table, column), label or table, column)
