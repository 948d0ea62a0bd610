"""The unique check of appended loads by a bucketed key table."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import quality
from quarry.sinks import key_table, writers

ROW = T.StructType([T.StructField("id", T.StringType()), T.StructField("key", T.LongType())])


@pytest.fixture()
def table(spark):
    db = f"k{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    name = f"{db}.events"
    writers.ensure_table(spark, name, ROW, by_load=True)
    key_table.ensure(spark, name, "id", buckets=4)
    return name


def load(spark, table, ids, load_id):
    rows = spark.createDataFrame([(i, 1) for i in ids], ROW)
    key_table.add(rows, table, "id", load_id)
    writers.add_rows(rows, table, load_id)


def pairs(df):
    return sorted((r["value"], r["n_records"]) for r in df.collect())


def check(spark, table):
    want = quality.unique_violations(spark.table(table), "id")
    assert key_table.covers(spark, table, "id")
    assert pairs(key_table.violations(spark, table, "id")) == pairs(want)
    assert key_table.unique(spark, table, "id").collect() == quality.unique(spark.table(table), table, "id").collect()


def test_equal_to_a_grouping_of_the_table(spark, table):
    check(spark, table)
    load(spark, table, ["a", "b", None, None, ""], "run's 1=x%2/y")
    check(spark, table)
    load(spark, table, ["c", "c", "b", "", *[f"n{i}" for i in range(500)]], "two")
    check(spark, table)
    load(spark, table, [f"n{i}" for i in range(0, 500, 3)], "three")
    check(spark, table)
    assert pairs(key_table.violations_of_load(spark, table, "id", "run's 1=x%2/y")) == [("", 2), ("b", 2)]
    assert len(pairs(key_table.violations_of_load(spark, table, "id", "three"))) == 167
    load(spark, table, ["z"], "two")  # a replay with other rows
    check(spark, table)
    assert pairs(key_table.violations_of_load(spark, table, "id", "two")) == []


def test_keys_of_lost_loads_do_not_count(spark, table):
    load(spark, table, ["a", "b"], "one")
    key_table.add(spark.createDataFrame([("a", 1)], ROW), table, "id", "lost")
    check(spark, table)
    writers.add_rows(spark.createDataFrame([("q", 1)], ROW), table, "without keys")
    assert not key_table.covers(spark, table, "id")


def test_no_key_is_moved(spark, table):
    for k in range(3):
        load(spark, table, [f"{k}-{i}" for i in range(50)] + ["same"], f"l{k}")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", kept):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            for df in (key_table.violations(spark, table, "id"), key_table.violations_of_load(spark, table, "id", "l1")):
                assert pairs(df) == [("same", 3)]
                assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_hot_key_is_summed_before_it_is_sent(spark, table):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit(1).cast("long").alias("key"))
    key_table.add(rows, table, "id", "one")
    writers.add_rows(rows, table, "one")
    check(spark, table)
    assert pairs(key_table.violations(spark, table, "id")) == [("hot", 6667)]
