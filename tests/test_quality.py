import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import quality

AS_OF = dt.datetime(2024, 1, 3, 0, 0, 0)


def _fresh(spark, ts):
    df = spark.createDataFrame([(t,) for t in ts], "loaded timestamp_ntz")
    return quality.freshness(df, "t", "loaded", AS_OF).collect()[0].status


def test_freshness_levels(spark):
    assert _fresh(spark, [AS_OF - dt.timedelta(hours=24)]) == "pass"
    assert _fresh(spark, [AS_OF - dt.timedelta(hours=24, seconds=1)]) == "warn"
    assert _fresh(spark, [AS_OF - dt.timedelta(hours=48)]) == "warn"
    assert _fresh(spark, [AS_OF - dt.timedelta(hours=48, seconds=1)]) == "error"
    assert _fresh(spark, []) == "error"


def test_not_null_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a bigint, b string")
    got = {r.column_name: (r.failures, r.status) for r in quality.not_null(df, "t", ["a", "b"]).collect()}
    assert got == {"a": (1, "fail"), "b": (2, "fail")}


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    assert quality.unique(df, "t", "id").collect()[0].failures == 1
    assert [r.value for r in quality.unique_violations(df, "id").collect()] == ["a"]
    ok = spark.createDataFrame([("a",), (None,), (None,)], "id string")
    assert quality.unique(ok, "t", "id").collect()[0].status == "pass"


def test_freshness_by_source(spark):
    df = spark.createDataFrame([("x", AS_OF - dt.timedelta(hours=1)), ("y", AS_OF - dt.timedelta(days=3))],
                               "src string, loaded timestamp_ntz")
    got = {r.table_name: r.status for r in quality.freshness_by(df, F.col("src"), "loaded", AS_OF).collect()}
    assert got == {"x": "pass", "y": "error"}


def test_unique_many_matches_single_checks(spark):
    df = spark.createDataFrame(
        [("a", 1, "p"), ("a", 2, "p"), ("b", 2, None), (None, None, None), (None, 3, "q"), ("c", 3, "q")],
        "x string, y bigint, z string")
    many = {r.column_name: (r.failures, r.status) for r in quality.unique_many(df, "t", ["x", "y", "z"]).collect()}
    single = {c: (r.failures, r.status) for c in ["x", "y", "z"] for r in quality.unique(df, "t", c).collect()}
    assert many == single == {"x": (1, "fail"), "y": (2, "fail"), "z": (2, "fail")}
