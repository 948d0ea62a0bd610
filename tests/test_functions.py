import datetime as dt

from pyspark.sql import types as T

from quarry import functions as QF


def test_iso_week_and_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2021, 1, 1),), (dt.date(2023, 1, 1),)], "d date")
    rows = df.select(QF.calendar_year("d").alias("y"), QF.iso_week("d").alias("w")).collect()
    assert [(r.y, r.w) for r in rows] == [(2024, 1), (2021, 53), (2023, 52)]


def test_text_to_date_is_lenient(spark):
    texts = ["2024-02-29", "2023-02-29", "n/a", None, "2024-01-05 00:00:00", "1/5/2024", "01/05/2024"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.d for r in df.select(QF.text_to_date("s").alias("d")).collect()]
    assert got == [dt.date(2024, 2, 29), None, None, None, dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 5)]


def test_last_token(spark):
    texts = ["5 km N of X, CA ", "a,", "plain", None, "x,\tTX\t"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r.t for r in df.select(QF.last_token("s").alias("t")).collect()] == ["CA", "", "plain", None, "TX"]


def test_epoch_millis_zero_and_missing_are_null(spark):
    df = spark.createDataFrame([(0,), (None,), (1704067200123,)], "ms bigint")
    got = [r.t for r in df.select(QF.epoch_millis_to_ntz("ms").alias("t")).collect()]
    assert got == [None, None, dt.datetime(2024, 1, 1, 0, 0, 0, 123000)]


def test_epoch_millis_ignores_session_zone(spark):
    df = spark.createDataFrame([(1704067200000,)], "ms bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        got = df.select(QF.epoch_millis_to_ntz("ms").alias("t")).collect()[0].t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 1, 1)


def test_safe_index_short_arrays(spark):
    schema = T.StructType([T.StructField("c", T.ArrayType(T.DoubleType()))])
    df = spark.createDataFrame([([],), ([1.0],), ([1.0, 2.0],), ([1.0, 2.0, 3.0],), (None,)], schema)
    got = [tuple(r) for r in df.select(*[QF.safe_index("c", i).alias(f"i{i}") for i in range(3)]).collect()]
    assert got == [(None, None, None), (1.0, None, None), (1.0, 2.0, None), (1.0, 2.0, 3.0), (None, None, None)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("",), ("NULL",), ("null",), ("Null",), ("x",), (None,)], "s string")
    quake = [r.v for r in df.select(QF.null_tokens("s", ["NULL", "null", ""]).alias("v")).collect()]
    rig = [r.v for r in df.select(QF.null_tokens("s", []).alias("v")).collect()]
    assert quake == [None, None, None, "Null", "x", None]
    assert rig == ["", "NULL", "null", "Null", "x", None]


def test_null_default_and_upper(spark):
    df = spark.createDataFrame([(None, "tx"), (2.5, None)], "m double, s string")
    got = [tuple(r) for r in df.select(QF.null_default("m", 0.0), QF.upper_text("s")).collect()]
    assert got == [(0.0, "TX"), (2.5, None)]


def test_present_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "m double")
    assert df.where(QF.present("m", numeric=True)).count() == 1
    assert df.where(QF.present("m")).count() == 2
