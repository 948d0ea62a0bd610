import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.operators import validate
from quarry.sinks import writers
from quarry.sources import delimited, geojson, sheet

HEADER = ",".join(f'"{c}"' for c in S.RIG_SHEET_COLUMNS)


def _sheet(path, rows, preamble=10):
    with open(path, "w") as f:
        for i in range(preamble):
            f.write(f"note line {i}, with a comma\n")
        f.write(HEADER + "\n")
        for r in rows:
            f.write(r + "\n")


def _row(i, count="3", country="United States"):
    return f'"{country}","County {i}","Basin","N","Oil","Land","Texas","Horizontal","2024","1","2024-01-05","{count}"'


def test_sheet_drops_preamble_per_file_across_splits(spark, tmp):
    d = os.path.join(tmp, "sheets")
    os.makedirs(d)
    _sheet(os.path.join(d, "a.csv"), [_row(i) for i in range(1000)])
    _sheet(os.path.join(d, "b.csv"), [_row(i) for i in range(1000, 2000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = sheet.read_rig_sheet(spark, d)
        assert df.rdd.getNumPartitions() > 2
        rows = df.select("County").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 2000
    assert sorted(r.County for r in rows) == sorted(f"County {i}" for i in range(2000))
    assert df.columns[:12] == S.RIG_SHEET_COLUMNS


def test_rig_sheet_lenient_typing(spark, tmp):
    p = os.path.join(tmp, "s.csv")
    long_text = "x" * 501
    rows = [
        _row(1),
        _row(2, count="three"),                       # text in the count column
        _row(3) + ',"extra"',                         # 13 fields
        ",".join(_row(4).split(",")[:11]),            # 11 fields
        _row(5).replace('"County 5"', f'"{long_text}"'),  # 501 characters
        _row(6, count=""),                            # empty count: stays '' -> bad value
        _row(7),
    ]
    _sheet(p, rows)
    raw = sheet.read_rig_sheet(spark, p).drop("file_path")
    good, bad = validate.split_good_bad(raw, S.RIG_SHEET, corrupt_col="_corrupt_record")
    assert sorted(r["County"] for r in good.collect()) == ["County 1", "County 7"]
    reasons = sorted(r[validate.REASON] for r in bad.collect())
    assert reasons == ["bad_value:Rig Count Value", "bad_value:Rig Count Value", "malformed", "malformed", "too_long:County"]
    assert good.count() + bad.count() == len(rows)
    assert dict(good.dtypes)["Rig Count Value"] == "bigint"


def test_headered_csv_tokens_and_corrupt_rows(spark, tmp):
    p = os.path.join(tmp, "c.csv")
    with open(p, "w") as f:
        f.write("a,b,n\n")
        f.write('"x","",1\n')        # quoted empty
        f.write('"NULL",null,2\n')   # tokens
        f.write('y,,3\n')            # unquoted empty
        f.write('z,w\n')             # too few fields
        f.write('q,r,notanumber\n')  # bad value
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                           T.StructField("n", T.LongType())])
    keep = delimited.read_text_columns(spark, p, schema)
    rows = keep.where(F.col("n").isin("1", "2", "3")).orderBy("n").collect()
    assert [(r.a, r.b) for r in rows] == [("x", ""), ("NULL", "null"), ("y", None)]
    toks = delimited.read_text_columns(spark, p, schema, null_values=["", "NULL", "null"])
    rows = toks.where(F.col("n").isin("1", "2", "3")).orderBy("n").collect()
    assert [(r.a, r.b) for r in rows] == [("x", None), (None, None), ("y", None)]
    good, bad = validate.split_good_bad(keep, schema, corrupt_col=delimited.CORRUPT)
    assert good.count() == 3
    assert sorted(r[validate.REASON] for r in bad.collect()) == ["bad_value:n", "malformed"]


def test_missing_csv_fails(spark, tmp):
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        delimited.read_text_columns(spark, os.path.join(tmp, "absent.csv"), S.COUNTY_FILE).count()


def _geojson(path, features):
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f)


def test_geojson_flatten_edge_cases(spark, tmp):
    p = os.path.join(tmp, "f.geojson")
    _geojson(p, [
        {"id": "a", "properties": {"mag": 2.5, "time": 1704067200000, "place": "x, CA", "sig": 7},
         "geometry": {"coordinates": [-120.0, 35.0, 5.0]}},
        {"id": "b", "properties": {"mag": 1.0, "time": 0}, "geometry": {"coordinates": [-120.0]}},
        {"id": "c", "properties": {"mag": 1.0}, "geometry": {"coordinates": []}},
        {"id": "d", "geometry": {"coordinates": [1.0, 2.0]}},
    ])
    rows = {r.id: r for r in geojson.read_events(spark, p).collect()}
    assert rows["a"].time == dt.datetime(2024, 1, 1) and rows["a"].elevation == 5.0 and rows["a"].sig == 7
    assert rows["b"].time is None and rows["b"].longitude == -120.0 and rows["b"].latitude is None
    assert rows["c"].time is None and rows["c"].longitude is None
    assert rows["d"].magnitude is None and rows["d"].latitude == 2.0 and rows["d"].elevation is None


def test_geojson_empty_collection(spark, tmp):
    p = os.path.join(tmp, "e.geojson")
    _geojson(p, [])
    assert geojson.read_events(spark, p).isEmpty()


def test_geojson_feature_lines(spark, tmp):
    p = os.path.join(tmp, "f.jsonl")
    with open(p, "w") as f:
        for i in range(5):
            f.write(json.dumps({"id": f"e{i}", "properties": {"mag": float(i)}, "geometry": {"coordinates": [0, i]}}) + "\n")
    rows = geojson.read_events(spark, p, sequence=True).orderBy("id").collect()
    assert [(r.id, r.latitude) for r in rows] == [(f"e{i}", float(i)) for i in range(5)]


def test_quoted_csv_round_trip(spark, tmp):
    df = spark.createDataFrame([("a,b", 1, None), ('q"uote', 2, "")], "t string, n bigint, e string")
    out = os.path.join(tmp, "extract")
    writers.write_quoted_csv(df, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert text.splitlines()[0] == '"t","n","e"'
    back = spark.read.schema("t string, n bigint, e string").option("header", True).option("escape", '"').csv(out)
    assert sorted((r.t, r.n) for r in back.collect()) == [("a,b", 1), ('q"uote', 2)]


def test_sheet_many_small_files_in_one_partition(spark, tmp):
    d = os.path.join(tmp, "small")
    os.makedirs(d)
    for f in range(6):
        _sheet(os.path.join(d, f"f{f}.csv"), [_row(100 * f + i) for i in range(3)])
    df = sheet.read_rig_sheet(spark, d)
    rows = sorted(r.County for r in df.collect())
    assert rows == sorted(f"County {100 * f + i}" for f in range(6) for i in range(3))


def _csv(tmp, text):
    path = os.path.join(tmp, "c.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_quoted_line_breaks_stay_whole(spark, tmp):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = delimited.read_text_columns(spark, _csv(tmp, 'a,b\n"1","line one\nline ""two"""\n2,x\n'), schema).collect()
    assert sorted((r.a, r.b, r[delimited.CORRUPT]) for r in rows) == [("1", 'line one\nline "two"', None), ("2", "x", None)]


def test_columns_by_header_name(spark, tmp):
    schema = T.StructType([T.StructField("LATITUDE", T.DoubleType()), T.StructField("LONGITUDE", T.DoubleType())])
    rows = delimited.read_text_columns(spark, _csv(tmp, "LONGITUDE,OTHER,LATITUDE\n-95.0,x,30.0\n"), schema).collect()
    assert [(r.LATITUDE, r.LONGITUDE) for r in rows] == [("30.0", "-95.0")]
    with pytest.raises(ValueError, match="LATITUDE"):
        delimited.read_text_columns(spark, _csv(tmp, "LONGITUDE,LAT\n1,2\n"), schema)


def test_written_extract_reads_back_through_both_readers(spark, tmp):
    names = S.RIG_SHEET_COLUMNS
    row = ['Har "X" ris, co', "back\\", "", "N", "O", "L", "T", "H", "2024", "1", "2024-01-05", "3"]
    out = os.path.join(tmp, "extract")
    writers.write_quoted_csv(spark.createDataFrame([row], ", ".join(f"`{n}` string" for n in names)).coalesce(1), out)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    by_name = delimited.read_text_columns(spark, out, schema).collect()
    assert list(by_name[0])[:12] == row
    lines = sheet.read_sheet_lines(spark, out, skip=1)
    assert list(sheet.parse_positional(lines).collect()[0])[:13] == [*row, None]
