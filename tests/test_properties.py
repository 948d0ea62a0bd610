"""Property tests (hypothesis): ranks against their definition, and the
lenient split keeping every row."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quarry.operators import validate
from quarry.operators.ranking import add_rank

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60)


@SETTINGS
@given(vals=values, rows_per_task=st.sampled_from([1_000_000, 7]))
def test_rank_is_one_plus_strictly_larger(spark, vals, rows_per_task):
    rows = [(f"k{i:03d}", None if v is None else float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r.k: (r.r, r.p) for r in add_rank(df, "v", ["k"], rank_col="r", position_col="p",
                                             rows_per_task=rows_per_task).collect()}
    for k, v in rows:
        larger = sum(1 for _, w in rows if w is None) if v is not None else 0
        larger += 0 if v is None else sum(1 for _, w in rows if w is not None and w > v)
        assert out[k][0] == 1 + larger
    ordered = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    assert [out[k][1] for k, _ in ordered] == list(range(1, len(rows) + 1))


texts = st.lists(st.one_of(st.none(), st.sampled_from(["1", "-7", "x", "", "2024-01-05", "2023-02-30", "a" * 501])),
                 min_size=3, max_size=3)


@SETTINGS
@given(rows=st.lists(texts, min_size=0, max_size=40))
def test_split_keeps_every_row(spark, rows):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType()),
                           T.StructField("s", T.StringType())])
    raw = spark.createDataFrame(rows, "n string, d string, s string")
    good, bad = validate.split_good_bad(raw, schema)
    g, b = good.count(), bad.count()
    assert g + b == len(rows)
    expected_bad = sum(
        1 for n, d, s in rows
        if (n is not None and n not in ("1", "-7"))
        or (d is not None and d != "2024-01-05")
        or (s is not None and len(s) > 500)
    )
    assert b == expected_bad
