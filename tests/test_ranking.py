import random

from pyspark.sql import functions as F

from quarry.operators import ranking
from quarry.operators.ranking import add_rank, add_ranks


def _expected(rows):
    """rank = 1 + rows with a strictly larger value (NULL first);
    position = order by value desc (NULL first), then key."""
    def sort_key(r):
        k, v = r
        return (0 if v is None else 1, -(v or 0), k)
    ordered = sorted(rows, key=sort_key)
    pos = {k: i + 1 for i, (k, _) in enumerate(ordered)}
    def larger(v):
        if v is None:
            return 0
        return sum(1 for _, w in rows if w is None or w > v)
    return {k: (1 + larger(v), pos[k]) for k, v in rows}


def _check(spark, rows, **how):
    df = spark.createDataFrame(rows, "k string, v double")
    out = add_rank(df, "v", ["k"], rank_col="r", position_col="p", **how)
    got = {r.k: (r.r, r.p) for r in out.collect()}
    assert got == _expected(rows)
    assert dict(out.dtypes)["r"] == "bigint" and dict(out.dtypes)["p"] == "bigint"


def test_ties_give_gaps_and_positions_by_key(spark):
    rows = [("b", 10.0), ("a", 10.0), ("c", 5.0), ("d", None), ("e", 1.0)]
    _check(spark, rows)
    _check(spark, rows, large=True)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.r, r.p) for r in add_rank(df, "v", ["k"], rank_col="r", position_col="p").collect()}
    assert got == {"d": (1, 1), "a": (2, 2), "b": (2, 3), "c": (4, 4), "e": (5, 5)}


def test_large_path_matches_window_with_hot_value(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            v = 42.0            # a third of all rows share one value
        elif i % 50 == 1:
            v = None
        else:
            v = float(rng.randint(0, 400))
        rows.append((f"k{i:05d}", v))
    _check(spark, rows, large=True, rows_per_task=250)   # 12 ranges
    _check(spark, rows)


def test_add_ranks_several_columns(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("b", 3, 2.0), ("c", 1, 2.0)], "k string, x bigint, y double")
    got = {r.k: (r.rx, r.ry) for r in add_ranks(df, {"rx": "x", "ry": "y"}, keys=["k"]).collect()}
    assert got == {"a": (1, 3), "b": (1, 1), "c": (3, 1)}
    got2 = {r.k: (r.rx, r.ry) for r in add_ranks(df, {"rx": "x", "ry": "y"}, keys=["k"], large=True, rows_per_task=1).collect()}
    assert got2 == got


def test_building_a_mart_starts_no_job_of_its_own(spark):
    from quarry.plans import gold
    from quarry.queries import silver_quakes, silver_rigs

    sf = "/root/testdata/sf0.001"
    rigs, quakes = silver_rigs(spark, sf), silver_quakes(spark, sf)  # their dimension size checks run here
    sc = spark.sparkContext
    sc.setJobGroup("build", "building marts")
    try:
        gold.gold_agg_rig_earthquake(rigs, quakes)
        gold.state_rig_count(rigs)
        gold.earthquake_ranking(quakes)
        assert not sc.statusTracker().getJobIdsForGroup("build")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_ranks_together_equal_the_windows(spark):
    """Ties, NULLs, NaN, a hot value and metrics of different types."""
    nan = float("nan")
    rows = [(i, None if i % 11 == 0 else i % 7, nan if i % 13 == 0 else (None if i % 5 == 0 else (i * i) % 17 / 4), "hot" if i % 3 else f"s{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, a bigint, b double, c string")
    ranks = {"ra": "a", "rb": "b", "rc": "c"}
    for how in ({}, {"descending": False, "nulls_first": False}):
        want = sorted((r.k, r.ra, r.rb, r.rc) for r in add_ranks(df, ranks, keys=["k"], **how).collect())
        got = add_ranks(df, ranks, keys=["k"], large=True, rows_per_task=20, **how)
        assert got.columns == [*df.columns, *ranks] and "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.k, r.ra, r.rb, r.rc) for r in got.collect()) == want


def test_group_count_decides(spark, monkeypatch):
    df = spark.range(50).select("id", (F.col("id") % 7).alias("x"))
    assert ranking.checked_groups(df, rows_per_task=10) == (df, False)  # little is read: no count
    monkeypatch.setattr(ranking, "WINDOW_BYTES", 0)
    assert ranking.checked_groups(df, rows_per_task=10)[1] and not ranking.checked_groups(df, rows_per_task=50)[1]
    got = add_ranks(df, {"r": "x"}, keys=["id"], large=None, rows_per_task=10)
    assert sorted(map(str, got.collect())) == sorted(map(str, add_ranks(df, {"r": "x"}, keys=["id"]).collect()))
