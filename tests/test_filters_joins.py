import datetime as dt

from pyspark.sql import functions as F

from quarry.config import RunContext
from quarry.operators import filters, joins
from quarry.plans import gold, silver
from quarry.sources import seed


def test_required_fields_drop_null_and_nan(spark):
    rows = [("a", dt.datetime(2024, 1, 1), 1.0), (None, dt.datetime(2024, 1, 1), 1.0),
            ("b", None, 1.0), ("c", dt.datetime(2024, 1, 1), None), ("d", dt.datetime(2024, 1, 1), float("nan"))]
    df = spark.createDataFrame(rows, "id string, time timestamp_ntz, magnitude double")
    sql_rule = filters.required_fields(df, ["id", "time", "magnitude"])
    pandas_rule = filters.required_fields(df, ["id", "time", "magnitude"], nan_is_missing=True)
    assert sorted(r.id for r in sql_rule.collect()) == ["a", "d"]
    assert [r.id for r in pandas_rule.collect()] == ["a"]


def test_normalized_equality(spark):
    df = spark.createDataFrame([("United States",), ("CANADA",), ("",), (None,)], "Country string")
    assert [r.Country for r in filters.normalized_equals(df, "Country", "UNITED STATES").collect()] == ["United States"]


def test_time_window_end_is_midnight(spark):
    rows = [(dt.datetime(2024, 1, 20, 0, 0),), (dt.datetime(2024, 1, 20, 0, 0, 1),), (dt.datetime(2023, 10, 22),),
            (dt.datetime(2023, 10, 21, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    kept = filters.last_days(df, "t", dt.date(2024, 1, 20), 90).collect()
    assert sorted(r.t for r in kept) == [dt.datetime(2023, 10, 22), dt.datetime(2024, 1, 20)]


def test_bbox_borders_included(spark):
    df = spark.createDataFrame([(24.6, -125.0), (49.0, -65.0), (24.59, -100.0), (30.0, -64.9)], "lat double, lon double")
    assert filters.bbox(df, "lat", "lon", **filters.US_BBOX).count() == 2


def test_lookup_join_is_case_sensitive(spark):
    counties = spark.createDataFrame([("A", "TX", 1, 1.0, 2.0), ("B", "tx", 1, 1.0, 2.0), ("C", "PR", 1, 1.0, 2.0)],
                                     "NAME string, STATE string, STATE_FIPS_CD bigint, LONGITUDE double, LATITUDE double")
    out = silver.silver_counties(counties, seed.state_codes(spark), RunContext(run_id="r", loaded_at=dt.datetime(2024, 1, 1)))
    rows = out.collect()
    assert [(r.county, r.state_code, r.state_name) for r in rows] == [("A", "TX", "TEXAS")]


def test_seed_has_51_rows(spark):
    assert seed.state_codes(spark).count() == 51
    assert len({a for a, _ in seed.STATE_CODES}) == 51


def test_bounded_broadcast_hint(spark):
    small = spark.range(10)
    plan = spark.range(1000).join(joins.bounded_broadcast(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    big = spark.range(100)
    plan2 = spark.range(1000).join(joins.bounded_broadcast(big, max_rows=10), "id")
    assert "ResolvedHint" not in plan2._jdf.queryExecution().analyzed().toString()


def _silver_rigs(spark, rows):
    df = spark.createDataFrame(rows, "state_or_province string, county string, year bigint, date date, rig_count bigint")
    return df.select("*", F.weekofyear("date").alias("event_week_num"))


def _silver_quakes(spark, rows):
    df = spark.createDataFrame(rows, "state string, county string, event_time timestamp_ntz, magnitude double, significance bigint")
    return df.select("*", F.year("event_time").alias("event_year"), F.weekofyear("event_time").alias("event_week_num"))


def test_weekly_join_drops_one_sided_weeks_and_mixed_case(spark):
    rigs = _silver_rigs(spark, [
        ("TEXAS", "X", 2024, dt.date(2024, 1, 3), 5),
        ("TEXAS", "X", 2024, dt.date(2024, 1, 10), 7),      # week with no events
        ("Texas", "X", 2024, dt.date(2024, 1, 3), 9),       # mixed case: no match
    ])
    quakes = _silver_quakes(spark, [
        ("TEXAS", "Y", dt.datetime(2024, 1, 2, 5), 2.0, 10),
        ("TEXAS", "Y", dt.datetime(2024, 2, 2, 5), 3.0, 10),  # week with no rigs
    ])
    out = gold.gold_agg_rig_earthquake(rigs, quakes).collect()
    assert [(r.state, r.total_rigs_count, r.total_earthquake_count, r.rig_rank, r.rig_position) for r in out] == [
        ("TEXAS", 5, 1, 1, 1)
    ]


def test_mean_of_weekly_means_is_unweighted(spark):
    rigs = _silver_rigs(spark, [("S", "X", 2024, dt.date(2024, 1, 3), 1), ("S", "X", 2024, dt.date(2024, 1, 10), 1)])
    week1 = [("S", "Y", dt.datetime(2024, 1, 2), 1.0, 0)]
    week2 = [("S", "Y", dt.datetime(2024, 1, 9, h), 3.0, 0) for h in range(9)]
    out = gold.gold_agg_rig_earthquake(rigs, _silver_quakes(spark, week1 + week2)).collect()
    assert out[0].avg_earthquake_magnitude == 2.0  # (1 + 3) / 2, not (1 + 27) / 10
    assert out[0].total_earthquake_count == 10


def test_state_rig_count_groups(spark):
    rigs = _silver_rigs(spark, [
        ("", "A", 2024, dt.date(2024, 1, 3), 5),
        (None, "A", 2024, dt.date(2024, 1, 3), 50),
        ("T", "A", 2024, dt.date(2024, 1, 3), 5),
        ("T", "A", 2024, dt.date(2024, 1, 3), 1),
    ])
    out = {r.state: r for r in gold.state_rig_count(rigs).collect()}
    assert set(out) == {"", "T"}
    assert out["T"].active_days == 1 and out["T"].total_rigs == 6 and out["T"].peak_rigs == 5
    assert out[""].total_rig_rank == 2 and out["T"].total_rig_rank == 1
    assert out[""].peak_rig_rank == 1 and out["T"].peak_rig_rank == 1


def test_earthquake_ranking_active_days_counts_instants(spark):
    t = dt.datetime(2024, 1, 2, 5)
    quakes = _silver_quakes(spark, [
        ("S", "C", t, 4.5, 1), ("S", "C", t, 1.0, 1), ("S", "C", t + dt.timedelta(hours=1), 2.0, 1),
        ("S", None, t, 9.0, 1),
    ])
    out = gold.earthquake_ranking(quakes).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.total_earthquakes, r.active_days, r.significant_quakes, r.max_magnitude) == (3, 2, 1, 4.5)


def test_oversized_lookup_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    monkeypatch.setattr(joins.bounded_broadcast, "__defaults__", (joins.BROADCAST_MAX_BYTES, 10))
    counties = spark.createDataFrame([("A", "TX", 1, 1.0, 2.0)], "NAME string, STATE string, STATE_FIPS_CD bigint, LONGITUDE double, LATITUDE double")
    out = silver.silver_counties(counties, seed.state_codes(spark), RunContext(run_id="r", loaded_at=dt.datetime(2024, 1, 1)))
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString() and out.count() == 1
