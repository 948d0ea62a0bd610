"""Plan regression tests: the scale properties the marts rely on."""

from pyspark.sql import functions as F

from quarry.operators import nearest as N
from quarry.plans import gold
from quarry.queries import QUERIES, silver_quakes, silver_rigs
from quarry.sources import adapters as A

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_weekly_join_shuffles_only_the_two_aggregates(spark):
    p = _plan(gold.weekly_activity(silver_rigs(spark, SF), silver_quakes(spark, SF)))
    assert p.count("Exchange hashpartitioning") == 2      # one per weekly aggregate, reused by the join
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_fact_scan_is_pruned_and_never_broadcast(spark):
    p = _plan(A.raw_rigs(spark, SF))
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "lineitem" in ln][0]
    assert "l_tax" not in scan and "l_discount" not in scan          # only the columns used are read
    # the lineitem scan sits on the streamed side: no BroadcastExchange
    # subtree (deeper-indented lines below it) contains it
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            for below in lines[i + 1:]:
                if len(below) - len(below.lstrip(" :|+-")) <= depth:
                    break
                assert "lineitem" not in below
    assert p.count("BroadcastHashJoin") == 3


def test_nearest_search_does_not_move_events(spark):
    ev = A.raw_quakes(spark, SF).select("id", "latitude", "longitude")
    pl = A.raw_counties(spark, SF).select(F.col("OBJECTID").alias("place_id"), F.col("LATITUDE").alias("latitude"), F.col("LONGITUDE").alias("longitude"))
    p = _plan(N.attach_nearest(ev, pl))
    assert "ArrowEvalPython" in p and "BroadcastHashJoin" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "SortMergeJoin" not in p
    orders = [i for i, ln in enumerate(p.splitlines()) if "orders.parquet" in ln]
    assert orders and not any("Exchange hashpartitioning" in ln and "o_orderkey" in ln for ln in p.splitlines())


def test_marts_are_built_without_a_job(spark):
    """Lookups are sized by statistics, ranks are lazy: once the table schemas
    are known, building a mart starts no job."""
    names = ["silver_rig_counts", "silver_earthquake_with_location", "state_rig_count", "gold_agg_rig_earthquake", "lookup_join"]
    for name in names:
        QUERIES[name](spark, SF)
    spark.sparkContext.setJobGroup("built", "building")
    try:
        for name in names:
            QUERIES[name](spark, SF)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("built")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
