"""Gold marts.

Each mart aggregates first and joins / ranks the (small) aggregates
afterwards; a join before aggregation would multiply rows. Weekly
aggregates are their own functions so every weekly measure stays
available even where a mart reads only some of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import Thresholds
from quarry.functions import null_default, to_day
from quarry.operators.aggregates import count_rows, count_when, exact_distinct, sum_when
from quarry.operators.ranking import add_rank, add_ranks

WEEK_KEYS = ["state", "year", "event_week_num"]


def rig_weekly(silver_rigs: DataFrame) -> DataFrame:
    """Per (state, year, ISO week): sum, distinct days, mean and peak rigs."""
    return (
        silver_rigs.where(F.col("state_or_province").isNotNull())
        .groupBy(
            F.col("state_or_province").alias("state"),
            F.col("year").alias("year"),
            F.col("event_week_num").alias("event_week_num"),
        )
        .agg(
            F.sum("rig_count").alias("total_rigs"),
            exact_distinct("date").alias("active_days"),
            F.avg("rig_count").alias("avg_daily_rigs"),
            F.max("rig_count").alias("peak_rigs"),
        )
    )


def quake_weekly(silver_quakes: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Per (state, year, ISO week): events, distinct days, magnitudes."""
    m = F.col("magnitude")
    return (
        silver_quakes.where(F.col("state").isNotNull())
        .groupBy(
            F.col("state").alias("state"),
            # bigint like the rig side's year, so the join reuses this
            # aggregate's partitioning instead of shuffling it again
            F.col("event_year").cast("bigint").alias("year"),
            F.col("event_week_num").alias("event_week_num"),
        )
        .agg(
            count_rows().alias("total_earthquakes"),
            exact_distinct(to_day("event_time")).alias("active_days"),
            F.avg(m).alias("avg_magnitude"),
            F.max(m).alias("max_magnitude"),
            count_when(m >= F.lit(thresholds.weekly_significant)).alias("significant_events"),
            F.avg("significance").alias("avg_significance"),
        )
    )


def weekly_activity(silver_rigs: DataFrame, silver_quakes: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Weeks present on both sides: rigs and quakes of the same state and week.

    The state match is case-sensitive. Both inputs are aggregates keyed
    by (state, year, week), so the join moves only aggregated rows; AQE
    turns it into a broadcast join when one side is small at run time.
    """
    r = rig_weekly(silver_rigs)
    e = quake_weekly(silver_quakes, thresholds)
    return r.join(e.select(*WEEK_KEYS, "total_earthquakes", "avg_magnitude"), WEEK_KEYS, "inner").select(
        *WEEK_KEYS,
        null_default("total_rigs", 0).alias("total_rigs"),
        null_default("total_earthquakes", 0).alias("total_earthquakes"),
        null_default("avg_magnitude", 0.0).alias("avg_magnitude"),
    )


def gold_agg_rig_earthquake(
    silver_rigs: DataFrame,
    silver_quakes: DataFrame,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Per state over shared weeks: rig total, event total, mean of weekly
    mean magnitudes (unweighted), RANK and ROW_NUMBER by rig total.

    Ties in the position go to the smaller state name.
    """
    combined = weekly_activity(silver_rigs, silver_quakes, thresholds)
    per_state = combined.groupBy("state").agg(
        F.sum("total_rigs").cast("bigint").alias("total_rigs_count"),
        F.sum("total_earthquakes").cast("bigint").alias("total_earthquake_count"),
        F.avg("avg_magnitude").alias("avg_earthquake_magnitude"),
    )
    ranked = add_rank(per_state, "total_rigs_count", ["state"], rank_col="rig_rank", position_col="rig_position")
    return ranked.select(
        "state",
        "total_rigs_count",
        "total_earthquake_count",
        "avg_earthquake_magnitude",
        "rig_rank",
        "rig_position",
    ).orderBy(F.desc_nulls_first("total_rigs_count"), "state")


def state_rig_count(silver_rigs: DataFrame) -> DataFrame:
    """Per (state, county): totals, distinct days, mean and peak rigs and
    three ranks (by peak, total, mean; all descending)."""
    per_county = (
        silver_rigs.where(F.col("state_or_province").isNotNull())
        .groupBy(F.col("state_or_province").alias("state"), F.col("county").alias("county"))
        .agg(
            F.sum("rig_count").alias("total_rigs"),
            exact_distinct("date").alias("active_days"),
            F.avg("rig_count").alias("avg_daily_rigs"),
            F.max("rig_count").alias("peak_rigs"),
        )
    )
    ranked = add_ranks(
        per_county,
        {"peak_rig_rank": "peak_rigs", "total_rig_rank": "total_rigs", "avg_rig_rank": "avg_daily_rigs"},
        keys=["state", "county"],
        large=None,
    )
    return ranked.select(
        "state", "county", "total_rigs", "active_days", "avg_daily_rigs", "peak_rigs",
        "peak_rig_rank", "total_rig_rank", "avg_rig_rank",
    ).orderBy("peak_rig_rank", "total_rig_rank", "state", "county")


def earthquake_ranking(
    silver_quakes: DataFrame,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Per (state, county): event count, distinct event instants (named
    ``active_days``), mean / max magnitude, significant events, three
    ranks (by count, max magnitude, significant events)."""
    m = F.col("magnitude")
    per_county = (
        silver_quakes.where(F.col("state").isNotNull() & F.col("county").isNotNull())
        .groupBy("state", "county")
        .agg(
            count_rows().alias("total_earthquakes"),
            exact_distinct("event_time").alias("active_days"),
            F.avg(m).alias("avg_magnitude"),
            F.max(m).alias("max_magnitude"),
            sum_when(m >= F.lit(thresholds.ranking_significant)).cast("bigint").alias("significant_quakes"),
        )
    )
    ranked = add_ranks(
        per_county,
        {
            "rank_by_frequency": "total_earthquakes",
            "rank_by_max_magnitude": "max_magnitude",
            "rank_by_significant_quakes": "significant_quakes",
        },
        keys=["state", "county"],
        large=None,
    )
    return ranked.select(
        "state", "county", "total_earthquakes", "active_days",
        "avg_magnitude",
        "max_magnitude", "significant_quakes",
        "rank_by_frequency", "rank_by_max_magnitude", "rank_by_significant_quakes",
    )
