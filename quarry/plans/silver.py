"""Silver tables (M4-M7): cleaned, renamed, typed, with audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import RunContext
from quarry.functions import (
    audit_loaded_at,
    calendar_month,
    calendar_year,
    iso_week,
    last_token,
    text_to_date,
    upper_text,
)
from quarry.operators.filters import normalized_equals, required_fields
from quarry.operators.joins import lookup_join


def _q(name: str):
    return F.col(f"`{name}`")


def audit_columns(ctx: RunContext) -> list:
    """Build time and run id of this run."""
    return [
        audit_loaded_at(ctx.loaded_at).alias("dbt_loaded_at"),
        F.lit(ctx.run_id).cast("string").alias("dbt_batch_id"),
    ]


def silver_rig_counts(bronze_rigs: DataFrame, ctx: RunContext) -> DataFrame:
    """US rows only; upper-cased text, publish date as a date, ISO week.

    ``year`` and ``month`` come from the source columns, not from the
    date, so a week at the turn of the year keeps its calendar year.
    The state column is not upper-cased.
    """
    day = text_to_date(_q("US_PublishDate"))
    return normalized_equals(bronze_rigs, "Country", "UNITED STATES").select(
        upper_text(_q("Country")).alias("country"),
        upper_text(_q("County")).alias("county"),
        upper_text(_q("Basin")).alias("basin"),
        _q("DrillFor").alias("drill_for"),
        _q("State/Province").alias("state_or_province"),
        upper_text(_q("Location")).alias("location"),
        _q("Trajectory").alias("trajectory"),
        day.alias("date"),
        _q("Year").alias("year"),
        _q("Month").alias("month"),
        iso_week(day).alias("event_week_num"),
        _q("Rig Count Value").alias("rig_count"),
        *audit_columns(ctx),
    )


def silver_counties(bronze_counties: DataFrame, state_codes: DataFrame, ctx: RunContext) -> DataFrame:
    """Counties with their full state name.

    The join compares the raw state code (case-sensitive); only the
    output is upper-cased. Codes missing from the lookup drop the row.
    The lookup is broadcast if it is small (its size is checked).
    """
    br = bronze_counties.alias("br")
    sc = state_codes.alias("sc")
    joined = lookup_join(br, sc, F.col("br.STATE") == F.col("sc.state_abbrev"), "inner")
    return joined.select(
        upper_text(F.col("br.NAME")).alias("county"),
        upper_text(F.col("br.STATE")).alias("state_code"),
        F.col("br.STATE_FIPS_CD").alias("state_fips_cd"),
        F.col("br.LONGITUDE").alias("longitude"),
        F.col("br.LATITUDE").alias("latitude"),
        F.col("sc.state_full").alias("state_name"),
        *audit_columns(ctx),
    )


def silver_earthquake(raw_quakes: DataFrame, ctx: RunContext) -> DataFrame:
    """Events with id, time and magnitude; region / county / state upper-cased."""
    kept = required_fields(raw_quakes, ["id", "time", "magnitude"])
    t = _q("time")
    return kept.select(
        _q("id").alias("id"),
        _q("longitude").alias("longitude"),
        _q("latitude").alias("latitude"),
        _q("elevation").alias("elevation"),
        _q("magnitude").alias("magnitude"),
        _q("magType").alias("magnitude_type"),
        _q("sig").alias("significance"),
        _q("place").alias("place"),
        upper_text(_q("region")).alias("country"),
        upper_text(_q("county")).alias("county"),
        upper_text(_q("state")).alias("state"),
        t.alias("event_time"),
        calendar_year(t).alias("event_year"),
        calendar_month(t).alias("event_month"),
        iso_week(t).alias("event_week_num"),
        *audit_columns(ctx),
    )


def silver_earthquake_with_location(bronze_quakes: DataFrame, ctx: RunContext) -> DataFrame:
    """Events with id, time and a real magnitude (NaN counts as missing);
    the state code is the last comma token of the place text."""
    kept = required_fields(bronze_quakes, ["id", "time", "magnitude"], nan_is_missing=True)
    t = _q("time")
    return kept.select(
        _q("id").alias("id"),
        _q("longitude").alias("longitude"),
        _q("latitude").alias("latitude"),
        _q("elevation").alias("elevation"),
        _q("magnitude").alias("magnitude"),
        _q("magType").alias("magnitude_type"),
        _q("sig").alias("significance"),
        _q("place").alias("place"),
        last_token(_q("place")).alias("state_code"),
        t.alias("event_time"),
        calendar_year(t).alias("event_year"),
        calendar_month(t).alias("event_month"),
        iso_week(t).alias("event_week_num"),
        *audit_columns(ctx),
    )
