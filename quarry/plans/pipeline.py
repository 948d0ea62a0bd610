"""The whole run (M11): loads, seed, then models in lineage order.

Order: counties first (their centroids are the places events are
located at), then the seed, events, rigs; then bronze views, silver
tables and gold tables. Gold models read the persisted silver tables,
so the silver builds are the materialization barrier between layers.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.config import RunContext
from quarry.operators import filters
from quarry.operators.joins import bounded_broadcast
from quarry.plans import bronze, gold, loads, silver
from quarry.plans.materialize import GOLD_TAGS, SILVER_TAGS, Warehouse
from quarry.sinks.writers import LoadResult
from quarry.sources import seed


COUNTRY = "US"  # of every county centroid


@dataclass
class Inputs:
    rig_sheets: list[str] = field(default_factory=list)
    quake_features: list[str] = field(default_factory=list)
    county_csv: str | None = None
    seed_csv: str | None = None
    quarantine_dir: str | None = None  # a folder that the cluster shares
    as_of: dt.date | None = None  # day of the event extract; the run's day if not given
    quake_period: tuple[dt.date, dt.date] | None = None  # else the look-back days up to as_of
    quake_bbox: dict | None = field(default_factory=lambda: dict(filters.US_BBOX))
    quake_lines: bool = False  # one feature a line instead of collections

    def period(self, ctx: RunContext) -> tuple[dt.date, dt.date]:
        if self.quake_period:
            return self.quake_period
        end = self.as_of or (ctx.loaded_at or dt.datetime.now(dt.timezone.utc)).date()
        return end - dt.timedelta(days=filters.EVENT_LOOKBACK_DAYS), end


def places(wh: Warehouse) -> DataFrame:
    """County centroids with their state's full name (code if unknown)."""
    c = wh.source(loads.COUNTY_TABLE)
    sc = bounded_broadcast(wh.source(loads.SEED_TABLE).dropDuplicates(["state_abbrev"]))
    j = c.join(sc, c["STATE"] == sc["state_abbrev"], "left")
    # The raw table is append-only, so a place loaded twice appears twice.
    return j.select(
        F.col("OBJECTID").alias("place_id"),
        F.col("LATITUDE").alias("latitude"),
        F.col("LONGITUDE").alias("longitude"),
        F.coalesce(F.col("state_full"), F.col("STATE")).alias("state"),
        F.col("NAME").alias("county"),
        F.lit(COUNTRY).alias("country_code"),
    ).dropDuplicates(["place_id"])


def run_loads(wh: Warehouse, inputs: Inputs, ctx: RunContext) -> dict[str, LoadResult]:
    results: dict[str, LoadResult] = {}
    if not inputs.quarantine_dir:
        raise ValueError("give a quarantine folder that the cluster shares")
    q = inputs.quarantine_dir.rstrip("/")
    if inputs.county_csv:
        results["counties"] = loads.load_counties(wh, inputs.county_csv, f"{q}/counties", ctx)
    seed_df = seed.read_seed(wh.spark, inputs.seed_csv) if inputs.seed_csv else seed.state_codes(wh.spark)
    seed.write_seed(seed_df, wh.name("raw", loads.SEED_TABLE))
    if inputs.quake_features:
        located_at = places(wh) if wh.spark.catalog.tableExists(wh.name("raw", loads.COUNTY_TABLE)) else None
        results["quakes"] = loads.load_quakes(
            wh, inputs.quake_features, f"{q}/quakes", ctx, places=located_at,
            period=inputs.period(ctx), bbox=inputs.quake_bbox, sequence=inputs.quake_lines,
        )
    if inputs.rig_sheets:
        results["rigs"] = loads.load_rigs(wh, inputs.rig_sheets, f"{q}/rigs", ctx)
    return results


BRONZE_SOURCES = {
    "bronze_rig_count": loads.RIG_TABLE,
    "bronze_county": loads.COUNTY_TABLE,
    "bronze_rig_earthquake": loads.QUAKE_TABLE,
}


def build_models(wh: Warehouse, ctx: RunContext, partition_silver: bool = False) -> None:
    """Bronze views, silver tables, gold tables. With ``partition_silver``
    the large silver tables are laid out by year, so year filters prune."""
    for name, table in BRONZE_SOURCES.items():
        wh.view("bronze", name, bronze.VIEWS[name].format(source=f"`{wh.ns.raw}`.`{table}`"))
    wh.table("silver", "silver_rig_counts",
             silver.silver_rig_counts(wh.ref("bronze", "bronze_rig_count"), ctx), SILVER_TAGS,
             comment="US rig counts by publish date, with ISO weeks", partition_by=("year",) if partition_silver else ())
    wh.table("silver", "silver_counties",
             silver.silver_counties(wh.ref("bronze", "bronze_county"), wh.source(loads.SEED_TABLE), ctx), SILVER_TAGS,
             comment="County centroids with their state's full name")
    wh.table("silver", "silver_earthquake",
             silver.silver_earthquake(wh.source(loads.QUAKE_TABLE), ctx), SILVER_TAGS,
             comment="Events with id, time and magnitude", partition_by=("event_year",) if partition_silver else ())
    wh.table("silver", "silver_earthquake_with_location",
             silver.silver_earthquake_with_location(wh.ref("bronze", "bronze_rig_earthquake"), ctx), SILVER_TAGS,
             comment="Events with the state code of their place text")
    rigs, quakes = wh.ref("silver", "silver_rig_counts"), wh.ref("silver", "silver_earthquake")
    wh.table("gold", "state_rig_count", gold.state_rig_count(rigs), GOLD_TAGS,
             comment="Per state and county rig totals with ranks")
    wh.table("gold", "earthquake_ranking", gold.earthquake_ranking(quakes, ctx.thresholds), GOLD_TAGS,
             comment="Per state and county event counts with ranks")
    wh.table("gold", "gold_agg_rig_earthquake",
             gold.gold_agg_rig_earthquake(rigs, quakes, ctx.thresholds), GOLD_TAGS,
             comment="State-level rigs and events over shared weeks")


def run(wh: Warehouse, inputs: Inputs, ctx: RunContext, partition_silver: bool = False) -> dict[str, LoadResult]:
    wh.create_namespaces()
    results = run_loads(wh, inputs, ctx)
    build_models(wh, ctx, partition_silver=partition_silver)
    return results
