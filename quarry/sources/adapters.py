"""Driver test tables -> the raw shapes the models read.

The test tables are a TPC-H-like star schema; these adapters give them
the columns of the three raw sources (rig sheet, event feed, county
centroids) and of the state lookup. The oracle SQL in
``quarry.oracle`` builds the same shapes with the same expressions.

Dimension tables (supplier, part, customer) grow with the scale factor,
so none is broadcast unless its size is known (``bounded_broadcast``)
and joined by shuffle otherwise; ``nation``, fixed at 25 rows, is
always broadcast. The fact tables (lineitem, orders) are never broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import lit_ntz
from quarry.operators.joins import bounded_broadcast

# Fixed values stamped on adapted rows (must match quarry.oracle).
INGESTED_AT = dt.datetime(2024, 1, 31, 6, 0, 0)
RIG_SOURCE = "rig count sheet"
RIG_FILE_URL = "file:///input/rigs/nam_weekly.csv"
QUAKE_SOURCE = "event feed"
QUAKE_API_URL = "file:///input/events/features.geojson"
QUAKE_PERIOD = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
COUNTY_SOURCE = "county centroids"
COUNTY_FILE_PATH = "/input/US_Counties_Centroids.csv"

# Synthetic coordinates: a key spread over the extract area.
LON_ORIGIN, LAT_ORIGIN = -125.0, 24.6
LON_STEPS, LAT_STEPS = 6000, 2440
EVENT_LON_FACTOR, EVENT_LAT_FACTOR = 7919, 104729
PLACE_LON_FACTOR, PLACE_LAT_FACTOR = 611953, 15485863
# Counties of nations from this key on carry a code that the lookup lacks.
KNOWN_STATES = 20
# Divisor turning an order price into a magnitude-like value.
MAGNITUDE_DIVISOR = 100003.0


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is taken from the files once; nothing else is
    kept between queries."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(key: Column, factor: int, steps: int, origin: float) -> Column:
    """``origin + (key * factor % steps) / 100`` in double arithmetic."""
    return F.lit(origin) + (key * F.lit(factor) % F.lit(steps)).cast("double") / F.lit(100.0)


def raw_rigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rig sheet rows: lineitem x supplier x nation x part."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    # Star join: the fact side streams; each dimension is joined on its own,
    # so the planner sees the size of its file (a join's estimate is no bound).
    j = (
        li.join(bounded_broadcast(sup), li.l_suppkey == sup.s_suppkey)
        .join(bounded_broadcast(nat), F.col("s_nationkey") == nat.n_nationkey)
        .join(bounded_broadcast(part), li.l_partkey == part.p_partkey)
    )
    k = F.col("l_orderkey")
    return j.select(
        F.when(k % 10 < 9, F.lit("United States")).otherwise(F.lit("Canada")).alias("Country"),
        F.col("p_type").alias("County"),
        F.col("p_brand").alias("Basin"),
        F.lit("N").alias("GOM"),
        F.col("l_returnflag").alias("DrillFor"),
        F.lit("Land").alias("Location"),
        F.col("n_name").alias("State/Province"),
        F.col("l_linestatus").alias("Trajectory"),
        F.year("l_shipdate").cast("bigint").alias("Year"),
        F.month("l_shipdate").cast("bigint").alias("Month"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("US_PublishDate"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("l_quantity").cast("bigint")).alias("Rig Count Value"),
        lit_ntz(INGESTED_AT).alias("ingestion_timestamp"),
        F.lit(RIG_SOURCE).alias("data_source"),
        F.lit(RIG_FILE_URL).alias("file_url"),
    )


def raw_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event feed rows: orders x customer x nation."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(bounded_broadcast(c), o.o_custkey == c.c_custkey).join(
        bounded_broadcast(nat), F.col("c_nationkey") == nat.n_nationkey
    )
    k = F.col("o_orderkey")
    return j.select(
        k.cast("string").alias("id"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / F.lit(MAGNITUDE_DIVISOR)).alias("magnitude"),
        F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")).alias("place"),
        F.col("o_orderdate").alias("time"),
        F.col("o_orderdate").alias("updated"),
        (F.col("c_custkey") % 1000).alias("sig"),
        F.lit(",feed,").alias("sources"),
        F.lit(",origin,").alias("types"),
        F.substring("o_orderpriority", 1, 1).alias("magType"),
        F.lit("earthquake").alias("type"),
        F.col("o_orderpriority").alias("title"),
        spread(k, EVENT_LON_FACTOR, LON_STEPS, LON_ORIGIN).alias("longitude"),
        spread(k, EVENT_LAT_FACTOR, LAT_STEPS, LAT_ORIGIN).alias("latitude"),
        ((k % 700).cast("double") / F.lit(10.0)).alias("elevation"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("county"),
        F.lit("US").alias("country_code"),
        lit_ntz(INGESTED_AT).alias("ingestion_timestamp"),
        F.lit(QUAKE_SOURCE).alias("data_source"),
        F.lit(QUAKE_API_URL).alias("api_url"),
        F.lit(QUAKE_PERIOD[0]).alias("data_period_start"),
        F.lit(QUAKE_PERIOD[1]).alias("data_period_end"),
        F.lit("USA").alias("region"),
    )


def raw_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County centroid rows: one per supplier."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    k = F.col("s_suppkey")
    lon = spread(k, PLACE_LON_FACTOR, LON_STEPS, LON_ORIGIN)
    lat = spread(k, PLACE_LAT_FACTOR, LAT_STEPS, LAT_ORIGIN)
    return s.select(
        lon.alias("X"),
        lat.alias("Y"),
        k.alias("OBJECTID_1"),
        k.alias("OBJECTID"),
        F.col("s_name").alias("NAME"),
        F.when(F.col("s_nationkey") < KNOWN_STATES, F.col("s_nationkey").cast("string")).otherwise("??").alias("STATE"),
        F.col("s_nationkey").cast("bigint").alias("STATE_FIPS_CD"),
        (k % 1000).alias("COUNTY_FIPS_CD"),
        (F.col("s_nationkey").cast("bigint") * 1000 + k % 1000).alias("FIPS_CD"),
        (k * 10).alias("POPULATION"),
        F.col("s_acctbal").alias("POP_SQMI"),
        F.lit(100.0).alias("SQMI"),
        F.concat(F.lit("C"), k.cast("string")).alias("DHCS_CNTY_CD"),
        lat.alias("LATITUDE"),
        lon.alias("LONGITUDE"),
        lit_ntz(INGESTED_AT).alias("INGESTION_TIMESTAMP"),
        F.lit(COUNTY_SOURCE).alias("DATA_SOURCE"),
        F.lit(COUNTY_FILE_PATH).alias("FILE_PATH"),
    )


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup stand-in: every nation (code = key as text)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("state_abbrev"),
        F.col("n_name").alias("state_full"),
    )
