"""Bronze views (M1-M3): raw tables as they are, rigs minus incomplete rows.

Each is one SELECT over ``{source}``, used for the persisted views and,
with a DataFrame in its place, for queries on one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

VIEWS = {
    "bronze_rig_count": "SELECT * FROM {source} WHERE `Country` IS NOT NULL AND `Rig Count Value` IS NOT NULL",
    "bronze_county": "SELECT * FROM {source}",
    "bronze_rig_earthquake": "SELECT * FROM {source}",
}


def _model(name: str, source: DataFrame) -> DataFrame:
    return source.sparkSession.sql(VIEWS[name], source=source)


def bronze_rig_count(raw_rigs: DataFrame) -> DataFrame:
    """Raw rig rows that have a country and a rig count."""
    return _model("bronze_rig_count", raw_rigs)


def bronze_county(raw_counties: DataFrame) -> DataFrame:
    return _model("bronze_county", raw_counties)


def bronze_rig_earthquake(raw_quakes: DataFrame) -> DataFrame:
    return _model("bronze_rig_earthquake", raw_quakes)
