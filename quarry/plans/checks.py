"""The warehouse's declared data-quality suite (Q1-Q3) as DataFrames.

``column_checks`` runs every not-null and unique check of the raw and
silver tables (one scan per table for its not-null checks, one for its
unique checks; a raw table whose loads all have their keys in a key table is
checked there);
``source_freshness`` checks the loaded-at column of each raw source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from quarry.operators import quality
from quarry.plans import loads
from quarry.plans.materialize import Warehouse
from quarry.sinks import key_table

# The declared checks (layer, table, not-null columns,
# unique columns) and the loaded-at column of each raw source.
NOT_NULL = [
    ("raw", loads.RIG_TABLE, ["ingestion_timestamp", "data_source", "file_url"]),
    ("raw", loads.QUAKE_TABLE, ["id", "magnitude", "time", "longitude", "latitude",
                                "ingestion_timestamp", "data_source", "region"]),
    ("raw", loads.COUNTY_TABLE, ["NAME", "STATE", "LATITUDE", "LONGITUDE",
                                 "INGESTION_TIMESTAMP", "DATA_SOURCE", "FILE_PATH"]),
    ("silver", "silver_earthquake_with_location", ["id", "longitude", "latitude", "magnitude", "event_time"]),
]
UNIQUE = [
    ("raw", loads.QUAKE_TABLE, "id"),
    ("silver", "silver_earthquake_with_location", "id"),
]
LOADED_AT = [
    (loads.RIG_TABLE, "ingestion_timestamp"),
    (loads.QUAKE_TABLE, "ingestion_timestamp"),
    (loads.COUNTY_TABLE, "INGESTION_TIMESTAMP"),
]


def _table(wh: Warehouse, layer: str, name: str) -> DataFrame:
    return wh.source(name) if layer == "raw" else wh.ref(layer, name)


def column_checks(wh: Warehouse) -> DataFrame:
    """(table_name, column_name, check_name, failures, status) per check."""
    parts = [quality.not_null(_table(wh, layer, t), t, cols) for layer, t, cols in NOT_NULL]
    by_table: dict[tuple[str, str], list[str]] = {}
    for layer, t, c in UNIQUE:
        if layer == "raw" and key_table.covers(wh.spark, wh.name("raw", t), c):
            parts.append(key_table.unique(wh.spark, wh.name("raw", t), c, t))
            continue
        by_table.setdefault((layer, t), []).append(c)
    parts += [quality.unique_many(_table(wh, layer, t), t, cols) for (layer, t), cols in by_table.items()]
    return quality.union_all(parts)


def source_freshness(wh: Warehouse, as_of: dt.datetime) -> DataFrame:
    """(table_name, max_loaded_at, age_seconds, status) per raw source."""
    return quality.union_all([quality.freshness(wh.source(t), t, col, as_of) for t, col in LOADED_AT])
