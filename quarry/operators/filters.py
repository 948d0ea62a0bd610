"""Row filters (required fields, normalized equality, source-side windows)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import present


def required_fields(df: DataFrame, columns: Sequence[str], nan_is_missing: bool = False) -> DataFrame:
    """Keep rows where every column is present.

    With ``nan_is_missing`` a NaN in a float / double column counts as
    missing too (the pandas ``notna`` rule). The NOT NULL parts reach the
    Parquet scan as pushed filters.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cond = None
    for c in columns:
        numeric = nan_is_missing and isinstance(types.get(c), (T.DoubleType, T.FloatType))
        term = present(F.col(f"`{c}`"), numeric=numeric)
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def normalized_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """``UPPER(column) = value`` (the value is compared as given)."""
    return df.where(F.upper(F.col(f"`{column}`")) == F.lit(value))


def in_time_window(t: Column, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> Column:
    """``start <= t <= end``; a bare date bound means midnight of that day."""
    def bound(x):
        if isinstance(x, dt.datetime):
            return F.lit(x.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
        return F.lit(x.isoformat()).cast("timestamp_ntz")
    return (t >= bound(start)) & (t <= bound(end))


def time_window(df: DataFrame, column: str, start: dt.date | dt.datetime, end: dt.date | dt.datetime, day: str | None = None) -> DataFrame:
    """Rows with ``start <= column <= end``. ``day`` names a partition column
    that holds the day of ``column``: other days are not read then."""
    inside = in_time_window(F.col(f"`{column}`"), start, end)
    if day:
        first, last = (x.date() if isinstance(x, dt.datetime) else x for x in (start, end))
        inside = F.col(f"`{day}`").between(F.lit(first), F.lit(last)) & inside
    return df.where(inside)


def last_days(df: DataFrame, column: str, as_of: dt.date, days: int) -> DataFrame:
    """Events of the ``days`` days up to ``as_of`` (both ends inclusive)."""
    return time_window(df, column, as_of - dt.timedelta(days=days), as_of)


def in_bbox(lat: Column, lon: Column, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> Column:
    """Points inside a latitude / longitude box, borders included."""
    return lat.between(F.lit(min_lat), F.lit(max_lat)) & lon.between(F.lit(min_lon), F.lit(max_lon))


def bbox(df: DataFrame, lat: str, lon: str, **box: float) -> DataFrame:
    return df.where(in_bbox(F.col(lat), F.col(lon), **box))


# The extract area and look-back used by the event load.
US_BBOX = {"min_lat": 24.6, "max_lat": 49.0, "min_lon": -125.0, "max_lon": -65.0}
EVENT_LOOKBACK_DAYS = 90
