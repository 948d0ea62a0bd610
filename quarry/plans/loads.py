"""Raw loads (S7, L1-L7): read -> type leniently -> stamp -> append.

The reader keeps bad rows (flagged), ``operators.validate`` tells good rows
from others, and the classified extract is staged once as columns in the
shared checkpoint folder. From there rejected rows go to a quarantine
folder and good rows, typed and stamped, are appended. Every row of the
extract is either loaded or quarantined. An empty extract loads nothing and
leaves the table untouched.

Each load has an id, which names its partition of the raw table and its
quarantine folder. A run's loads get a new one each, so a repeated run adds
its rows (and rejects) again, as the raw tables do. A streaming batch always
has the same one, so a batch that is replayed replaces what it wrote.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.config import RunContext
from quarry.functions import null_tokens
from quarry.operators import filters, validate
from quarry.operators.nearest import attach_nearest
from quarry.plans.materialize import Warehouse
from quarry.sinks import key_table, writers
from quarry.sources import delimited, geojson, sheet
from quarry.sources.nulls import COUNTY_NULL_TOKENS, QUAKE_NULL_TOKENS

# Raw table names (fixed values).
RIG_TABLE = "bronze_rig_count_raw"
QUAKE_TABLE = "bronze_earthquake_raw"
COUNTY_TABLE = "us_counties_centroids"
SEED_TABLE = "state_code"

# Load labels stamped into ``data_source``.
RIG_SOURCE = "rig count sheet"
QUAKE_SOURCE = "earthquake feed"
COUNTY_SOURCE = "county centroids csv"


def _paths_text(paths: str | Sequence[str]) -> str:
    return paths if isinstance(paths, str) else ",".join(paths)


def _load(
    wh: Warehouse,
    table: str,
    schema: T.StructType,
    classified: DataFrame,
    quarantine: str,
    meta: dict[str, object],
    ctx: RunContext,
    loaded_at_col: str = "ingestion_timestamp",
    refresh: bool = False,
    source: str = "",
    once: bool = False,
    count_table: bool = False,
    event_time: str | None = None,
    key: str | None = None,
) -> writers.LoadResult:
    """Create the table if absent, quarantine rejected rows, then append the
    good ones (``refresh``: replace the table's rows instead). A table created
    with ``event_time`` is partitioned by its day as well. The values of the
    column ``key`` go to the table's key table, for its unique check.

    ``once`` is for streaming batches: the load's id comes from the quarantine
    folder, which names the table, the stream and the batch, so a replay
    replaces the batch's rows and rejects. A marker there, written last, only
    saves the work of a replay after it. ``count_table`` also counts the rows
    of the whole table (a scan)."""
    spark = wh.spark
    target = wh.name("raw", table)
    folder = quarantine.rstrip("/")
    writers.ensure_table(spark, target, schema, by_load=True, by_day=event_time is not None)
    marker = f"{folder}/_loaded-{target}"
    if once and writers.exists(spark, marker):
        return writers.LoadResult(0, 0, 0)
    if once:
        load_id = batch_id(target, folder)
    else:
        load_id = f"{ctx.run_id or 'run'}-{zlib.crc32(source.encode()):08x}-{uuid.uuid4().hex[:12]}"
    staged, result = writers.stage(classified)
    if result.rows_in:  # S7: else nothing to load, table untouched
        stamped = writers.stamp_metadata(staged, meta, ctx.loaded_at, loaded_at_col=loaded_at_col)
        good_cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
        if key:
            good = stamped.where(F.col(validate.REASON).isNull())
            key_table.add(good.select(F.col(f"`{key}`").try_cast(schema[key].dataType).alias(key)), target, key, load_id)
        writers.write_split(stamped, result, good_cols, target, f"{folder}/load={load_id}", load_id, refresh=refresh, event_time=event_time)
    if once:
        writers.mark(spark, marker)
    # The write may have run in another session (a stream's batch): drop
    # this session's cached file listing of the table before reading it.
    spark.catalog.refreshTable(target)
    if count_table:
        result.table_rows = spark.table(target).count()
    return result


def batch_id(*names: str) -> str:
    """Load id of a streaming batch, from what names it."""
    return "batch-" + hashlib.sha256("\n".join(names).encode()).hexdigest()[:24]


def load_rigs(wh: Warehouse, paths: str | Sequence[str], quarantine: str, ctx: RunContext,
              refresh: bool = False) -> writers.LoadResult:
    """Sheet exports -> raw rigs. Empty text stays empty (no NULL tokens).

    ``refresh`` replaces the table's rows with this extract (stamped like
    an append) instead of adding to them."""
    raw = sheet.read_rig_sheet(wh.spark, paths).drop("file_path")
    return load_rig_rows(wh, raw, quarantine, ctx, _paths_text(paths), refresh=refresh)


def load_rig_rows(wh: Warehouse, raw: DataFrame, quarantine: str, ctx: RunContext, file_url: str,
                  refresh: bool = False, once: bool = False) -> writers.LoadResult:
    """Parsed sheet rows (12 text columns + corrupt record) -> raw rigs."""
    classified = validate.classify(raw, S.RIG_SHEET, corrupt_col="_corrupt_record")
    meta = {"data_source": RIG_SOURCE, "file_url": file_url}
    return _load(wh, RIG_TABLE, S.RAW_RIGS, classified, quarantine, meta, ctx, refresh=refresh, source=file_url, once=once)


def load_counties(wh: Warehouse, path: str, quarantine: str, ctx: RunContext) -> writers.LoadResult:
    """Headered county CSV -> raw counties (empty fields become NULL)."""
    raw = delimited.read_text_columns(wh.spark, path, S.COUNTY_FILE, null_values=COUNTY_NULL_TOKENS)
    return load_county_rows(wh, raw, quarantine, ctx, path)


def load_county_rows(wh: Warehouse, raw: DataFrame, quarantine: str, ctx: RunContext, file_path: str,
                     once: bool = False) -> writers.LoadResult:
    """County rows as text (with the corrupt record) -> raw counties."""
    classified = validate.classify(raw, S.COUNTY_FILE, corrupt_col=delimited.CORRUPT)
    meta = {"DATA_SOURCE": COUNTY_SOURCE, "FILE_PATH": file_path}
    return _load(wh, COUNTY_TABLE, S.RAW_COUNTIES, classified, quarantine, meta, ctx,
                 loaded_at_col="INGESTION_TIMESTAMP", source=file_path, once=once)


def load_quakes(
    wh: Warehouse,
    paths: str | Sequence[str],
    quarantine: str,
    ctx: RunContext,
    places: DataFrame | None = None,
    period: tuple[dt.date, dt.date] | None = None,
    bbox: dict | None = None,
    api_url: str = "",
    sequence: bool = False,
    count_table: bool = False,
) -> writers.LoadResult:
    """GeoJSON features -> raw events, each located at its nearest place.

    ``places`` has (place_id, latitude, longitude) and some of state,
    county, country_code; events without valid coordinates keep NULL
    location columns. ``period`` and ``bbox`` are the extract's source-side
    predicates: events known to be outside are not part of the extract.
    """
    ev = geojson.flatten_features(geojson.read_features(wh.spark, paths, sequence=sequence))
    return load_quake_rows(wh, ev, quarantine, ctx, places=places, period=period, bbox=bbox, api_url=api_url,
                           source=_paths_text(paths), count_table=count_table)


LOCATION = ("state", "county", "country_code")


def load_quake_rows(
    wh: Warehouse,
    ev: DataFrame,
    quarantine: str,
    ctx: RunContext,
    places: DataFrame | None = None,
    period: tuple[dt.date, dt.date] | None = None,
    bbox: dict | None = None,
    api_url: str = "",
    source: str = "",
    once: bool = False,
    count_table: bool = False,
) -> writers.LoadResult:
    """Flattened feed events as text (``geojson.flatten_features``) -> raw events."""
    inside = F.lit(True)
    if period:
        inside = inside & filters.in_time_window(F.col("time").try_cast("timestamp_ntz"), *period)
    if bbox:
        inside = inside & filters.in_bbox(F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double"), **bbox)
    ev = ev.where(F.coalesce(inside, F.lit(True)))  # what cannot be judged is left to the typing
    known = [c for c in LOCATION if places is not None and c in places.columns]
    if known:
        ev = attach_nearest(ev, places, {c: c for c in known}).drop("place_id", "distance_km")
    ev = ev.withColumns({c: F.lit(None).cast("string") for c in LOCATION if c not in known})
    cols = [null_tokens(F.col(f.name), QUAKE_NULL_TOKENS).alias(f.name) for f in S.QUAKE_EVENT.fields]
    classified = validate.classify(ev.select(*cols, geojson.CORRUPT), S.QUAKE_EVENT, corrupt_col=geojson.CORRUPT)
    meta = {
        "data_source": QUAKE_SOURCE,
        "api_url": api_url,
        "data_period_start": period[0] if period else None,
        "data_period_end": period[1] if period else None,
        "region": "USA",
    }
    return _load(wh, QUAKE_TABLE, S.RAW_QUAKES, classified, quarantine, meta, ctx, source=source, once=once, count_table=count_table, event_time="time",
                 key="id")


def events_between(wh: Warehouse, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> DataFrame:
    """Raw events of a period (both ends inclusive); only its days are read."""
    events = wh.source(QUAKE_TABLE)
    return filters.time_window(events, "time", start, end, day=writers.EVENT_DAY if writers.EVENT_DAY in events.columns else None)


def recent_events(wh: Warehouse, as_of: dt.date, days: int = filters.EVENT_LOOKBACK_DAYS) -> DataFrame:
    """Raw events of the ``days`` days up to ``as_of``; only those are read."""
    return events_between(wh, as_of - dt.timedelta(days=days), as_of)
