"""Incremental file load.

A drop folder is read with the streaming file source, which records
every file it has processed in the query's checkpoint. Each run uses
``trigger(availableNow=True)``: it loads the files not seen before and
stops, so a re-run without new files adds no rows. Files are tracked by
path, so each extract must land under a new name (a file replaced under
the same name is not read again).

Batches go through the same typing, quarantine and stamping as the batch
loads, and each is added exactly once. A batch is named by the table, the id
that Spark keeps in the stream's checkpoint, and the batch number (which
starts at 0 in every checkpoint), so feeds and new checkpoints can share one
quarantine folder. That name is the batch's partition of the table, which a
write puts in place as a whole: when the driver is lost at any point before
Spark has noted the batch, the replay replaces what the lost one left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.operators import filters

KEEP_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def _to_end(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Runs the stream over what is new; the number of rows read in all its
    batches (Spark keeps the last 100 progress reports unless told to keep more)."""
    spark = stream.sparkSession
    kept = spark.conf.get(KEEP_PROGRESS)
    spark.conf.set(KEEP_PROGRESS, str(1 << 30))
    try:
        query = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(KEEP_PROGRESS, kept)
    return sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)


def _new_files(spark: SparkSession, folder: str) -> DataFrame:
    """The new files of a drop folder as a stream of their paths (no file is opened)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).load(folder).select("path")


def _paths(batch: DataFrame) -> list[str]:
    """The files of a batch: which ones is fixed in the stream's checkpoint
    before the batch runs, so a replay reads the same."""
    return sorted(r["path"] for r in batch.collect())


def load_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    fmt: str = "csv",
    options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    refresh_table: str | None = None,
) -> int:
    """Process files not seen before; return the number of input rows. A
    value that does not fit ``schema`` ends the load (mode FAILFAST) unless
    ``options`` say otherwise; the loads below quarantine such rows."""
    reader = spark.readStream.format(fmt).schema(schema).options(**{"mode": "FAILFAST"} | (options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = _to_end(reader.load(source_dir), on_batch, checkpoint)
    if refresh_table:
        # Batches write through the stream's own session.
        spark.catalog.refreshTable(refresh_table)
    return rows


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream, which its checkpoint keeps from the first run on."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def append_batches(table: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str,
                   event_time: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: transform the batch and add it to ``table`` as the
    partition of its load, exactly once. The table must be partitioned by load
    (``ensure_table(by_load=True)``); ``checkpoint`` is the stream's.
    ``event_time`` is needed if the table is partitioned by day too."""
    from quarry.plans.loads import batch_id
    from quarry.sinks import writers

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        columns = spark.table(table).columns
        parts = writers.partitioning(columns)
        if not parts:
            raise ValueError(f"{table} is not partitioned by {writers.LOAD_ID}: a replayed batch would be added twice")
        out = transform(batch).select(*[f"`{c}`" for c in columns[:-len(parts)]])
        writers.add_rows(out, table, batch_id(table, _stream_id(spark, checkpoint), str(epoch_id)), event_time=event_time)
    return run


def _load_each(wh, stream: DataFrame, checkpoint: str, quarantine: str, table: str, load: Callable[[DataFrame, str], object]) -> int:
    target = wh.name("raw", table)

    def run(batch: DataFrame, epoch_id: int) -> None:
        stream_id = _stream_id(wh.spark, checkpoint)
        load(batch, f"{quarantine.rstrip('/')}/table={target}/stream={stream_id}/batch={epoch_id}")

    rows = _to_end(stream, run, checkpoint)
    wh.spark.catalog.refreshTable(target)
    return rows


def load_new_sheets(wh, drop_dir: str, checkpoint: str, quarantine: str, ctx) -> int:
    """Rig sheet exports dropped into ``drop_dir``: load the files not
    seen before into the raw rig table; return the number of files."""
    from quarry.plans import loads
    from quarry.sources import sheet

    return _load_each(wh, _new_files(wh.spark, drop_dir), checkpoint, quarantine, loads.RIG_TABLE, lambda batch, path: loads.load_rig_rows(
        wh, sheet.read_rig_sheet(wh.spark, _paths(batch)).drop("file_path"), path, ctx, file_url=drop_dir, once=True))


def load_new_counties(wh, drop_dir: str, checkpoint: str, quarantine: str, ctx) -> int:
    """Headered county files dropped into ``drop_dir``, each with its columns
    in an order of its own (a file without one of them ends the load): load
    the files not seen before; return the number of files."""
    from quarry.plans import loads
    from quarry.schemas import COUNTY_FILE
    from quarry.sources import delimited

    def load(batch: DataFrame, path: str) -> None:
        rows = delimited.read_text_columns(wh.spark, _paths(batch), COUNTY_FILE, null_values=loads.COUNTY_NULL_TOKENS)
        loads.load_county_rows(wh, rows, path, ctx, file_path=drop_dir, once=True)

    return _load_each(wh, _new_files(wh.spark, drop_dir), checkpoint, quarantine, loads.COUNTY_TABLE, load)


def load_new_features(wh, drop_dir: str, checkpoint: str, quarantine: str, ctx, places: DataFrame | None = None,
                      api_url: str = "", period: tuple[dt.date, dt.date] | None = None,
                      bbox: dict | None = filters.US_BBOX, lines: bool = True) -> int:
    """GeoJSON features dropped into ``drop_dir`` (one a line, or collections
    with ``lines=False``): load the files not seen before into the raw event
    table, each event located at its nearest place; return the number of files.

    As in the batch load, events outside the box or the period (else the
    look-back days up to the run's day) are not part of the extract, and the
    period is stamped on the rows."""
    from quarry.plans import loads
    from quarry.sources import geojson

    if period is None:
        end = (ctx.loaded_at or dt.datetime.now(dt.timezone.utc)).date()
        period = (end - dt.timedelta(days=filters.EVENT_LOOKBACK_DAYS), end)

    def load(batch: DataFrame, path: str) -> None:
        events = geojson.flatten_features(geojson.read_features(wh.spark, _paths(batch), sequence=lines))
        loads.load_quake_rows(wh, events, path, ctx, places=places, period=period, bbox=bbox, api_url=api_url, source=drop_dir, once=True)

    return _load_each(wh, _new_files(wh.spark, drop_dir), checkpoint, quarantine, loads.QUAKE_TABLE, load)
