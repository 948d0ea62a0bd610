"""GeoJSON feature collections.

One row per feature: id, the ``properties`` fields, and longitude /
latitude / elevation from ``geometry.coordinates[0..2]``. Missing objects,
keys or coordinates give NULL (declared schema, safe index); times are
epoch milliseconds where 0 means "no time".

Values come as text, beside a corrupt-record column: a line that is not
JSON, or a value that does not fit its column's type, reaches
``operators.validate`` and is quarantined whole. A collection file that
cannot be decoded ends the load; only a decoded one without features is
empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import epoch_millis_to_ntz, safe_index
from quarry.schemas import GEOJSON_COLLECTION, QUAKE_EVENT
from quarry.sources import json_blocks
from quarry.sources.delimited import larger_than_a_task

FEATURE = GEOJSON_COLLECTION["features"].dataType.elementType
CORRUPT = "_corrupt_record"
FEATURE_LINE = T.StructType(FEATURE.fields + [T.StructField(CORRUPT, T.StringType())])


def read_features(spark: SparkSession, paths: str | Sequence[str], sequence: bool = False, blocks: bool | None = None) -> DataFrame:
    """Features of collection files (``sequence=False``: one JSON object
    per file) or of line-delimited feature files (``sequence=True``: one
    feature per line, split across tasks). ``blocks`` tells whether collections
    are read by many tasks each (if not given: where one is larger than a
    task's share, ``spark.sql.files.maxPartitionBytes``); the rows are the same."""
    p = paths if isinstance(paths, str) else list(paths)
    listed = [p] if isinstance(p, str) else p
    if not sequence and (blocks if blocks is not None else any(larger_than_a_task(spark, x) for x in listed)):
        found = json_blocks.read_objects(spark, listed, "features")
        return found.select(F.from_json("value", FEATURE, {"mode": "FAILFAST"}).alias("f"), F.lit(None).cast("string").alias(CORRUPT))
    if sequence:
        return feature_lines(spark.read.schema(FEATURE_LINE).option("columnNameOfCorruptRecord", CORRUPT).json(p))
    coll = spark.read.schema(GEOJSON_COLLECTION).option("multiLine", True).option("mode", "FAILFAST").json(p)
    missing = F.raise_error(F.lit("a decoded file has no features")).cast(GEOJSON_COLLECTION["features"].dataType)
    return coll.select(F.explode(F.coalesce("features", missing)).alias("f"), F.lit(None).cast("string").alias(CORRUPT))


def feature_lines(lines: DataFrame) -> DataFrame:
    """(f, corrupt record) of parsed feature lines."""
    return lines.select(F.struct(*[f.name for f in FEATURE.fields]).alias("f"), CORRUPT)


def _time_text(millis: Column) -> Column:
    """Epoch milliseconds as the text of a time; other text as it is."""
    number = millis.try_cast("bigint")
    return F.when(number.isNotNull(), epoch_millis_to_ntz(number).cast("string")).otherwise(millis)


def flatten_features(features: DataFrame) -> DataFrame:
    """Event columns as text in the raw feed's order (location columns come
    later), and the corrupt-record column."""
    props, coords = F.col("f.properties"), F.col("f.geometry.coordinates")
    return features.select(
        F.col("f.id").alias("id"),
        props["mag"].alias("magnitude"),
        props["place"].alias("place"),
        _time_text(props["time"]).alias("time"),
        _time_text(props["updated"]).alias("updated"),
        props["sig"].alias("sig"),
        props["sources"].alias("sources"),
        props["types"].alias("types"),
        props["magType"].alias("magType"),
        props["type"].alias("type"),
        props["title"].alias("title"),
        safe_index(coords, 0).alias("longitude"),
        safe_index(coords, 1).alias("latitude"),
        safe_index(coords, 2).alias("elevation"),
        CORRUPT,
    )


def read_events(spark: SparkSession, paths: str | Sequence[str], sequence: bool = False) -> DataFrame:
    """Events with their declared types; what does not fit is NULL here (the
    loads quarantine it)."""
    text = flatten_features(read_features(spark, paths, sequence))
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in QUAKE_EVENT.fields if f.name in text.columns])
