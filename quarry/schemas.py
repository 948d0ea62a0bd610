"""Declared schemas for raw inputs and model outputs.

Raw tables keep their source column names (spaces and slashes included);
silver and gold use lower snake case.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, TS, DT, B = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampNTZType(),
    T.DateType(),
    T.BooleanType(),
)

# Longest text any raw text column may hold.
MAX_TEXT = 500


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Positional names of the rig sheet (12 columns, in sheet order).
RIG_SHEET_COLUMNS = [
    "Country", "County", "Basin", "GOM", "DrillFor", "Location",
    "State/Province", "Trajectory", "Year", "Month", "US_PublishDate",
    "Rig Count Value",
]

RIG_SHEET = _struct(
    ("Country", S), ("County", S), ("Basin", S), ("GOM", S), ("DrillFor", S),
    ("Location", S), ("State/Province", S), ("Trajectory", S), ("Year", L),
    ("Month", L), ("US_PublishDate", S), ("Rig Count Value", L),
)

RIG_META = _struct(("ingestion_timestamp", TS), ("data_source", S), ("file_url", S))
RAW_RIGS = T.StructType(RIG_SHEET.fields + RIG_META.fields)

QUAKE_EVENT = _struct(
    ("id", S), ("magnitude", D), ("place", S), ("time", TS), ("updated", TS),
    ("sig", L), ("sources", S), ("types", S), ("magType", S), ("type", S),
    ("title", S), ("longitude", D), ("latitude", D), ("elevation", D),
    ("state", S), ("county", S), ("country_code", S),
)
QUAKE_META = _struct(
    ("ingestion_timestamp", TS), ("data_source", S), ("api_url", S),
    ("data_period_start", DT), ("data_period_end", DT), ("region", S),
)
RAW_QUAKES = T.StructType(QUAKE_EVENT.fields + QUAKE_META.fields)

COUNTY_FILE = _struct(
    ("X", D), ("Y", D), ("OBJECTID_1", L), ("OBJECTID", L), ("NAME", S),
    ("STATE", S), ("STATE_FIPS_CD", L), ("COUNTY_FIPS_CD", L), ("FIPS_CD", L),
    ("POPULATION", L), ("POP_SQMI", D), ("SQMI", D), ("DHCS_CNTY_CD", S),
    ("LATITUDE", D), ("LONGITUDE", D),
)
COUNTY_META = _struct(("INGESTION_TIMESTAMP", TS), ("DATA_SOURCE", S), ("FILE_PATH", S))
RAW_COUNTIES = T.StructType(COUNTY_FILE.fields + COUNTY_META.fields)

STATE_CODE = _struct(("state_abbrev", S), ("state_full", S))

# GeoJSON feature collection, only the fields the loader reads. Values are
# read as text, so one that does not fit its type is still there to be
# quarantined.
GEOJSON_COLLECTION = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("id", S),
        T.StructField("properties", _struct(
            ("mag", S), ("place", S), ("time", S), ("updated", S), ("sig", S),
            ("sources", S), ("types", S), ("magType", S), ("type", S), ("title", S),
        )),
        T.StructField("geometry", T.StructType([
            T.StructField("coordinates", T.ArrayType(S)),
        ])),
    ]))),
])


def schema_from_dtypes(dtypes: dict[str, str], declared: T.StructType) -> T.StructType:
    """Storage schema of an extract with these frame dtypes: declared columns
    as declared, others by their dtype (integers long, floats double,
    booleans boolean, anything else text)."""
    kinds = {"int": L, "float": D, "bool": B}
    known = {f.name: f.dataType for f in declared.fields}
    other = lambda dtype: next((t for k, t in kinds.items() if k in str(dtype)), S)
    return T.StructType([T.StructField(n, known.get(n) or other(d), True) for n, d in dtypes.items()])
