"""Independent SQL for the correctness check (DuckDB dialect).

The CTEs below build the same raw shapes as ``quarry.sources.adapters``
and the same models as ``quarry.plans``, written directly in SQL so the
two paths share no code. Queries in ``ORACLE`` are keyed like
``quarry.queries.QUERIES`` and alias every column to the same name.
Only ``week`` (DuckDB) vs ``weekofyear`` (Spark) differ in spelling.
"""

from __future__ import annotations

from quarry.config import FIXED_LOADED_AT, FIXED_RUN_ID
from quarry.sources import adapters as A

LOADED_AT_SQL = f"TIMESTAMP '{FIXED_LOADED_AT:%Y-%m-%d %H:%M:%S}'"
INGESTED_AT_SQL = f"TIMESTAMP '{A.INGESTED_AT:%Y-%m-%d %H:%M:%S}'"
RUN_ID_SQL = f"'{FIXED_RUN_ID}'"


def _spread(key: str, factor: int, steps: int, origin: float) -> str:
    return (
        f"(CAST({origin!r} AS DOUBLE) + CAST({key} * {factor} % {steps} AS DOUBLE) / CAST(100.0 AS DOUBLE))"
    )


def _strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^\\s+', ''), '\\s+$', '')"


RAW_RIGS = f"""raw_rigs AS (
  SELECT
    CASE WHEN l.l_orderkey % 10 < 9 THEN 'United States' ELSE 'Canada' END AS "Country",
    p.p_type AS "County",
    p.p_brand AS "Basin",
    'N' AS "GOM",
    l.l_returnflag AS "DrillFor",
    'Land' AS "Location",
    n.n_name AS "State/Province",
    l.l_linestatus AS "Trajectory",
    CAST(year(l.l_shipdate) AS BIGINT) AS "Year",
    CAST(month(l.l_shipdate) AS BIGINT) AS "Month",
    strftime(l.l_shipdate, '%Y-%m-%d') AS "US_PublishDate",
    CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE CAST(l.l_quantity AS BIGINT) END AS "Rig Count Value",
    {INGESTED_AT_SQL} AS ingestion_timestamp,
    '{A.RIG_SOURCE}' AS data_source,
    '{A.RIG_FILE_URL}' AS file_url
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

BRONZE_RIG_COUNT = """bronze_rig_count AS (
  SELECT * FROM raw_rigs WHERE "Country" IS NOT NULL AND "Rig Count Value" IS NOT NULL
)"""

SILVER_RIG_COUNTS = f"""silver_rig_counts AS (
  SELECT
    upper("Country") AS country,
    upper("County") AS county,
    upper("Basin") AS basin,
    "DrillFor" AS drill_for,
    "State/Province" AS state_or_province,
    upper("Location") AS location,
    "Trajectory" AS trajectory,
    TRY_CAST("US_PublishDate" AS DATE) AS date,
    "Year" AS year,
    "Month" AS month,
    CAST(week(TRY_CAST("US_PublishDate" AS DATE)) AS INTEGER) AS event_week_num,
    "Rig Count Value" AS rig_count,
    {LOADED_AT_SQL} AS dbt_loaded_at,
    {RUN_ID_SQL} AS dbt_batch_id
  FROM bronze_rig_count
  WHERE upper("Country") = 'UNITED STATES'
)"""

RAW_QUAKES = f"""raw_quakes AS (
  SELECT
    CAST(o.o_orderkey AS VARCHAR) AS id,
    CASE WHEN o.o_orderkey % 89 = 0 THEN NULL
         ELSE o.o_totalprice / CAST({A.MAGNITUDE_DIVISOR!r} AS DOUBLE) END AS magnitude,
    c.c_name || ', ' || n.n_name AS place,
    o.o_orderdate AS time,
    o.o_orderdate AS updated,
    c.c_custkey % 1000 AS sig,
    ',feed,' AS sources,
    ',origin,' AS types,
    substring(o.o_orderpriority, 1, 1) AS "magType",
    'earthquake' AS type,
    o.o_orderpriority AS title,
    {_spread('o.o_orderkey', A.EVENT_LON_FACTOR, A.LON_STEPS, A.LON_ORIGIN)} AS longitude,
    {_spread('o.o_orderkey', A.EVENT_LAT_FACTOR, A.LAT_STEPS, A.LAT_ORIGIN)} AS latitude,
    CAST(o.o_orderkey % 700 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS elevation,
    n.n_name AS state,
    c.c_mktsegment AS county,
    'US' AS country_code,
    {INGESTED_AT_SQL} AS ingestion_timestamp,
    '{A.QUAKE_SOURCE}' AS data_source,
    '{A.QUAKE_API_URL}' AS api_url,
    DATE '{A.QUAKE_PERIOD[0]}' AS data_period_start,
    DATE '{A.QUAKE_PERIOD[1]}' AS data_period_end,
    'USA' AS region
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

SILVER_EARTHQUAKE = f"""silver_earthquake AS (
  SELECT
    id, longitude, latitude, elevation, magnitude,
    "magType" AS magnitude_type,
    sig AS significance,
    place,
    upper(region) AS country,
    upper(county) AS county,
    upper(state) AS state,
    time AS event_time,
    CAST(year(time) AS INTEGER) AS event_year,
    CAST(month(time) AS INTEGER) AS event_month,
    CAST(week(time) AS INTEGER) AS event_week_num,
    {LOADED_AT_SQL} AS dbt_loaded_at,
    {RUN_ID_SQL} AS dbt_batch_id
  FROM raw_quakes
  WHERE id IS NOT NULL AND time IS NOT NULL AND magnitude IS NOT NULL
)"""

SILVER_EARTHQUAKE_WITH_LOCATION = f"""silver_earthquake_with_location AS (
  SELECT
    id, longitude, latitude, elevation, magnitude,
    "magType" AS magnitude_type,
    sig AS significance,
    place,
    {_strip("string_split(place, ',')[-1]")} AS state_code,
    time AS event_time,
    CAST(year(time) AS INTEGER) AS event_year,
    CAST(month(time) AS INTEGER) AS event_month,
    CAST(week(time) AS INTEGER) AS event_week_num,
    {LOADED_AT_SQL} AS dbt_loaded_at,
    {RUN_ID_SQL} AS dbt_batch_id
  FROM raw_quakes
  WHERE id IS NOT NULL AND time IS NOT NULL AND magnitude IS NOT NULL AND NOT isnan(magnitude)
)"""

RAW_COUNTIES = f"""raw_counties AS (
  SELECT
    lon AS "X", lat AS "Y",
    s_suppkey AS "OBJECTID_1", s_suppkey AS "OBJECTID",
    s_name AS "NAME",
    CASE WHEN s_nationkey < {A.KNOWN_STATES} THEN CAST(s_nationkey AS VARCHAR) ELSE '??' END AS "STATE",
    CAST(s_nationkey AS BIGINT) AS "STATE_FIPS_CD",
    s_suppkey % 1000 AS "COUNTY_FIPS_CD",
    CAST(s_nationkey AS BIGINT) * 1000 + s_suppkey % 1000 AS "FIPS_CD",
    s_suppkey * 10 AS "POPULATION",
    s_acctbal AS "POP_SQMI",
    CAST(100.0 AS DOUBLE) AS "SQMI",
    'C' || CAST(s_suppkey AS VARCHAR) AS "DHCS_CNTY_CD",
    lat AS "LATITUDE", lon AS "LONGITUDE",
    {INGESTED_AT_SQL} AS "INGESTION_TIMESTAMP",
    '{A.COUNTY_SOURCE}' AS "DATA_SOURCE",
    '{A.COUNTY_FILE_PATH}' AS "FILE_PATH"
  FROM (
    SELECT *,
      {_spread('s_suppkey', A.PLACE_LON_FACTOR, A.LON_STEPS, A.LON_ORIGIN)} AS lon,
      {_spread('s_suppkey', A.PLACE_LAT_FACTOR, A.LAT_STEPS, A.LAT_ORIGIN)} AS lat
    FROM supplier
  ) s
)"""

STATE_CODES = """state_codes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS state_abbrev, n_name AS state_full
  FROM nation
)"""

SILVER_COUNTIES = f"""silver_counties AS (
  SELECT
    upper(br."NAME") AS county,
    upper(br."STATE") AS state_code,
    br."STATE_FIPS_CD" AS state_fips_cd,
    br."LONGITUDE" AS longitude,
    br."LATITUDE" AS latitude,
    sc.state_full AS state_name,
    {LOADED_AT_SQL} AS dbt_loaded_at,
    {RUN_ID_SQL} AS dbt_batch_id
  FROM raw_counties br
  JOIN state_codes sc ON br."STATE" = sc.state_abbrev
)"""

RIG_CHAIN = [RAW_RIGS, BRONZE_RIG_COUNT, SILVER_RIG_COUNTS]
QUAKE_CHAIN = [RAW_QUAKES, SILVER_EARTHQUAKE]

RIG_WEEKLY = """rig_by_state AS (
  SELECT state_or_province AS state, year, event_week_num,
    SUM(rig_count) AS total_rigs,
    COUNT(DISTINCT date) AS active_days,
    AVG(rig_count) AS avg_daily_rigs,
    MAX(rig_count) AS peak_rigs
  FROM silver_rig_counts
  WHERE state_or_province IS NOT NULL
  GROUP BY state_or_province, year, event_week_num
)"""

QUAKE_WEEKLY = """earthquake_by_state AS (
  SELECT state, CAST(event_year AS BIGINT) AS year, event_week_num,
    COUNT(*) AS total_earthquakes,
    COUNT(DISTINCT CAST(event_time AS DATE)) AS active_days,
    AVG(magnitude) AS avg_magnitude,
    MAX(magnitude) AS max_magnitude,
    COALESCE(COUNT_IF(magnitude >= 3.0), 0) AS significant_events,
    AVG(significance) AS avg_significance
  FROM silver_earthquake
  WHERE state IS NOT NULL
  GROUP BY state, event_year, event_week_num
)"""

COMBINED = """combined_data AS (
  SELECT r.state, r.year, r.event_week_num,
    COALESCE(r.total_rigs, 0) AS total_rigs,
    COALESCE(e.total_earthquakes, 0) AS total_earthquakes,
    COALESCE(e.avg_magnitude, 0) AS avg_magnitude
  FROM rig_by_state r
  JOIN earthquake_by_state e
    ON r.state = e.state AND r.year = e.year AND r.event_week_num = e.event_week_num
)"""

WEEKLY_CHAIN = RIG_CHAIN + QUAKE_CHAIN + [RIG_WEEKLY, QUAKE_WEEKLY, COMBINED]

STATE_RANKINGS = """state_rankings AS (
  SELECT state_or_province AS state, county,
    SUM(rig_count) AS total_rigs,
    COUNT(DISTINCT date) AS active_days,
    AVG(rig_count) AS avg_daily_rigs,
    MAX(rig_count) AS peak_rigs,
    RANK() OVER (ORDER BY MAX(rig_count) DESC NULLS FIRST) AS peak_rig_rank,
    RANK() OVER (ORDER BY SUM(rig_count) DESC NULLS FIRST) AS total_rig_rank,
    RANK() OVER (ORDER BY AVG(rig_count) DESC NULLS FIRST) AS avg_rig_rank
  FROM silver_rig_counts
  WHERE state_or_province IS NOT NULL
  GROUP BY state_or_province, county
)"""

EARTHQUAKE_ANALYSIS = """earthquake_analysis AS (
  SELECT state, county,
    COUNT(*) AS total_earthquakes,
    COUNT(DISTINCT event_time) AS active_days,
    AVG(magnitude) AS avg_magnitude,
    MAX(magnitude) AS max_magnitude,
    SUM(CASE WHEN magnitude >= 4.0 THEN 1 ELSE 0 END) AS significant_quakes
  FROM silver_earthquake
  WHERE state IS NOT NULL AND county IS NOT NULL
  GROUP BY state, county
)"""

GOLD_STATE = """gold_state AS (
  SELECT state,
    SUM(total_rigs) AS total_rigs_count,
    SUM(total_earthquakes) AS total_earthquake_count,
    AVG(avg_magnitude) AS avg_earthquake_magnitude,
    RANK() OVER (ORDER BY SUM(total_rigs) DESC NULLS FIRST) AS rig_rank,
    ROW_NUMBER() OVER (ORDER BY SUM(total_rigs) DESC NULLS FIRST, state) AS rig_position
  FROM combined_data
  GROUP BY state
)"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _nearest_sql(null_coords: bool) -> str:
    lat = "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE latitude END" if null_coords else "latitude"
    events = f"""ev AS (
  SELECT id, {lat} AS latitude, longitude FROM (SELECT *, CAST(id AS BIGINT) AS o_orderkey FROM raw_quakes) q
)"""
    d2r = "0.017453292519943295"
    s_phi = f'sin((p."LATITUDE" - e.latitude) * {d2r} / 2)'
    s_lmb = f'sin((p."LONGITUDE" - e.longitude) * {d2r} / 2)'
    km = (f"(2 * 6371.0 * asin(sqrt({s_phi} * {s_phi} + cos(e.latitude * {d2r}) * cos(p.\"LATITUDE\" * {d2r})"
          f" * ({s_lmb} * {s_lmb}))))")
    dist = f"CAST(floor({km} * 1000000.0 + 0.5) AS BIGINT)"
    ranked = f"""ranked AS (
  SELECT e.id, p."OBJECTID" AS place_id, p."NAME" AS county, p."STATE" AS state, {dist} AS km,
    ROW_NUMBER() OVER (PARTITION BY e.id ORDER BY {dist}, p."OBJECTID") AS rn
  FROM ev e CROSS JOIN raw_counties p
  WHERE e.latitude IS NOT NULL AND e.longitude IS NOT NULL
)"""
    body = """SELECT e.id AS id, r.place_id AS place_id, r.county AS county, r.state AS state,
  CAST(r.km AS DOUBLE) / 1000000.0 AS distance_km
FROM ev e LEFT JOIN ranked r ON e.id = r.id AND r.rn = 1"""
    return with_([RAW_QUAKES, RAW_COUNTIES, events, ranked], body)


_FEATURE_FLATTEN = """SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderkey % 11 = 0 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END AS magnitude,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS place,
  CASE WHEN o_orderkey % 13 = 0 THEN 'noon' WHEN o_orderkey % 17 = 0 THEN NULL
    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time,
  CAST(o_custkey % 1000 AS VARCHAR) AS sig,
  CASE WHEN o_orderkey % 4 >= 1 THEN CAST(o_orderkey % 360 AS VARCHAR) END AS longitude,
  CASE WHEN o_orderkey % 4 >= 2 THEN CAST(o_orderkey % 90 AS VARCHAR) END AS latitude,
  CASE WHEN o_orderkey % 4 >= 3 THEN CAST(o_orderkey % 700 AS VARCHAR) END AS elevation,
  CASE WHEN o_orderkey % 11 = 0 THEN 'bad_value:magnitude' WHEN o_orderkey % 13 = 0 THEN 'bad_value:time' END AS reason
FROM orders"""


def _attached_sql(row_id: str, bad: str) -> str:
    """Nearest place by row; rows where ``bad`` holds have no coordinates."""
    d2r = "0.017453292519943295"
    s_phi = f'sin((p."LATITUDE" - e.latitude) * {d2r} / 2)'
    s_lmb = f'sin((p."LONGITUDE" - e.longitude) * {d2r} / 2)'
    km = (f"(2 * 6371.0 * asin(sqrt({s_phi} * {s_phi} + cos(e.latitude * {d2r}) * cos(p.\"LATITUDE\" * {d2r})"
          f" * ({s_lmb} * {s_lmb}))))")
    dist = f"CAST(floor({km} * 1000000.0 + 0.5) AS BIGINT)"
    events = f"""ev AS (
  SELECT k AS row_key, {row_id} AS id, {bad} AS bad, latitude, longitude FROM (SELECT *, CAST(id AS BIGINT) AS k FROM raw_quakes) q
)"""
    best = f"""best AS (
  SELECT e.row_key, p."OBJECTID" AS place_id, p."NAME" AS county, {dist} AS mm,
    ROW_NUMBER() OVER (PARTITION BY e.row_key ORDER BY {dist}, p."OBJECTID") AS rn
  FROM ev e CROSS JOIN raw_counties p WHERE NOT e.bad
)"""
    return with_([RAW_QUAKES, RAW_COUNTIES, events, best], """SELECT e.row_key, e.id, b.place_id, b.county, CAST(b.mm AS DOUBLE) / 1000000.0 AS distance_km
FROM ev e LEFT JOIN best b ON e.row_key = b.row_key AND b.rn = 1""")


ORACLE: dict[str, str] = {
    # ---- composed models -------------------------------------------------
    "gold_agg_rig_earthquake": with_(WEEKLY_CHAIN + [GOLD_STATE], """SELECT state,
  CAST(total_rigs_count AS BIGINT) AS total_rigs_count,
  CAST(total_earthquake_count AS BIGINT) AS total_earthquake_count,
  round(avg_earthquake_magnitude, 9) AS avg_earthquake_magnitude,
  CAST(rig_rank AS BIGINT) AS rig_rank,
  CAST(rig_position AS BIGINT) AS rig_position
FROM gold_state ORDER BY total_rigs_count DESC"""),
    "state_rig_count": with_(RIG_CHAIN + [STATE_RANKINGS], """SELECT state, county,
  CAST(total_rigs AS BIGINT) AS total_rigs,
  CAST(active_days AS BIGINT) AS active_days,
  avg_daily_rigs,
  CAST(peak_rigs AS BIGINT) AS peak_rigs,
  CAST(peak_rig_rank AS BIGINT) AS peak_rig_rank,
  CAST(total_rig_rank AS BIGINT) AS total_rig_rank,
  CAST(avg_rig_rank AS BIGINT) AS avg_rig_rank
FROM state_rankings ORDER BY peak_rig_rank, total_rig_rank"""),
    "earthquake_ranking": with_(QUAKE_CHAIN + [EARTHQUAKE_ANALYSIS], """SELECT state, county,
  CAST(total_earthquakes AS BIGINT) AS total_earthquakes,
  CAST(active_days AS BIGINT) AS active_days,
  round(avg_magnitude, 9) AS avg_magnitude,
  max_magnitude,
  CAST(significant_quakes AS BIGINT) AS significant_quakes,
  CAST(RANK() OVER (ORDER BY total_earthquakes DESC NULLS FIRST) AS BIGINT) AS rank_by_frequency,
  CAST(RANK() OVER (ORDER BY max_magnitude DESC NULLS FIRST) AS BIGINT) AS rank_by_max_magnitude,
  CAST(RANK() OVER (ORDER BY significant_quakes DESC NULLS FIRST) AS BIGINT) AS rank_by_significant_quakes
FROM earthquake_analysis"""),
    "silver_rig_counts": with_(RIG_CHAIN, "SELECT * FROM silver_rig_counts"),
    "silver_earthquake": with_(QUAKE_CHAIN, "SELECT * FROM silver_earthquake"),
    "silver_counties": with_([RAW_COUNTIES, STATE_CODES, SILVER_COUNTIES], "SELECT * FROM silver_counties"),
    "silver_earthquake_with_location": with_(
        [RAW_QUAKES, SILVER_EARTHQUAKE_WITH_LOCATION], "SELECT * FROM silver_earthquake_with_location"
    ),
    "bronze_rig_count": with_([RAW_RIGS, BRONZE_RIG_COUNT], "SELECT * FROM bronze_rig_count"),
    "bronze_county": with_([RAW_COUNTIES], "SELECT * FROM raw_counties"),
    "bronze_rig_earthquake": with_([RAW_QUAKES], "SELECT * FROM raw_quakes"),
}


# ---- single operators ----------------------------------------------------

def _gaps(nan: bool) -> str:
    mag = "CASE WHEN k % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE magnitude END" if nan else "magnitude"
    return f"""gaps AS (
  SELECT
    CASE WHEN k % 67 = 0 THEN NULL ELSE id END AS id,
    CASE WHEN k % 71 = 0 THEN NULL ELSE time END AS time,
    {mag} AS magnitude,
    place,
    k AS row_key
  FROM (SELECT *, CAST(id AS BIGINT) AS k FROM raw_quakes) q
)"""


LINEITEM_TEXT = """li_text AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 67 = 0 THEN NULL
         WHEN l_orderkey % 53 = 0 THEN 'n/a'
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
    CASE WHEN l_orderkey % 59 = 0 THEN '1996-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date,
    CASE WHEN l_orderkey % 61 = 0 THEN repeat('x', 501) ELSE l_returnflag END AS flag
  FROM lineitem
), classified AS (
  SELECT *,
    CASE WHEN quantity IS NOT NULL AND TRY_CAST(quantity AS BIGINT) IS NULL THEN 'bad_value:quantity'
         WHEN ship_date IS NOT NULL AND TRY_CAST(ship_date AS DATE) IS NULL THEN 'bad_value:ship_date'
         WHEN length(flag) > 500 THEN 'too_long:flag'
    END AS _reject_reason
  FROM li_text
)"""

LAST_TOKEN_TEXT = """texts AS (
  SELECT c.c_custkey,
    CASE c.c_custkey % 5
      WHEN 0 THEN c.c_name
      WHEN 1 THEN c.c_name || ','
      WHEN 2 THEN c.c_name || ',' || chr(9) || n.n_name || ' '
      WHEN 3 THEN NULL
      ELSE c.c_name || ', ' || n.n_name END AS place
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def _not_null_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
            f"CAST(COALESCE(COUNT_IF({c} IS NULL), 0) AS BIGINT) AS failures, "
            f"CASE WHEN COALESCE(COUNT_IF({c} IS NULL), 0) = 0 THEN 'pass' ELSE 'fail' END AS status FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


def _unique_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'unique' AS check_name, "
            f"CAST(COUNT(*) AS BIGINT) AS failures, CASE WHEN COUNT(*) = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d"
        )
    return "\nUNION ALL\n".join(parts)


ORACLE.update({
    "passthrough": "SELECT * FROM customer",
    "rename_project": with_([RAW_QUAKES], """SELECT id, "magType" AS magnitude_type, sig AS significance,
  time AS event_time, region AS country FROM raw_quakes"""),
    "required_fields": with_([RAW_QUAKES, _gaps(False)],
        "SELECT * FROM gaps WHERE id IS NOT NULL AND time IS NOT NULL AND magnitude IS NOT NULL"),
    "required_fields_nan": with_([RAW_QUAKES, _gaps(True)],
        "SELECT * FROM gaps WHERE id IS NOT NULL AND time IS NOT NULL AND magnitude IS NOT NULL AND NOT isnan(magnitude)"),
    "normalized_equality": with_([RAW_RIGS], """SELECT "Country" AS country, "State/Province" AS state,
  "US_PublishDate" AS publish_date, "Rig Count Value" AS rig_count
FROM raw_rigs WHERE upper("Country") = 'UNITED STATES'"""),
    "audit_columns": f"SELECT o_orderkey, {LOADED_AT_SQL} AS dbt_loaded_at, {RUN_ID_SQL} AS dbt_batch_id FROM orders",
    "time_window_filter": """SELECT event_id, ts, event_type, value FROM events
WHERE ts >= CAST(DATE '2024-01-20' - INTERVAL 90 DAY AS TIMESTAMP) AND ts <= CAST(DATE '2024-01-20' AS TIMESTAMP)""",
    "bbox_filter": f"""SELECT * FROM (
  SELECT o_orderkey,
    {_spread('o_orderkey', A.EVENT_LAT_FACTOR, 18000, -90.0)} AS latitude,
    {_spread('o_orderkey', A.EVENT_LON_FACTOR, 36000, -180.0)} AS longitude
  FROM orders) p
WHERE latitude BETWEEN 24.6 AND 49.0 AND longitude BETWEEN -125.0 AND -65.0""",
    "stamp_metadata": f"""SELECT *, {INGESTED_AT_SQL} AS ingestion_timestamp, '{A.QUAKE_SOURCE}' AS data_source,
  '{A.QUAKE_API_URL}' AS api_url, DATE '2023-10-22' AS data_period_start, DATE '2024-01-20' AS data_period_end,
  'USA' AS region FROM events""",
    "lenient_cast_split": with_([LINEITEM_TEXT], "SELECT * FROM classified"),
    "load_audit": with_([LINEITEM_TEXT], """SELECT CAST(COUNT(*) AS BIGINT) AS rows_in,
  CAST(COUNT(*) FILTER (WHERE _reject_reason IS NULL) AS BIGINT) AS rows_loaded,
  CAST(COUNT(*) FILTER (WHERE _reject_reason IS NOT NULL) AS BIGINT) AS rows_rejected
FROM classified"""),
    "csv_blocks": """WITH t AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS line, l_orderkey,
    l_returnflag || CASE WHEN l_orderkey % 3 = 0 THEN repeat('x' || chr(10) || '"y", ', CAST(l_linenumber % 4 AS INTEGER)) ELSE '' END AS note
  FROM lineitem)
SELECT line, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected, CAST(SUM(l_orderkey) AS BIGINT) AS sum_order_key,
  CAST(SUM(LENGTH(note)) AS BIGINT) AS note_length, COUNT(*) FILTER (WHERE contains(note, chr(10))) AS n_broken_notes
FROM t GROUP BY line""",
    "null_tokens": """SELECT event_id, raw_text,
  CASE WHEN raw_text IN ('NULL', 'null', '') THEN NULL ELSE raw_text END AS quake_value,
  raw_text AS rig_value
FROM (SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE event_type END AS raw_text
  FROM events) t""",
    "lookup_join": with_([RAW_COUNTIES, STATE_CODES], """SELECT c."NAME" AS name, c."STATE" AS state, sc.state_full
FROM raw_counties c JOIN state_codes sc ON c."STATE" = sc.state_abbrev"""),
    "agg_to_agg_join": with_(WEEKLY_CHAIN, """SELECT state, year, event_week_num,
  CAST(total_rigs AS BIGINT) AS total_rigs, CAST(total_earthquakes AS BIGINT) AS total_earthquakes,
  round(avg_magnitude, 9) AS avg_magnitude FROM combined_data"""),
    "nearest_place": _nearest_sql(False),
    "nearest_place_nulls": _nearest_sql(True),
    "nearest_place_repeated_ids": _attached_sql("CASE WHEN k % 3 <> 0 THEN CAST(k % 5 AS VARCHAR) END", "FALSE"),
    "nearest_place_bad_coords": _attached_sql(
        "id", "(k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 OR k % 23 = 0 OR k % 29 = 0 OR k % 31 = 0)"
    ),
    "sum_by_group": with_(RIG_CHAIN, """SELECT state_or_province, CAST(SUM(rig_count) AS BIGINT) AS total_rigs
FROM silver_rig_counts GROUP BY state_or_province"""),
    "count_by_group": with_(QUAKE_CHAIN, """SELECT state, county, CAST(COUNT(*) AS BIGINT) AS total_earthquakes
FROM silver_earthquake GROUP BY state, county"""),
    "distinct_dates": with_(RIG_CHAIN, """SELECT state_or_province, CAST(COUNT(DISTINCT date) AS BIGINT) AS active_days
FROM silver_rig_counts GROUP BY state_or_province"""),
    "distinct_days": with_(QUAKE_CHAIN, """SELECT state, CAST(COUNT(DISTINCT CAST(event_time AS DATE)) AS BIGINT) AS active_days
FROM silver_earthquake GROUP BY state"""),
    "distinct_timestamps": with_(QUAKE_CHAIN, """SELECT state, county, CAST(COUNT(DISTINCT event_time) AS BIGINT) AS active_days
FROM silver_earthquake GROUP BY state, county"""),
    "count_if_by_group": with_(QUAKE_CHAIN, """SELECT state, event_year, event_week_num,
  CAST(COALESCE(COUNT_IF(magnitude >= 3.0), 0) AS BIGINT) AS significant_events
FROM silver_earthquake GROUP BY state, event_year, event_week_num"""),
    "sum_case": with_(QUAKE_CHAIN, """SELECT state, county,
  CAST(SUM(CASE WHEN magnitude >= 4.0 THEN 1 ELSE 0 END) AS BIGINT) AS significant_quakes
FROM silver_earthquake GROUP BY state, county"""),
    "avg_by_group": with_(RIG_CHAIN, """SELECT state_or_province, county, AVG(rig_count) AS avg_daily_rigs
FROM silver_rig_counts GROUP BY state_or_province, county"""),
    "max_by_group": with_(QUAKE_CHAIN, """SELECT state, MAX(magnitude) AS max_magnitude
FROM silver_earthquake GROUP BY state"""),
    "weekly_activity": with_(QUAKE_CHAIN + [QUAKE_WEEKLY], """SELECT state, year, event_week_num,
  CAST(total_earthquakes AS BIGINT) AS total_earthquakes, CAST(active_days AS BIGINT) AS active_days,
  round(avg_magnitude, 9) AS avg_magnitude, max_magnitude,
  CAST(significant_events AS BIGINT) AS significant_events,
  round(avg_significance, 9) AS avg_significance
FROM earthquake_by_state"""),
    "rig_weekly": with_(RIG_CHAIN + [RIG_WEEKLY], """SELECT state, year, event_week_num,
  CAST(total_rigs AS BIGINT) AS total_rigs, CAST(active_days AS BIGINT) AS active_days,
  avg_daily_rigs, CAST(peak_rigs AS BIGINT) AS peak_rigs
FROM rig_by_state"""),
    "mean_of_means": with_(WEEKLY_CHAIN, """SELECT state, round(AVG(avg_magnitude), 9) AS avg_earthquake_magnitude
FROM combined_data GROUP BY state"""),
    "rank_over_aggregates": with_(RIG_CHAIN + [STATE_RANKINGS], """SELECT state, county,
  CAST(peak_rig_rank AS BIGINT) AS peak_rig_rank, CAST(total_rig_rank AS BIGINT) AS total_rig_rank,
  CAST(avg_rig_rank AS BIGINT) AS avg_rig_rank FROM state_rankings"""),
    "multi_metric_rank": with_(QUAKE_CHAIN + [EARTHQUAKE_ANALYSIS], """SELECT state, county,
  CAST(RANK() OVER (ORDER BY total_earthquakes DESC NULLS FIRST) AS BIGINT) AS rank_by_frequency,
  CAST(RANK() OVER (ORDER BY max_magnitude DESC NULLS FIRST) AS BIGINT) AS rank_by_max_magnitude,
  CAST(RANK() OVER (ORDER BY significant_quakes DESC NULLS FIRST) AS BIGINT) AS rank_by_significant_quakes
FROM earthquake_analysis"""),
    "row_position": with_(WEEKLY_CHAIN + [GOLD_STATE], """SELECT state,
  CAST(total_rigs_count AS BIGINT) AS total_rigs_count, CAST(rig_rank AS BIGINT) AS rig_rank,
  CAST(rig_position AS BIGINT) AS rig_position FROM gold_state"""),
    "upper_text": "SELECT c_custkey, upper(lower(c_name)) AS name_upper FROM customer",
    "date_parts": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
  TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day_from_text,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(week(CAST(o_orderdate AS DATE)) AS INTEGER) AS iso_week
FROM orders""",
    "null_default": with_([RAW_QUAKES], "SELECT id, COALESCE(magnitude, 0.0) AS magnitude FROM raw_quakes"),
    "epoch_millis": """SELECT event_id, ms,
  CASE WHEN ms IS NULL OR ms = 0 THEN NULL ELSE epoch_ms(ms) END AS event_time
FROM (SELECT event_id,
  CAST(CASE event_id % 13 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE epoch_us(ts) // 1000 END AS BIGINT) AS ms
  FROM events) t""",
    "safe_index": """SELECT vec_id,
  CAST(coords[1] AS DOUBLE) AS longitude, CAST(coords[2] AS DOUBLE) AS latitude,
  CAST(coords[3] AS DOUBLE) AS elevation
FROM (SELECT vec_id, embedding[1:(vec_id % 4)] AS coords FROM embeddings) e""",
    "last_token": with_([LAST_TOKEN_TEXT], f"""SELECT c_custkey, place,
  {_strip("string_split(place, ',')[-1]")} AS state_code FROM texts"""),
    "feature_flatten": _FEATURE_FLATTEN,
    "sheet_parse": """SELECT line, reason,
  CASE WHEN reason IS NULL THEN county END AS county,
  CASE WHEN reason IS NULL THEN 'Basin\\' END AS basin,
  CASE WHEN reason IS NULL THEN rig_count END AS rig_count
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line,
  CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 THEN 'malformed' WHEN l_orderkey % 7 = 0 THEN 'bad_value:Rig Count Value' END AS reason,
  CASE l_orderkey % 5 WHEN 0 THEN 'Har "X" ris, co' WHEN 1 THEN '' ELSE 'C' || CAST(l_orderkey AS VARCHAR) END AS county,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS rig_count
FROM lineitem) t""",
    "explode_nested": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "explode_array": """SELECT vec_id, CAST(UNNEST(range(len(embedding))) AS BIGINT) AS pos,
  CAST(UNNEST(embedding) AS DOUBLE) AS value FROM embeddings""",
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "dq_not_null": with_([RAW_QUAKES], _not_null_sql("raw_quakes", [
        "id", "magnitude", "time", "longitude", "latitude", "ingestion_timestamp", "data_source", "region"])),
    "dq_unique": with_([RAW_QUAKES], _unique_sql("raw_quakes", ["id", "place", "sig"])),
    "dq_freshness": """SELECT table_name, max_loaded_at,
  CAST(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max_loaded_at)) / 1000000) AS BIGINT) AS age_seconds,
  CASE WHEN max_loaded_at IS NULL THEN 'error'
       WHEN (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max_loaded_at)) / 1000000 <= 86400 THEN 'pass'
       WHEN (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max_loaded_at)) / 1000000 <= 172800 THEN 'warn'
       ELSE 'error' END AS status
FROM (SELECT 'user_' || CAST(user_id AS VARCHAR) AS table_name, max(ts) AS max_loaded_at FROM events GROUP BY user_id) t""",
})
ORACLE["ordered_marts"] = f"""SELECT state, county, peak_rig_rank, total_rig_rank,
  CAST(ROW_NUMBER() OVER (ORDER BY peak_rig_rank, total_rig_rank, state, county) AS BIGINT) AS position
FROM ({ORACLE["state_rig_count"]}) m"""
