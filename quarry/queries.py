"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / model, all reading the driver's test tables in full.

The matching SQL lives in ``quarry.oracle.ORACLE`` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import functions as QF
from quarry.config import FIXED_CONTEXT
from quarry.operators import aggregates as AG
from quarry.operators import filters, joins, nearest, projection, quality, validate
from quarry.plans import bronze, gold, silver
from quarry.sinks import writers
from quarry.schemas import QUAKE_EVENT, RIG_SHEET
from quarry.sources import adapters as A
from quarry.session import ensure_checkpoint_dir
from quarry.sources import delimited, geojson, sheet
from quarry.sources.nulls import QUAKE_NULL_TOKENS, RIG_NULL_TOKENS

Query = Callable[[SparkSession, str], DataFrame]

CTX = FIXED_CONTEXT

# Means of measured magnitudes are compared to this many decimals: the
# summation order of a distributed average shows in the last digits.
MEAN_DECIMALS = 9


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, MEAN_DECIMALS) for c in cols})


def silver_rigs(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_rig_counts(bronze.bronze_rig_count(A.raw_rigs(spark, d)), CTX)


def silver_quakes(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_earthquake(A.raw_quakes(spark, d), CTX)


def q_gold_agg_rig_earthquake(spark, d):
    mart = gold.gold_agg_rig_earthquake(silver_rigs(spark, d), silver_quakes(spark, d), CTX.thresholds)
    return _rounded(mart, "avg_earthquake_magnitude")


def q_state_rig_count(spark, d):
    return gold.state_rig_count(silver_rigs(spark, d))


def q_earthquake_ranking(spark, d):
    return _rounded(gold.earthquake_ranking(silver_quakes(spark, d), CTX.thresholds), "avg_magnitude")


def q_silver_rig_counts(spark, d):
    return silver_rigs(spark, d)


def q_silver_earthquake(spark, d):
    return silver_quakes(spark, d)


def q_silver_counties(spark, d):
    return silver.silver_counties(bronze.bronze_county(A.raw_counties(spark, d)), A.state_codes(spark, d), CTX)


def q_silver_earthquake_with_location(spark, d):
    return silver.silver_earthquake_with_location(bronze.bronze_rig_earthquake(A.raw_quakes(spark, d)), CTX)


def q_bronze_rig_count(spark, d):
    return bronze.bronze_rig_count(A.raw_rigs(spark, d))


def q_bronze_county(spark, d):
    return bronze.bronze_county(A.raw_counties(spark, d))


def q_bronze_rig_earthquake(spark, d):
    return bronze.bronze_rig_earthquake(A.raw_quakes(spark, d))


# --------------------------------------------------------------------------
# Single operators. Where a test table has no NULLs / bad values, they are
# made with a CASE on the row key, identically in the oracle SQL.

AS_OF_WINDOW = dt.date(2024, 1, 20)
FRESHNESS_AS_OF = dt.datetime(2024, 1, 31, 12, 0, 0)
EPOCH = dt.datetime(1970, 1, 1)


def _key(df_col="id"):
    return F.col(df_col).cast("bigint")


def q_passthrough(spark, d):
    return projection.passthrough(A.table(spark, d, "customer"))


def q_rename_project(spark, d):
    return projection.rename_columns(A.raw_quakes(spark, d), {
        "id": "id", "magType": "magnitude_type", "sig": "significance", "time": "event_time", "region": "country",
    })


def _quakes_with_gaps(spark, d, nan: bool = False):
    raw = A.raw_quakes(spark, d)
    k = _key()
    mag = F.col("magnitude")
    if nan:
        mag = F.when(k % 83 == 0, F.lit(float("nan"))).otherwise(mag)
    return raw.select(
        F.when(k % 67 == 0, F.lit(None)).otherwise(F.col("id")).alias("id"),
        F.when(k % 71 == 0, F.lit(None)).otherwise(F.col("time")).alias("time"),
        mag.alias("magnitude"),
        F.col("place"),
        k.alias("row_key"),
    )


def q_required_fields(spark, d):
    return filters.required_fields(_quakes_with_gaps(spark, d), ["id", "time", "magnitude"])


def q_required_fields_nan(spark, d):
    return filters.required_fields(_quakes_with_gaps(spark, d, nan=True), ["id", "time", "magnitude"], nan_is_missing=True)


def q_normalized_equality(spark, d):
    kept = filters.normalized_equals(A.raw_rigs(spark, d), "Country", "UNITED STATES")
    return projection.rename_columns(kept, {
        "Country": "country", "State/Province": "state", "US_PublishDate": "publish_date", "Rig Count Value": "rig_count",
    })


def q_audit_columns(spark, d):
    return A.table(spark, d, "orders").select("o_orderkey", *silver.audit_columns(CTX))


def q_time_window_filter(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    return filters.last_days(ev, "ts", AS_OF_WINDOW, filters.EVENT_LOOKBACK_DAYS)


def q_bbox_filter(spark, d):
    o = A.table(spark, d, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    pts = o.select(
        "o_orderkey",
        A.spread(k, A.EVENT_LAT_FACTOR, 18000, -90.0).alias("latitude"),
        A.spread(k, A.EVENT_LON_FACTOR, 36000, -180.0).alias("longitude"),
    )
    return filters.bbox(pts, "latitude", "longitude", **filters.US_BBOX)


def q_stamp_metadata(spark, d):
    ev = A.table(spark, d, "events")
    return writers.stamp_metadata(ev, {
        "data_source": A.QUAKE_SOURCE,
        "api_url": A.QUAKE_API_URL,
        "data_period_start": AS_OF_WINDOW - dt.timedelta(days=filters.EVENT_LOOKBACK_DAYS),
        "data_period_end": AS_OF_WINDOW,
        "region": "USA",
    }, loaded_at=A.INGESTED_AT)


CAST_SCHEMA = T.StructType([
    T.StructField("quantity", T.LongType()),
    T.StructField("ship_date", T.DateType()),
    T.StructField("flag", T.StringType()),
])


def _lineitem_text(spark, d):
    li = A.table(spark, d, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 67 == 0, F.lit(None).cast("string"))
        .when(k % 53 == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("quantity"),
        F.when(k % 59 == 0, F.lit("1996-02-30"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship_date"),
        F.when(k % 61 == 0, F.repeat(F.lit("x"), 501)).otherwise(F.col("l_returnflag")).alias("flag"),
    )


def q_lenient_cast_split(spark, d):
    return validate.classify(_lineitem_text(spark, d), CAST_SCHEMA)


def q_load_audit(spark, d):
    return writers.load_counts(validate.classify(_lineitem_text(spark, d), CAST_SCHEMA))


def q_csv_blocks(spark, d):
    """lineitem as one quoted text extract with line breaks in its notes, read back by blocks."""
    li = A.table(spark, d, "lineitem")
    breaks = F.repeat(F.lit('x\n"y", '), (F.col("l_linenumber") % 4).cast("int"))
    note = F.concat(F.col("l_returnflag"), F.when(F.col("l_orderkey") % 3 == 0, breaks).otherwise(F.lit("")))
    text = li.select(F.col("l_orderkey").cast("string").alias("order_key"), F.col("l_linenumber").cast("string").alias("line"), note.alias("note"))
    path = f"{ensure_checkpoint_dir(spark)}/extract-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    writers.write_quoted_csv(text, path)
    schema = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("line", T.IntegerType()), T.StructField("note", T.StringType())])
    rows = validate.classify(delimited.read_text_columns(spark, path, schema, blocks=True), schema, corrupt_col=delimited.CORRUPT)
    return rows.groupBy("line").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(validate.REASON).isNotNull()).alias("n_rejected"),
        F.sum(F.col("order_key").cast("bigint")).alias("sum_order_key"),
        F.sum(F.length("note")).alias("note_length"),
        F.count_if(F.contains("note", F.lit("\n"))).alias("n_broken_notes"),
    )


def q_null_tokens(spark, d):
    ev = A.table(spark, d, "events")
    k = F.col("event_id") % 7
    raw = (
        F.when(k == 0, F.lit("NULL")).when(k == 1, F.lit("null")).when(k == 2, F.lit(""))
        .when(k == 3, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    )
    t = ev.select("event_id", raw.alias("raw_text"))
    return t.select(
        "event_id", "raw_text",
        QF.null_tokens("raw_text", QUAKE_NULL_TOKENS).alias("quake_value"),
        QF.null_tokens("raw_text", RIG_NULL_TOKENS).alias("rig_value"),
    )


def q_lookup_join(spark, d):
    c = A.raw_counties(spark, d).alias("c")
    sc = A.state_codes(spark, d).alias("sc")
    j = joins.lookup_join(c, sc, F.col("c.STATE") == F.col("sc.state_abbrev"))
    return j.select(F.col("c.NAME").alias("name"), F.col("c.STATE").alias("state"), F.col("sc.state_full").alias("state_full"))


def q_agg_to_agg_join(spark, d):
    w = gold.weekly_activity(silver_rigs(spark, d), silver_quakes(spark, d), CTX.thresholds)
    return w.withColumn("avg_magnitude", F.round("avg_magnitude", MEAN_DECIMALS))


def _located(spark, d, null_coords: bool):
    ev = A.raw_quakes(spark, d).select("id", "latitude", "longitude")
    if null_coords:
        ev = ev.withColumn("latitude", F.when(_key() % 31 == 0, F.lit(None)).otherwise(F.col("latitude")))
    places = A.raw_counties(spark, d)
    out = nearest.locate(
        ev, places, {"NAME": "county", "STATE": "state"},
        place_id="OBJECTID", place_lat="LATITUDE", place_lon="LONGITUDE",
    )
    return out.select(
        F.col("id"), F.col("OBJECTID").alias("place_id"), "county", "state",
        F.col("distance_km"),
    )


def q_nearest_place(spark, d):
    return _located(spark, d, null_coords=False)


def q_nearest_place_nulls(spark, d):
    return _located(spark, d, null_coords=True)


def _attached(spark, d, ev):
    """Event rows with their nearest place, no id involved."""
    places = A.raw_counties(spark, d)
    return nearest.attach_nearest(ev, places, {"NAME": "county"}, place_id="OBJECTID", place_lat="LATITUDE", place_lon="LONGITUDE").select(
        "row_key", "id", F.col("OBJECTID").alias("place_id"), "county", "distance_km"
    )


def q_nearest_place_repeated_ids(spark, d):
    ev = A.raw_quakes(spark, d).select(
        _key().alias("row_key"), F.when(_key() % 3 != 0, (_key() % 5).cast("string")).alias("id"), "latitude", "longitude"
    )
    return _attached(spark, d, ev)


def q_nearest_place_bad_coords(spark, d):
    k = _key()
    ev = A.raw_quakes(spark, d).select(
        k.alias("row_key"), "id",
        F.when(k % 13 == 0, F.lit("1e12")).when(k % 17 == 0, F.lit("north")).when(k % 19 == 0, F.lit("Infinity")).otherwise(F.col("latitude").cast("string")).alias("latitude"),
        F.when(k % 23 == 0, F.lit("-Infinity")).when(k % 29 == 0, F.lit("NaN")).when(k % 31 == 0, F.lit("180.5")).otherwise(F.col("longitude").cast("string")).alias("longitude"),
    )
    return _attached(spark, d, ev)


def q_sum_by_group(spark, d):
    return AG.grouped(silver_rigs(spark, d), ["state_or_province"], {"total_rigs": F.sum("rig_count")})


def q_count_by_group(spark, d):
    return AG.grouped(silver_quakes(spark, d), ["state", "county"], {"total_earthquakes": AG.count_rows()})


def q_distinct_dates(spark, d):
    return AG.grouped(silver_rigs(spark, d), ["state_or_province"], {"active_days": AG.exact_distinct("date")})


def q_distinct_days(spark, d):
    return AG.grouped(silver_quakes(spark, d), ["state"], {"active_days": AG.exact_distinct(QF.to_day("event_time"))})


def q_distinct_timestamps(spark, d):
    return AG.grouped(silver_quakes(spark, d), ["state", "county"], {"active_days": AG.exact_distinct("event_time")})


def q_count_if_by_group(spark, d):
    return AG.grouped(
        silver_quakes(spark, d), ["state", "event_year", "event_week_num"],
        {"significant_events": AG.count_when(F.col("magnitude") >= CTX.thresholds.weekly_significant)},
    )


def q_sum_case(spark, d):
    return AG.grouped(
        silver_quakes(spark, d), ["state", "county"],
        {"significant_quakes": AG.sum_when(F.col("magnitude") >= CTX.thresholds.ranking_significant).cast("bigint")},
    )


def q_avg_by_group(spark, d):
    return AG.grouped(silver_rigs(spark, d), ["state_or_province", "county"], {"avg_daily_rigs": F.avg("rig_count")})


def q_max_by_group(spark, d):
    return AG.grouped(silver_quakes(spark, d), ["state"], {"max_magnitude": F.max("magnitude")})


def q_weekly_activity(spark, d):
    w = gold.quake_weekly(silver_quakes(spark, d), CTX.thresholds)
    return w.select(
        "state", "year", "event_week_num", "total_earthquakes", "active_days",
        F.round("avg_magnitude", MEAN_DECIMALS).alias("avg_magnitude"),
        "max_magnitude", "significant_events",
        F.round("avg_significance", MEAN_DECIMALS).alias("avg_significance"),
    )


def q_rig_weekly(spark, d):
    return gold.rig_weekly(silver_rigs(spark, d))


def q_mean_of_means(spark, d):
    w = gold.weekly_activity(silver_rigs(spark, d), silver_quakes(spark, d), CTX.thresholds)
    return w.groupBy("state").agg(F.round(F.avg("avg_magnitude"), MEAN_DECIMALS).alias("avg_earthquake_magnitude"))


def q_rank_over_aggregates(spark, d):
    return q_state_rig_count(spark, d).select("state", "county", "peak_rig_rank", "total_rig_rank", "avg_rig_rank")


def q_multi_metric_rank(spark, d):
    return q_earthquake_ranking(spark, d).select(
        "state", "county", "rank_by_frequency", "rank_by_max_magnitude", "rank_by_significant_quakes"
    )


def q_row_position(spark, d):
    return q_gold_agg_rig_earthquake(spark, d).select("state", "total_rigs_count", "rig_rank", "rig_position")


def q_ordered_marts(spark, d):
    """The mart as its table is read back row by row: the number of each row
    in the order the mart comes in."""
    ordered = q_state_rig_count(spark, d).select("state", "county", "peak_rig_rank", "total_rig_rank")
    return ordered.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "position", F.row_number().over(Window.orderBy("place")).cast("bigint")
    ).drop("place")


def q_upper_text(spark, d):
    c = A.table(spark, d, "customer")
    return c.select("c_custkey", QF.upper_text(F.lower(F.col("c_name"))).alias("name_upper"))


def q_date_parts(spark, d):
    o = A.table(spark, d, "orders")
    day = QF.to_day("o_orderdate")
    return o.select(
        "o_orderkey",
        day.alias("day"),
        QF.text_to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_from_text"),
        QF.calendar_year(day).alias("year"),
        QF.calendar_month(day).alias("month"),
        QF.iso_week(day).alias("iso_week"),
    )


def q_null_default(spark, d):
    return A.raw_quakes(spark, d).select("id", QF.null_default("magnitude", 0.0).alias("magnitude"))


def q_epoch_millis(spark, d):
    ev = A.table(spark, d, "events")
    k = F.col("event_id") % 13
    ms = F.when(k == 0, F.lit(0)).when(k == 1, F.lit(None)).otherwise(
        F.timestamp_diff("MILLISECOND", QF.lit_ntz(EPOCH), F.col("ts"))
    ).cast("bigint")
    t = ev.select("event_id", ms.alias("ms"))
    return t.select("event_id", "ms", QF.epoch_millis_to_ntz("ms").alias("event_time"))


def q_safe_index(spark, d):
    e = A.table(spark, d, "embeddings")
    coords = F.slice("embedding", 1, (F.col("vec_id") % 4).cast("int"))
    return e.select(
        "vec_id",
        QF.safe_index(coords, 0).cast("double").alias("longitude"),
        QF.safe_index(coords, 1).cast("double").alias("latitude"),
        QF.safe_index(coords, 2).cast("double").alias("elevation"),
    )


def q_last_token(spark, d):
    c = A.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = A.table(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(joins.bounded_broadcast(n), c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey") % 5
    text = (
        F.when(k == 0, F.col("c_name"))
        .when(k == 1, F.concat(F.col("c_name"), F.lit(",")))
        .when(k == 2, F.concat(F.col("c_name"), F.lit(",\t"), F.col("n_name"), F.lit(" ")))
        .when(k == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")))
    )
    t = j.select("c_custkey", text.alias("place"))
    return t.select("c_custkey", "place", QF.last_token("place").alias("state_code"))


def q_feature_flatten(spark, d):
    """Feed features, built from orders as the reader gives them, flattened
    and checked like a load."""
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    k, text = F.col("o_orderkey"), lambda c: c.cast("string")
    millis = F.timestamp_diff("MILLISECOND", QF.lit_ntz(EPOCH), F.col("o_orderdate").cast("timestamp_ntz"))
    time = F.when(k % 13 == 0, F.lit("noon")).when(k % 17 == 0, F.lit("0")).otherwise(text(millis))
    coords = F.slice(F.array(text(k % 360), text(k % 90), text(k % 700)), 1, (k % 4).cast("int"))
    props = {
        "mag": F.when(k % 11 == 0, F.lit("abc")).otherwise(text(F.col("o_custkey"))),
        "place": F.when(k % 7 != 0, F.col("o_orderpriority")),
        "time": time, "updated": time, "sig": text(F.col("o_custkey") % 1000),
    }
    fields = geojson.FEATURE["properties"].dataType.names
    feature = F.struct(
        text(k).alias("id"),
        F.struct(*[props.get(n, F.lit(None).cast("string")).alias(n) for n in fields]).alias("properties"),
        F.struct(coords.alias("coordinates")).alias("geometry"),
    )
    flat = geojson.flatten_features(o.select(feature.alias("f"), F.lit(None).cast("string").alias(geojson.CORRUPT)))
    rule = T.StructType([f for f in QUAKE_EVENT.fields if f.name in flat.columns])
    return validate.classify(flat, rule, corrupt_col=geojson.CORRUPT).select(
        "id", "magnitude", "place", "time", "sig", "longitude", "latitude", "elevation", F.col(validate.REASON).alias("reason")
    )


def q_sheet_parse(spark, d):
    """Sheet lines, built from lineitem, parsed by position and checked:
    doubled quotes, commas in quotes, empty and missing fields."""
    li = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    k = F.col("l_orderkey")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    county = F.when(k % 5 == 0, F.lit('Har "X" ris, co')).when(k % 5 == 1, F.lit("")).otherwise(F.concat(F.lit("C"), k.cast("string")))
    count = F.when(k % 7 == 0, F.lit("many")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    cells = [F.lit("United States"), county, F.lit("Basin\\"), F.lit("N"), F.col("l_returnflag"), F.lit("Land"), F.lit("TEXAS"), F.lit("H"),
             F.lit("2024"), F.lit("1"), F.lit("2024-01-05"), count]
    line = F.concat_ws(",", *[quoted(c) for c in cells[:11]])
    line = F.when(k % 11 == 0, line).when(k % 13 == 0, F.concat(line, F.lit(',"1","2"'))).otherwise(F.concat(line, F.lit(","), quoted(cells[11])))
    lines = li.select(line.alias("value"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("file_path"))
    parsed = validate.classify(sheet.parse_positional(lines), RIG_SHEET, corrupt_col="_corrupt_record")
    good = F.col(validate.REASON).isNull()
    return parsed.select(
        F.col("file_path").alias("line"), F.col(validate.REASON).alias("reason"),
        *[F.when(good, F.col(f"`{c}`")).alias(a) for c, a in (("County", "county"), ("Basin", "basin"), ("Rig Count Value", "rig_count"))],
    )


def q_explode_nested(spark, d):
    """A nested JSON field by path (NULL when the key is missing)."""
    ev = A.table(spark, d, "events").select("event_id", "props")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def q_explode_array(spark, d):
    e = A.table(spark, d, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), F.col("value").cast("double").alias("value")
    )


def q_json_field(spark, d):
    ev = A.table(spark, d, "events").select("event_id", "props")
    parsed = F.from_json("props", "k BIGINT")
    return ev.select("event_id", parsed.getField("k").alias("k"))


DQ_NOT_NULL_COLUMNS = ["id", "magnitude", "time", "longitude", "latitude", "ingestion_timestamp", "data_source", "region"]


def q_dq_not_null(spark, d):
    return quality.not_null(A.raw_quakes(spark, d), "raw_quakes", DQ_NOT_NULL_COLUMNS)


def q_dq_unique(spark, d):
    raw = A.raw_quakes(spark, d)
    return quality.unique_many(raw, "raw_quakes", ["id", "place", "sig"])


def q_dq_freshness(spark, d):
    ev = A.table(spark, d, "events")
    src = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return quality.freshness_by(ev, src, "ts", FRESHNESS_AS_OF)


QUERIES: dict[str, Query] = {
    "gold_agg_rig_earthquake": q_gold_agg_rig_earthquake,
    "state_rig_count": q_state_rig_count,
    "earthquake_ranking": q_earthquake_ranking,
    "silver_rig_counts": q_silver_rig_counts,
    "silver_earthquake": q_silver_earthquake,
    "silver_counties": q_silver_counties,
    "silver_earthquake_with_location": q_silver_earthquake_with_location,
    "bronze_rig_count": q_bronze_rig_count,
    "bronze_county": q_bronze_county,
    "bronze_rig_earthquake": q_bronze_rig_earthquake,
    "passthrough": q_passthrough,
    "rename_project": q_rename_project,
    "required_fields": q_required_fields,
    "required_fields_nan": q_required_fields_nan,
    "normalized_equality": q_normalized_equality,
    "audit_columns": q_audit_columns,
    "time_window_filter": q_time_window_filter,
    "bbox_filter": q_bbox_filter,
    "stamp_metadata": q_stamp_metadata,
    "lenient_cast_split": q_lenient_cast_split,
    "load_audit": q_load_audit,
    "csv_blocks": q_csv_blocks,
    "null_tokens": q_null_tokens,
    "lookup_join": q_lookup_join,
    "agg_to_agg_join": q_agg_to_agg_join,
    "nearest_place": q_nearest_place,
    "nearest_place_nulls": q_nearest_place_nulls,
    "nearest_place_repeated_ids": q_nearest_place_repeated_ids,
    "nearest_place_bad_coords": q_nearest_place_bad_coords,
    "sum_by_group": q_sum_by_group,
    "count_by_group": q_count_by_group,
    "distinct_dates": q_distinct_dates,
    "distinct_days": q_distinct_days,
    "distinct_timestamps": q_distinct_timestamps,
    "count_if_by_group": q_count_if_by_group,
    "sum_case": q_sum_case,
    "avg_by_group": q_avg_by_group,
    "max_by_group": q_max_by_group,
    "weekly_activity": q_weekly_activity,
    "rig_weekly": q_rig_weekly,
    "mean_of_means": q_mean_of_means,
    "rank_over_aggregates": q_rank_over_aggregates,
    "multi_metric_rank": q_multi_metric_rank,
    "row_position": q_row_position,
    "ordered_marts": q_ordered_marts,
    "upper_text": q_upper_text,
    "date_parts": q_date_parts,
    "null_default": q_null_default,
    "epoch_millis": q_epoch_millis,
    "safe_index": q_safe_index,
    "last_token": q_last_token,
    "feature_flatten": q_feature_flatten,
    "sheet_parse": q_sheet_parse,
    "explode_nested": q_explode_nested,
    "explode_array": q_explode_array,
    "json_field": q_json_field,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_freshness": q_dq_freshness,
}
