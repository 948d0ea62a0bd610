import datetime as dt
import json
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from quarry import schemas as S
from quarry.config import Namespaces, RunContext
from quarry.operators import filters, quality
from quarry.plans import checks, loads, pipeline
from quarry.plans.materialize import Warehouse
from quarry.sinks import key_table, writers
from quarry.streaming.incremental import append_batches, load_new_counties, load_new_features, load_new_files, load_new_sheets

CTX = RunContext(run_id="run-1", loaded_at=dt.datetime(2024, 1, 10, 6, 0))

COUNTIES = [
    # X, Y, OBJECTID_1, OBJECTID, NAME, STATE, STATE_FIPS_CD, COUNTY_FIPS_CD, FIPS_CD, POPULATION, POP_SQMI, SQMI, DHCS, LAT, LON
    (-95.4, 29.8, 1, 1, "Harris", "TX", 48, 201, 48201, 4700000, 2600.0, 1777.0, "", 29.8, -95.4),
    (-118.2, 34.3, 2, 2, "Los Angeles", "CA", 6, 37, 6037, 10000000, 2500.0, 4058.0, "", 34.3, -118.2),
    (-97.5, 35.5, 3, 3, "Oklahoma", "OK", 40, 109, 40109, 800000, 1100.0, 718.0, "", 35.5, -97.5),
    (-66.1, 18.4, 4, 4, "San Juan", "PR", 72, 127, 72127, 340000, 7000.0, 47.0, "", 18.4, -66.1),
]

RIG_HEADER = ",".join(f'"{c}"' for c in S.RIG_SHEET_COLUMNS)


def _write_inputs(tmp, n_quakes=6):
    counties = os.path.join(tmp, "counties.csv")
    with open(counties, "w") as f:
        f.write(",".join(f.name for f in S.COUNTY_FILE.fields) + "\n")
        for r in COUNTIES:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")
    rigs = os.path.join(tmp, "rigs.csv")
    with open(rigs, "w") as f:
        for i in range(10):
            f.write(f"preamble {i}\n")
        f.write(RIG_HEADER + "\n")
        rows = [
            ("United States", "Harris", "Gulf", "N", "Oil", "Land", "TEXAS", "H", 2024, 1, "2024-01-03", 10),
            ("United States", "Harris", "Gulf", "N", "Gas", "Land", "TEXAS", "V", 2024, 1, "2024-01-03", 5),
            ("United States", "Oklahoma", "Ana", "N", "Oil", "Land", "OKLAHOMA", "H", 2024, 1, "2024-01-03", 7),
            ("Canada", "Alberta", "W", "N", "Oil", "Land", "ALBERTA", "H", 2024, 1, "2024-01-03", 99),
            ("United States", "Harris", "Gulf", "N", "Oil", "Land", "TEXAS", "H", 2024, 1, "2024-01-03", "many"),
        ]
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")
    quakes = os.path.join(tmp, "quakes.geojson")
    base = int(dt.datetime(2024, 1, 2, 12, 0).timestamp() * 1000)
    feats = []
    for i in range(n_quakes):
        lat, lon = (29.9, -95.3) if i % 2 == 0 else (35.4, -97.6)
        feats.append({"id": f"q{i}", "properties": {"mag": 2.0 + i, "place": f"near town {i}, XX", "time": base + i * 3600_000,
                                                   "sig": 10 * i, "magType": "ml"},
                      "geometry": {"coordinates": [lon, lat, 3.0]}})
    with open(quakes, "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)
    return pipeline.Inputs(rig_sheets=[rigs], quake_features=[quakes], county_csv=counties,
                           quarantine_dir=os.path.join(tmp, "quarantine"))


def _warehouse(spark):
    tag = uuid.uuid4().hex[:8]
    return Warehouse(spark, Namespaces(raw=f"raw_{tag}", bronze=f"bronze_{tag}", silver=f"silver_{tag}", gold=f"gold_{tag}"))


def test_whole_run(spark, tmp):
    wh = _warehouse(spark)
    res = pipeline.run(wh, _write_inputs(tmp), CTX)
    assert (res["rigs"].rows_in, res["rigs"].rows_loaded, res["rigs"].rows_rejected) == (5, 4, 1)
    assert res["quakes"].rows_loaded == 6 and res["counties"].rows_loaded == 4
    raw_q = wh.source(loads.QUAKE_TABLE)
    located = {r.id: (r.state, r.county, r.country_code) for r in raw_q.collect()}
    assert located["q0"] == ("TEXAS", "Harris", "US") and located["q1"] == ("OKLAHOMA", "Oklahoma", "US")
    gold = {r.state: r for r in wh.ref("gold", "gold_agg_rig_earthquake").collect()}
    assert set(gold) == {"TEXAS", "OKLAHOMA"}
    assert gold["TEXAS"].total_rigs_count == 15 and gold["TEXAS"].total_earthquake_count == 3
    assert gold["TEXAS"].rig_rank == 1 and gold["OKLAHOMA"].rig_position == 2
    src = wh.ref("gold", "state_rig_count").collect()
    assert {(r.state, r.county) for r in src} == {("TEXAS", "HARRIS"), ("OKLAHOMA", "OKLAHOMA")}
    counties = wh.ref("silver", "silver_counties").collect()
    assert sorted(r.state_name for r in counties) == ["CALIFORNIA", "OKLAHOMA", "TEXAS"]  # PR not in the seed
    # views vs tables, tags
    kinds = {t.name: t.tableType for t in spark.catalog.listTables(wh.ns.bronze)}
    assert kinds["bronze_rig_count"] == "VIEW"
    props = wh.properties("gold", "earthquake_ranking")
    assert props["tags"] == "gold,analytics" and props["layer"] == "gold"
    assert wh.properties("silver", "silver_earthquake")["tags"] == "silver,cleaned"
    assert all(t.description for t in spark.catalog.listTables(wh.ns.silver) + spark.catalog.listTables(wh.ns.gold))
    # quarantine keeps the rejected rig row
    q = spark.read.parquet(os.path.join(tmp, "quarantine", "rigs"))
    assert [r._reject_reason for r in q.collect()] == ["bad_value:Rig Count Value"]
    # the declared checks: 23 not-null + 2 unique, all passing on one clean load
    dq = checks.column_checks(wh).collect()
    assert len(dq) == 25 and {r.status for r in dq} == {"pass"}
    fresh = {r.table_name: r.status for r in checks.source_freshness(wh, CTX.loaded_at + dt.timedelta(hours=30)).collect()}
    assert fresh == {loads.RIG_TABLE: "warn", loads.QUAKE_TABLE: "warn", loads.COUNTY_TABLE: "warn"}


def test_append_twice_doubles_and_unique_fails(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs = _write_inputs(tmp)
    pipeline.run_loads(wh, inputs, CTX)
    pipeline.run_loads(wh, inputs, CTX)
    raw_q = wh.source(loads.QUAKE_TABLE)
    assert raw_q.count() == 12
    u = quality.unique(raw_q, "bronze_earthquake_raw", "id").collect()[0]
    assert (u.failures, u.status) == (6, "fail")
    nn = {r.column_name: r.failures for r in quality.not_null(raw_q, "q", ["id", "magnitude", "time"]).collect()}
    assert nn == {"id": 0, "magnitude": 0, "time": 0}


def test_empty_extract_leaves_table_untouched(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs = _write_inputs(tmp)
    pipeline.run_loads(wh, inputs, CTX)
    empty = os.path.join(tmp, "empty.geojson")
    with open(empty, "w") as f:
        json.dump({"type": "FeatureCollection", "features": []}, f)
    res = loads.load_quakes(wh, [empty], os.path.join(tmp, "q2"), CTX, count_table=True)
    assert (res.rows_in, res.table_rows) == (0, 6)


def test_incremental_load_only_new_files(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    name = wh.name("raw", "codes")
    writers.ensure_table(spark, name, S.STATE_CODE, by_load=True)
    drop = os.path.join(tmp, "drop")
    os.makedirs(drop)
    cp = os.path.join(tmp, "cp")

    def put(fname, rows):
        with open(os.path.join(drop, fname), "w") as f:
            f.write("state_abbrev,state_full\n")
            for a, b in rows:
                f.write(f"{a},{b}\n")

    def run():
        return load_new_files(spark, drop, S.STATE_CODE, cp, append_batches(name, lambda b: b, cp),
                              options={"header": "true"}, refresh_table=name)

    put("extract-1.csv", [("AA", "A"), ("BB", "B")])
    assert run() == 2
    assert run() == 0
    put("extract-2.csv", [("CC", "C")])
    assert run() == 1
    assert spark.table(name).count() == 3


def test_rig_refresh_load_replaces_rows_with_metadata(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs = _write_inputs(tmp)
    q = os.path.join(tmp, "q")
    loads.load_rigs(wh, inputs.rig_sheets, q, CTX)
    loads.load_rigs(wh, inputs.rig_sheets, q, CTX)
    assert wh.source(loads.RIG_TABLE).count() == 8
    res = loads.load_rigs(wh, inputs.rig_sheets, q, CTX, refresh=True)
    rows = wh.source(loads.RIG_TABLE).collect()
    assert res.rows_loaded == 4 and len(rows) == 4
    assert all(r.ingestion_timestamp == CTX.loaded_at and r.data_source == loads.RIG_SOURCE for r in rows)


def test_incremental_rig_sheets(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    src = _write_inputs(tmp).rig_sheets[0]
    drop = os.path.join(tmp, "rig_drop")
    os.makedirs(drop)
    cp, q = os.path.join(tmp, "rig_cp"), os.path.join(tmp, "rig_q")
    with open(src) as f:
        text = f.read()
    with open(os.path.join(drop, "2024-01-05.csv"), "w") as f:
        f.write(text)
    load_new_sheets(wh, drop, cp, q, CTX)
    assert wh.source(loads.RIG_TABLE).count() == 4          # 5 data lines, 1 quarantined
    load_new_sheets(wh, drop, cp, q, CTX)
    assert wh.source(loads.RIG_TABLE).count() == 4          # nothing new
    with open(os.path.join(drop, "2024-01-12.csv"), "w") as f:
        f.write(text)
    load_new_sheets(wh, drop, cp, q, CTX)
    assert wh.source(loads.RIG_TABLE).count() == 8


def test_command_line_run(tmp):
    import subprocess
    import sys
    inputs = _write_inputs(tmp)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "quarry", "--master", "local[2]", "--schema", f"cli_{uuid.uuid4().hex[:6]}",
           "run", "--rig-sheet", inputs.rig_sheets[0], "--quake-features", inputs.quake_features[0],
           "--county-csv", inputs.county_csv, "--quarantine", os.path.join(tmp, "q"), "--run-id", "cli",
           "--as-of", "2024-01-10", "--checks-as-of", "2024-01-10T07:00:00"]
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--conf spark.sql.warehouse.dir=" + os.path.join(tmp, "wh") + " pyspark-shell")
    out = subprocess.run(cmd, cwd=repo, capture_output=True, text=True, timeout=600, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [json.loads(x) for x in out.stdout.strip().splitlines() if x.startswith("{")]
    res = lines[0]
    assert res["rigs"]["rows_loaded"] == 4 and res["quakes"]["rows_loaded"] == 6
    checks_out = lines[1:]
    assert len(checks_out) == 25 + 3
    assert {c["status"] for c in checks_out[:25]} == {"pass"}


def test_incremental_event_features(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs = _write_inputs(tmp)
    pipeline.run_loads(wh, pipeline.Inputs(county_csv=inputs.county_csv,
                                           quarantine_dir=os.path.join(tmp, "q0")), CTX)
    places = pipeline.places(wh)
    drop = os.path.join(tmp, "event_drop")
    os.makedirs(drop)
    cp, q = os.path.join(tmp, "ev_cp"), os.path.join(tmp, "ev_q")

    def put(name, ids):
        with open(os.path.join(drop, name), "w") as f:
            for i in ids:
                f.write(json.dumps({"id": f"e{i}", "properties": {"mag": 1.0 + i, "time": 1704067200000 + i},
                                    "geometry": {"coordinates": [-95.3, 29.9, 1.0]}}) + "\n")

    put("day-1.jsonl", range(3))
    load_new_features(wh, drop, cp, q, CTX, places=places)
    load_new_features(wh, drop, cp, q, CTX, places=places)
    put("day-2.jsonl", range(3, 5))
    load_new_features(wh, drop, cp, q, CTX, places=places)
    rows = wh.source(loads.QUAKE_TABLE).collect()
    assert sorted(r.id for r in rows) == [f"e{i}" for i in range(5)]
    assert {(r.state, r.county) for r in rows} == {("TEXAS", "Harris")}


def test_event_extract_defaults_and_bounds(spark, tmp):
    """90 days up to the run's day and the fixed box, stamped on the rows."""
    wh = _warehouse(spark)
    wh.create_namespaces()
    feats = os.path.join(tmp, "f.jsonl")
    ms = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [("in", ms(2024, 1, 2), 30.0, -95.0), ("old", ms(2023, 10, 11), 30.0, -95.0), ("late", ms(2024, 1, 10, 1), 30.0, -95.0),
            ("north", ms(2024, 1, 2), 50.0, -95.0), ("west", ms(2024, 1, 2), 30.0, -126.0), ("edge", ms(2023, 10, 12), 24.6, -65.0)]
    with open(feats, "w") as f:
        for i, t, lat, lon in rows:
            f.write(json.dumps({"id": i, "properties": {"mag": 1.0, "time": t}, "geometry": {"coordinates": [lon, lat, 1]}}) + "\n")
    pipeline.run_loads(wh, pipeline.Inputs(quake_features=[feats], quake_lines=True, quarantine_dir=os.path.join(tmp, "q")), CTX)
    got = wh.source(loads.QUAKE_TABLE).collect()
    assert sorted(r.id for r in got) == ["edge", "in"]
    assert {(r.data_period_start, r.data_period_end) for r in got} == {(dt.date(2023, 10, 12), dt.date(2024, 1, 10))}


def test_broken_feeds_lose_nothing(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    lines = os.path.join(tmp, "f.jsonl")
    with open(lines, "w") as f:
        f.write('{"id": "a", "properties": {"mag": 1.5}}\n{"id": "b", "prop\n{"id": "c", "properties": {"mag": "abc"}}\n')
        f.write('{"id": "d", "properties": {"time": "noon"}, "geometry": {"coordinates": [1.5, 2.5]}}\n')
    q = os.path.join(tmp, "q")
    res = loads.load_quakes(wh, [lines], q, CTX, sequence=True)
    assert (res.rows_in, res.rows_loaded, res.rows_rejected) == (4, 1, 3)
    assert sorted(r._reject_reason for r in spark.read.parquet(q).collect()) == ["bad_value:magnitude", "bad_value:time", "malformed"]
    cut = os.path.join(tmp, "cut.geojson")
    with open(cut, "w") as f:
        f.write('{"type": "FeatureCollection", "features": [{"id": "x", "properties": {"mag": 1')
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        loads.load_quakes(wh, [cut], q, CTX)
    with open(cut, "w") as f:
        f.write('{"type": "error", "status": 503}')
    with pytest.raises(Exception, match="no features"):
        loads.load_quakes(wh, [cut], q, CTX)
    assert wh.source(loads.QUAKE_TABLE).count() == 1


def test_events_with_one_id_keep_their_rows(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    places = spark.createDataFrame([(1, 30.0, -95.0, "TEXAS", "Harris", "US"), (2, 35.0, -97.0, "OKLAHOMA", "Oklahoma", "US")],
                                   "place_id int, latitude double, longitude double, state string, county string, country_code string")
    feats = os.path.join(tmp, "f.jsonl")
    with open(feats, "w") as f:
        for i, (lon, lat) in ((1, (-95.1, 30.1)), (1, (-97.1, 35.1)), (None, (-95.0, 30.0)), (None, (200, 95))):
            f.write(json.dumps({"id": i and str(i), "geometry": {"coordinates": [lon, lat]}}) + "\n")
    res = loads.load_quakes(wh, [feats], os.path.join(tmp, "q"), CTX, places=places, sequence=True)
    assert res.rows_loaded == 4
    assert sorted(str((r.id, r.state, r.country_code)) for r in wh.source(loads.QUAKE_TABLE).collect()) == sorted(map(str, [
        ("1", "TEXAS", "US"), ("1", "OKLAHOMA", "US"), (None, "TEXAS", "US"), (None, None, None)]))


def test_replayed_batch_and_county_drops(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    raw = spark.createDataFrame([(*map(str, COUNTIES[0]), None), (*map(str, ("x", *COUNTIES[1][1:])), None)],
                                ", ".join(f"`{f.name}` string" for f in S.COUNTY_FILE.fields) + ", _corrupt_record string")
    batch = os.path.join(tmp, "q", "batch=0")
    first = loads.load_county_rows(wh, raw, batch, CTX, "drop", once=True)
    again = loads.load_county_rows(wh, raw, batch, CTX, "drop", once=True)
    assert (first.rows_loaded, first.rows_rejected, again.rows_in) == (1, 1, 0) and wh.source(loads.COUNTY_TABLE).count() == 1
    drop = os.path.join(tmp, "drop")
    os.makedirs(drop)
    src = _write_inputs(tmp).county_csv
    for k in range(2):
        with open(src) as f, open(os.path.join(drop, f"c{k}.csv"), "w") as g:
            g.write(f.read())
        load_new_counties(wh, drop, os.path.join(tmp, "cp"), os.path.join(tmp, "q2"), CTX)
        assert wh.source(loads.COUNTY_TABLE).count() == 1 + 4 * (k + 1)


def test_streams_share_a_quarantine_folder(spark, tmp):
    """Two feeds, and a new checkpoint after a reset: no stream's first batch
    is taken for one of another stream; a replay in the same stream is."""
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs, q = _write_inputs(tmp), os.path.join(tmp, "shared_q")
    drops = {k: os.path.join(tmp, k) for k in ("sheets", "counties")}
    for k, src in (("sheets", inputs.rig_sheets[0]), ("counties", inputs.county_csv)):
        os.makedirs(drops[k])
        with open(src) as f, open(os.path.join(drops[k], "a.csv"), "w") as g:
            g.write(f.read())
    load_new_sheets(wh, drops["sheets"], os.path.join(tmp, "cp_s"), q, CTX)
    load_new_counties(wh, drops["counties"], os.path.join(tmp, "cp_c"), q, CTX)
    assert (wh.source(loads.RIG_TABLE).count(), wh.source(loads.COUNTY_TABLE).count()) == (4, 4)
    load_new_counties(wh, drops["counties"], os.path.join(tmp, "cp_c2"), q, CTX)
    load_new_sheets(wh, drops["sheets"], os.path.join(tmp, "cp_s2"), q, CTX)
    assert (wh.source(loads.RIG_TABLE).count(), wh.source(loads.COUNTY_TABLE).count()) == (8, 8)
    assert spark.read.parquet(os.path.join(q, f"table={wh.name('raw', loads.RIG_TABLE)}")).count() == 2  # a rejected row of each
    for name in ("0", ".0.crc"):  # as if lost after the load: Spark replays the batch
        os.remove(os.path.join(tmp, "cp_s2", "commits", name))
    load_new_sheets(wh, drops["sheets"], os.path.join(tmp, "cp_s2"), q, CTX)
    assert wh.source(loads.RIG_TABLE).count() == 8


class Lost(Exception):
    """The driver, at some point of a batch."""


def _lose(monkeypatch, at):
    """Ends a batch right before ``at`` is done: the marker, or the rows after the rejects."""
    def gone(*_, **__):
        raise Lost
    monkeypatch.setattr(writers, at, gone)


@pytest.mark.parametrize("at", ["mark", "add_rows"])
def test_lost_batches_are_added_once(spark, tmp, monkeypatch, at):
    """All feeds: a batch is lost before or after its rows are in, then replayed."""
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs, q = _write_inputs(tmp), os.path.join(tmp, "q")
    feeds = {
        "rigs": (inputs.rig_sheets[0], loads.RIG_TABLE, load_new_sheets, {}, 4, 1),
        "counties": (inputs.county_csv, loads.COUNTY_TABLE, load_new_counties, {}, 4, 0),
        "quakes": (inputs.quake_features[0], loads.QUAKE_TABLE, load_new_features, {"lines": False}, 6, 0),
    }
    for name, (src, table, load, more, n, bad) in feeds.items():
        drop, cp = os.path.join(tmp, name), os.path.join(tmp, f"cp_{name}")
        os.makedirs(drop)
        shutil.copy(src, os.path.join(drop, "day1"))
        with monkeypatch.context() as m:
            _lose(m, at)
            with pytest.raises(Exception, match="Lost"):
                load(wh, drop, cp, q, CTX, **more)
        shutil.copy(src, os.path.join(drop, "day2"))  # dropped before the next run
        later = RunContext(run_id="run-2", loaded_at=CTX.loaded_at)
        load(wh, drop, cp, q, later, **more)
        assert wh.source(table).count() == 2 * n
        assert wh.source(table).select(writers.LOAD_ID).distinct().count() == 2
        rejects = os.path.join(q, f"table={wh.name('raw', table)}")
        if bad:
            assert spark.read.parquet(rejects).count() == 2 * bad


def test_append_batches_adds_a_lost_batch_once(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    name, drop, cp = wh.name("raw", "codes"), os.path.join(tmp, "drop"), os.path.join(tmp, "cp")
    writers.ensure_table(spark, name, S.STATE_CODE, by_load=True)
    os.makedirs(drop)
    with open(os.path.join(drop, "a.csv"), "w") as f:
        f.write("AA,A\nBB,B\n")
    add = append_batches(name, lambda b: b, cp)

    def lost(batch, epoch):
        add(batch, epoch)
        raise Lost

    with pytest.raises(Exception, match="Lost"):
        load_new_files(spark, drop, S.STATE_CODE, cp, lost)
    load_new_files(spark, drop, S.STATE_CODE, cp, add, refresh_table=name)
    assert spark.table(name).count() == 2
    writers.ensure_table(spark, wh.name("raw", "plain"), S.STATE_CODE)
    with pytest.raises(Exception, match="not partitioned by load_id"):
        load_new_files(spark, drop, S.STATE_CODE, os.path.join(tmp, "cp2"), append_batches(wh.name("raw", "plain"), lambda b: b, os.path.join(tmp, "cp2")))


def test_incremental_events_keep_the_window_and_box(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    drop = os.path.join(tmp, "drop")
    os.makedirs(drop)
    ms = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
    with open(os.path.join(drop, "a.jsonl"), "w") as f:
        for i, t, lat, lon in (("in", ms(2024, 1, 2), 30.0, -95.0), ("far", ms(2024, 1, 2), -30.0, 100.0), ("old", ms(1990, 1, 2), 30.0, -95.0)):
            f.write(json.dumps({"id": i, "properties": {"mag": 1.0, "time": t}, "geometry": {"coordinates": [lon, lat, 1]}}) + "\n")
    load_new_features(wh, drop, os.path.join(tmp, "cp"), os.path.join(tmp, "q"), CTX)
    rows = wh.source(loads.QUAKE_TABLE).collect()
    assert [(r.id, r.data_period_start, r.data_period_end) for r in rows] == [("in", dt.date(2023, 10, 12), dt.date(2024, 1, 10))]


def test_incremental_counties_by_header_name(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    drop, names = os.path.join(tmp, "drop"), [f.name for f in S.COUNTY_FILE.fields]
    os.makedirs(drop)
    for k, order in enumerate((list(range(len(names))), list(range(len(names)))[::-1])):
        with open(os.path.join(drop, f"{k}.csv"), "w") as f:
            for r in (names, COUNTIES[k]):
                f.write(",".join(str(r[i]) for i in order) + "\n")
    load_new_counties(wh, drop, os.path.join(tmp, "cp"), os.path.join(tmp, "q"), CTX)
    assert sorted((r.NAME, r.LATITUDE) for r in wh.source(loads.COUNTY_TABLE).collect()) == [("Harris", 29.8), ("Los Angeles", 34.3)]


def test_repeated_run_keeps_all_rejects(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs, q = _write_inputs(tmp), os.path.join(tmp, "q")
    for _ in range(2):
        loads.load_rigs(wh, inputs.rig_sheets, q, CTX)
        loads.load_rigs(wh, inputs.rig_sheets, q, RunContext(run_id=None, loaded_at=CTX.loaded_at))
    assert spark.read.parquet(q).count() == 4 and wh.source(loads.RIG_TABLE).count() == 16


def test_counts_come_from_the_write(spark, tmp):
    """One job writes the extract and counts it."""

    sc = spark.sparkContext
    rows = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.lit("bad")).alias("_reject_reason"), "id")
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "counts")
    _, counts = writers.stage(rows)
    jobs = sc.statusTracker().getJobIdsForGroup(group)
    sc.setJobGroup("rest", "rest")
    assert (counts.rows_in, counts.rows_loaded, counts.rows_rejected) == (1000, 900, 100)
    assert len(jobs) <= 3  # the write, the schema of its files, a look at whether there are rows
    _, none = writers.stage(rows.where("false"))
    assert none == writers.LoadResult(0, 0, 0)


def test_more_batches_than_progress_reports(spark, tmp):
    drop = os.path.join(tmp, "many")
    os.makedirs(drop)
    for k in range(104):
        with open(os.path.join(drop, f"{k:03d}.csv"), "w") as f:
            f.write(f"A{k},B\n")
    seen = []
    n = load_new_files(spark, drop, S.STATE_CODE, os.path.join(tmp, "cp"), lambda b, e: seen.append(b.count()), max_files_per_trigger=1)
    assert n == sum(seen) == len(seen) == 104


def test_user_models(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.saveAsTable(wh.name("raw", "src"))
    wh.register("gold", "top", lambda s, t: t["mid"].where("k > 1"), {"mid": ("silver", "mid")}, tags=("own",), comment="one row")
    wh.register("silver", "mid", lambda s, t: t["src"].selectExpr("k", "upper(v) AS v"), {"src": ("raw", "src")})
    assert [tuple(r) for r in wh.build("top").collect()] == [(2, "B")]
    assert spark.catalog.getTable(wh.name("gold", "top")).description == "one row" and wh.ref("silver", "mid").count() == 2
    wh.register("silver", "mid", lambda s, t: t["top"], {"top": ("gold", "top")})
    with pytest.raises(ValueError, match="read each other"):
        wh.build("top")


@pytest.mark.parametrize("by", [(), ("k",)])
def test_failed_rebuild_leaves_the_old_rows(spark, tmp, by):

    wh = _warehouse(spark)
    wh.create_namespaces()
    rows = lambda n: spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("k"))
    read = lambda: wh.ref("silver", "m")
    wh.table("silver", "m", rows(10), tags=("a",), comment="first", partition_by=by)
    with pytest.raises(Exception, match="lost"):  # after most rows are written
        wh.table("silver", "m", rows(1000).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))), partition_by=by)
    assert sorted(r.id for r in read().collect()) == list(range(10))
    kept = read()  # a reader of the version before
    wh.table("silver", "m", rows(5), tags=("b",), comment="second", partition_by=by)
    assert kept.count() in ({10} if not by else {5, 10}) and read().count() == 5  # the old or the new rows
    props = wh.properties("silver", "m")
    assert props["tags"] == "b" and spark.read.parquet(props["previous_path"]).count() == 10
    wh.table("silver", "m", rows(7).withColumn("more", F.lit("x")), partition_by=by)  # other columns
    assert read().count() == 7 and set(read().columns) == {"id", "k", "more"}
    gone = props["previous_path"].removeprefix("file:")
    assert not os.path.exists(gone) and len(os.listdir(os.path.dirname(gone))) == 3  # a failed one's folder stays without its rows
    assert [t.name for t in spark.catalog.listTables(wh.ns.silver)] == ["m"]


def test_rebuild_reads_its_own_table(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    wh.table("silver", "m", spark.range(4))
    wh.table("silver", "m", wh.ref("silver", "m").selectExpr("id + 1 AS id"))
    assert sorted(r.id for r in wh.ref("silver", "m").collect()) == [1, 2, 3, 4]


def _event_days(spark, wh):
    name = wh.name("raw", "days")
    writers.ensure_table(spark, name, S.RAW_QUAKES, by_load=True, by_day=True)
    return name


def _events(spark, days):
    rows = spark.createDataFrame([(f"e{i}", None if d is None else dt.datetime(2024, 1, d, h)) for i, (d, h) in enumerate(days)], "id string, time timestamp_ntz")
    return rows.select(*[rows[f.name] if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW_QUAKES.fields])


def test_event_days_are_partitions_of_a_load(spark):
    wh = _warehouse(spark)
    wh.create_namespaces()
    name = _event_days(spark, wh)
    writers.add_rows(_events(spark, [(1, 0), (1, 5), (2, 0), (None, 0)]), name, "it's", event_time="time")
    writers.add_rows(_events(spark, [(2, 1)]), name, "other", event_time="time")
    assert spark.table(name).count() == 5
    # a replay with other days leaves none of the days before, and other loads alone
    writers.add_rows(_events(spark, [(2, 0), (3, 0)]), name, "it's", event_time="time")
    got = {(r.load_id, r.event_day and r.event_day.day) for r in spark.table(name).collect()}
    assert got == {("it's", 2), ("it's", 3), ("other", 2)}
    with pytest.raises(ValueError, match="partitioned by day"):
        writers.add_rows(_events(spark, [(1, 0)]), name, "third")
    writers.add_rows(_events(spark, [(9, 0)]), name, "fourth", refresh=True, event_time="time")
    assert [r.id for r in spark.table(name).collect()] == ["e0"]


def test_questions_about_a_period_read_its_days_only(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    spread = [(d, h) for d in range(1, 21) for h in (0, 13)] + [(None, 0)]
    writers.ensure_table(spark, wh.name("raw", loads.QUAKE_TABLE), S.RAW_QUAKES, by_load=True, by_day=True)
    writers.add_rows(_events(spark, spread), wh.name("raw", loads.QUAKE_TABLE), "a", event_time="time")
    for start, end in [(dt.date(2024, 1, 5), dt.date(2024, 1, 8)), (dt.datetime(2024, 1, 5, 13), dt.datetime(2024, 1, 6, 12)), (dt.date(2024, 2, 1), dt.date(2024, 2, 2))]:
        pruned, plain = loads.events_between(wh, start, end), filters.time_window(wh.source(loads.QUAKE_TABLE), "time", start, end)
        assert sorted(pruned.collect()) == sorted(plain.collect())
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "event_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert loads.recent_events(wh, dt.date(2024, 1, 20), 2).count() == 5


def test_event_ids_are_checked_by_their_key_table(spark, tmp):
    wh = _warehouse(spark)
    wh.create_namespaces()
    inputs = _write_inputs(tmp)
    box = {"period": (dt.date(2023, 12, 1), dt.date(2024, 1, 10))}
    table = wh.name("raw", loads.QUAKE_TABLE)
    for n in (0, 6):  # the second load repeats all ids
        loads.load_quakes(wh, inputs.quake_features, os.path.join(tmp, "q"), CTX, **box)
        assert key_table.covers(spark, table, "id")
        assert key_table.unique(spark, table, "id", "t").collect() == quality.unique(wh.source(loads.QUAKE_TABLE), "t", "id").collect()
        assert key_table.violations(spark, table, "id").count() == n
