import math
import random

import numpy as np

from quarry.operators import nearest as N
from quarry.operators.nearest import EARTH_RADIUS_KM, BoxTree, PlaceTree, attach_nearest, locate, nearest_place, salted_places


def _hav(lat1, lon1, lat2, lon2):
    r = math.radians
    sp, sl = math.sin((lat2 - lat1) * 0.017453292519943295 / 2), math.sin((lon2 - lon1) * 0.017453292519943295 / 2)
    a = sp * sp + math.cos(lat1 * 0.017453292519943295) * math.cos(lat2 * 0.017453292519943295) * (sl * sl)
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(a))


def _brute(events, places):
    out = {}
    for eid, lat, lon in events:
        if lat is None or lon is None:
            out[eid] = None
            continue
        best = min((math.floor(_hav(lat, lon, plat, plon) * 1e6 + 0.5), pid) for pid, plat, plon in places)
        out[eid] = best[1]
    return out


def _run(spark, events, places, **kw):
    ev = spark.createDataFrame(events, "id bigint, latitude double, longitude double")
    pl = spark.createDataFrame(places, "place_id bigint, latitude double, longitude double")
    got = nearest_place(ev, pl, keep_invalid=True, **kw).collect()
    return {r.id: r.place_id for r in got}


def test_grid_equals_brute_force_random(spark):
    rng = random.Random(3)
    places = [(i, rng.uniform(25, 49), rng.uniform(-125, -65)) for i in range(300)]
    events = [(i, rng.uniform(20, 55), rng.uniform(-130, -60)) for i in range(2000)]
    assert _run(spark, events, places) == _brute(events, places)


def test_levels_borders_ties_far_points_and_nulls(spark):
    places = [(5, 10.0, 10.0), (3, 10.0, 12.0), (9, 40.0, -100.0), (1, 60.0, 170.0)]
    events = [
        (1, 10.0, 11.0),     # equidistant from 5 and 3 -> smaller id 3
        (2, 11.0, 11.0),     # cell border area
        (3, -60.0, 20.0),    # far from every place (reaches coarse levels)
        (4, 60.0, -175.0),   # across the date line from place 1
        (5, None, 1.0),      # NULL coordinate -> NULL place
        (6, 89.9, 0.0),      # near the pole
    ]
    got = _run(spark, events, places)
    exp = _brute(events, places)
    assert got == exp
    assert got[1] == 3 and got[4] == 1 and got[5] is None


def test_clustered_places(spark):
    rng = random.Random(11)
    cluster = [(i, 30.0 + rng.random() * 0.01, -90.0 + rng.random() * 0.01) for i in range(400)]
    sparse = [(1000 + i, rng.uniform(25, 49), rng.uniform(-125, -65)) for i in range(40)]
    places = cluster + sparse
    events = [(i, rng.uniform(24, 50), rng.uniform(-126, -64)) for i in range(800)]
    events += [(5000 + i, 30.005 + rng.uniform(-0.02, 0.02), -89.995 + rng.uniform(-0.02, 0.02)) for i in range(200)]
    assert _run(spark, events, places) == _brute(events, places)


def test_locate_attaches_attributes(spark):
    ev = spark.createDataFrame([(1, 10.0, 10.0), (2, None, None)], "id bigint, latitude double, longitude double")
    pl = spark.createDataFrame([(7, 10.1, 10.1, "TEXAS", "HARRIS")],
                               "place_id bigint, latitude double, longitude double, state string, county string")
    got = {r.id: (r.place_id, r.state, r.county) for r in locate(ev, pl, {"state": "state", "county": "county"}).collect()}
    assert got == {1: (7, "TEXAS", "HARRIS"), 2: (None, None, None)}


def test_no_places(spark):
    ev = spark.createDataFrame([(1, 10.0, 10.0)], "id bigint, latitude double, longitude double")
    pl = spark.createDataFrame([], "place_id bigint, latitude double, longitude double")
    got = nearest_place(ev, pl).collect()
    assert [(r.id, r.place_id, r.distance_km) for r in got] == [(1, None, None)]


def test_text_coordinates_that_do_not_cast_give_null(spark):
    ev = spark.createDataFrame([(1, "10.0", "10.0"), (2, "abc", "10.0"), (3, None, "1")],
                               "id bigint, latitude string, longitude string")
    pl = spark.createDataFrame([(7, 10.0, 10.0)], "place_id bigint, latitude double, longitude double")
    got = {r.id: r.place_id for r in nearest_place(ev, pl, keep_invalid=True).collect()}
    assert got == {1: 7, 2: None, 3: None}


def test_far_events_from_dense_cluster(spark):
    rng = random.Random(5)
    places = [(i, 40.0 + rng.random() * 0.5, -100.0 + rng.random() * 0.5) for i in range(2000)]
    places += [(5000 + i, rng.uniform(-50, 50), rng.uniform(-180, 180)) for i in range(30)]
    events = [(i, 40.25 + rng.uniform(-30, 30), -99.75 + rng.uniform(-30, 30)) for i in range(600)]
    assert _run(spark, events, places) == _brute(events, places)


def test_copies_of_places(spark):
    rng = random.Random(9)
    hot = [(i, 35.0, -97.0) for i in range(3000)]          # one place copied 3000 times
    others = [(10000 + i, rng.uniform(30, 40), rng.uniform(-100, -90)) for i in range(100)]
    events = [(i, rng.uniform(30, 40), rng.uniform(-100, -90)) for i in range(500)]
    got = _run(spark, events, hot + others)
    assert got == _brute(events, hot + others)
    assert all(p == 0 or p >= 10000 for p in got.values())


def test_tiles_give_the_same_as_one_tree(spark):
    rng = random.Random(21)
    places = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(400)]
    places += [(1000 + i, 30.0 + rng.random() * 0.01, -90.0 + rng.random() * 0.01) for i in range(400)]
    events = [(i % 50, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)]
    events += [(None, 30.005, -89.995)] * 20 + [(1, None, 5.0)]
    ev = spark.createDataFrame(events, "id bigint, latitude double, longitude double")
    pl = spark.createDataFrame(places, "place_id bigint, latitude double, longitude double")
    row = lambda r: tuple(str(x) for x in r)
    one = sorted((r for r in attach_nearest(ev, pl).collect()), key=row)
    tiles = sorted((r for r in attach_nearest(ev, pl, tree_places=50).collect()), key=row)
    assert tiles == one and len(one) == len(events)
    best = _brute([(k, lat, lon) for k, (_, lat, lon) in enumerate(events)], places)
    assert sorted(str(r.place_id) for r in one) == sorted(map(str, best.values()))


def test_repeated_and_null_ids_keep_every_row(spark):
    rng = random.Random(4)
    places = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180)) for i in range(60)]
    at = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(8)]
    pl = spark.createDataFrame(places, "place_id bigint, latitude double, longitude double")
    for ids in ([7] * 8, [None] * 8):
        ev = spark.createDataFrame([(i, lat, lon) for i, (lat, lon) in zip(ids, at, strict=True)], "id bigint, latitude double, longitude double")
        for tree in (200_000, 10):
            got = sorted(r.place_id for r in nearest_place(ev, pl, tree_places=tree).collect())
            assert got == sorted(_brute([(k, *a) for k, a in enumerate(at)], places).values())


def test_bad_coordinates_give_null(spark):
    inf, nan = float("inf"), float("nan")
    events = [(1, 1e12, 0.0), (2, 0.0, inf), (3, nan, 0.0), (4, -inf, nan), (5, 91.0, 0.0), (6, 0.0, 180.5), (7, 90.0, -180.0)]
    for tree in (200_000, 1):
        assert _run(spark, events, [(1, 0.0, 0.0), (2, 80.0, 10.0)], tree_places=tree) == {1: None, 2: None, 3: None, 4: None, 5: None, 6: None, 7: 2}


def test_routing_finds_every_box_that_may_matter():
    rng = np.random.default_rng(8)
    middle, half = rng.uniform(-1, 1, (700, 3)), rng.uniform(0, 0.05, (700, 3))
    tree, q = BoxTree(middle - half, middle + half), rng.uniform(-1.2, 1.2, (300, 3))
    near = (np.maximum(np.maximum(tree.box_lo - q[:, None], q[:, None] - tree.box_hi), 0) ** 2).sum(axis=2)
    far = (np.maximum(np.abs(q[:, None] - tree.box_lo), np.abs(q[:, None] - tree.box_hi)) ** 2).sum(axis=2)
    assert sorted(zip(*(x.tolist() for x in tree.route(q)), strict=True)) == [tuple(x) for x in np.argwhere(near <= far.min(axis=1, keepdims=True)).tolist()]
    assert tree.measured < 0.5 * 300 * 700


def test_only_hot_tiles_are_copied(spark, monkeypatch):
    """Half of the coordinates lie in one tile: its places alone are copied."""
    rng = random.Random(3)
    places = [(i, rng.uniform(25, 49), rng.uniform(-125, -65)) for i in range(2000)]
    events = [(i, rng.uniform(25, 49), rng.uniform(-125, -65)) for i in range(300)]
    events += [(1000 + i, 40.0 + rng.random() * 0.01, -90.0 + rng.random() * 0.01) for i in range(300)]
    seen = []

    def salted(tiled, salts):
        out = salted_places(tiled, salts)
        seen.append((tiled.count(), out.count(), sorted(r["__salts"] for r in salts.collect())))
        return out

    monkeypatch.setattr(N, "salted_places", salted)
    monkeypatch.setattr(N._by_tiles, "__defaults__", (100,))
    assert _run(spark, events, places, tree_places=50) == _brute(events, places)
    n, copied, salts = seen[0]
    hot = [k for k in salts if k > 1]
    assert hot and len(hot) <= 6 < len(salts)
    assert copied <= n + 2 * 50 * sum(hot)


def test_far_events_score_few_places():
    rng = np.random.default_rng(6)
    tree = PlaceTree(40 + 0.5 * rng.random(3000), -100 + 0.5 * rng.random(3000))
    lat, lon = rng.uniform(-80, 20, 400), rng.uniform(0, 170, 400)
    tree.nearest(lat, lon)
    assert tree.scored < 300 * 400
