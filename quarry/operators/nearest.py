"""Nearest-place join (J3-J5): each event row takes its closest place.

No distance cut-off: every event with valid coordinates gets a place
(while any place exists). Distances are great-circle (haversine) in km;
equal distances, compared in whole millimetres, go to the smaller place
id. The search depends on an event's coordinates alone, never on its id,
so repeated and NULL ids are located like others. Coordinates that are
NULL, not numbers, not finite or out of range give NULLs.

Places are put into a balanced tree over their unit vectors (``PlaceTree``,
a few array operations). A batch of events first descends greedily to one
leaf, which gives each an upper bound; then all of them go down together,
level by level, and keep only the nodes whose bounding box is within the
bound. So an event scores the places of a few leaves, wherever the places
are dense and however far away the event is.

* Up to ``TREE_PLACES`` places (checked by reading one more at most) the
  tree is sent to the tasks and events are searched where they stand: two
  columns through Arrow, no shuffle, no checkpoint, one row in, one out.
* More places are cut into tiles of about that many. Each distinct event
  coordinate is sent to the tiles that may hold its nearest place (mostly
  one), found by a tree over the tiles' bounding boxes; the nearest of a few
  places of each tile bounds how far away that can be. Every tile is searched
  with the same tree of its places; only tiles that many coordinates ask for
  are copied, in salted groups. The best of the tiles is joined back to the
  events on the coordinates. Both ways give the same rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

# Mean Earth radius (km) and degrees-to-radians factor.
EARTH_RADIUS_KM = 6371.0
DEG_TO_RAD = 0.017453292519943295

# Distances are compared in whole millimetres (KM_DECIMALS decimals of a
# km), so last-bit differences of sin/cos cannot reorder equal distances.
KM_DECIMALS = 6

TREE_PLACES = 200_000  # places in one tree
LEAF_PLACES = 16
EVENTS_AT_ONCE = 4096
LEAF_BOXES = 8
TILE_SAMPLE = 64  # places of a tile, about, that bound the distance while points are routed
SALT_EVENTS = 500_000  # distinct event coordinates per salt of a tile
_SLACK = 1e-9  # of a chord on the unit sphere: about 6 mm, more than rounding


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    p1, p2 = lat1 * DEG_TO_RAD, lat2 * DEG_TO_RAD
    dphi = (lat2 - lat1) * DEG_TO_RAD
    dlmb = (lon2 - lon1) * DEG_TO_RAD
    s_phi, s_lmb = F.sin(dphi / 2), F.sin(dlmb / 2)
    a = s_phi * s_phi + F.cos(p1) * F.cos(p2) * (s_lmb * s_lmb)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1.0, 1.0).otherwise(a)))


def km_units(km: Column) -> Column:
    """Distance in whole millimetres (half up), as a long.

    Plain floating-point operations only, so every engine computes the
    same value from the same distance."""
    return F.floor(km * F.lit(10.0 ** KM_DECIMALS) + F.lit(0.5)).cast("long")


def _millimetres(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    s_phi = np.sin((lat2 - lat1) * DEG_TO_RAD / 2)
    s_lmb = np.sin((lon2 - lon1) * DEG_TO_RAD / 2)
    a = s_phi * s_phi + np.cos(lat1 * DEG_TO_RAD) * np.cos(lat2 * DEG_TO_RAD) * (s_lmb * s_lmb)
    return np.floor(2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(a, 1.0))) * 10.0 ** KM_DECIMALS + 0.5)


def coordinate(col: str, limit: float) -> Column:
    """The column as a finite double within +-limit, else NULL."""
    v = F.col(col).try_cast("double")
    return F.when(v.between(-limit, limit), v)


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    phi, lmb = lat * DEG_TO_RAD, lon * DEG_TO_RAD
    return np.stack([np.cos(phi) * np.cos(lmb), np.cos(phi) * np.sin(lmb), np.sin(phi)], axis=1)


def _box_distance2(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(lo - q, q - hi), 0.0)
    return (gap * gap).sum(axis=-1)


def _halves(lo: np.ndarray, hi: np.ndarray, leaf: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Balanced tree over boxes, halved along the longest axis: (depth, order
    of the boxes, begin and end of each node in it, the nodes' own boxes).
    The children of node k are 2k + 1 and 2k + 2."""
    middle = (lo + hi) / 2
    depth = max(0, math.ceil(math.log2(max(1, len(lo)) / leaf)))
    n_nodes = (2 << depth) - 1
    order = np.arange(len(lo))
    node_lo, node_hi = np.full((n_nodes, 3), np.inf), np.full((n_nodes, 3), -np.inf)
    begin, end = np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64)
    end[0] = len(lo)
    for node in range(n_nodes):  # parents come before their children
        a, b = begin[node], end[node]
        if b > a:
            inside = order[a:b]
            node_lo[node], node_hi[node] = lo[inside].min(axis=0), hi[inside].max(axis=0)
        if 2 * node + 2 < n_nodes:
            mid = (a + b) // 2
            if b - a > 1:
                axis = int(np.argmax(node_hi[node] - node_lo[node]))
                order[a:b] = inside[np.argpartition(middle[inside, axis], mid - a)]
            begin[2 * node + 1], end[2 * node + 1] = a, mid
            begin[2 * node + 2], end[2 * node + 2] = mid, b
    return depth, order, begin, end, node_lo, node_hi


class BoxTree:
    """Boxes of tiles that each hold a place, for routing points."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        self.box_lo, self.box_hi = lo, hi
        self.depth, self.order, self.begin, self.end, self.lo, self.hi = _halves(lo, hi, LEAF_BOXES)
        self.measured = 0  # boxes measured so far, for tests

    def _far(self, q: np.ndarray, box: np.ndarray) -> np.ndarray:
        return (np.maximum(np.abs(q - self.box_lo[box]), np.abs(q - self.box_hi[box])) ** 2).sum(axis=1)

    def _boxes(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, box) for all boxes of the leaves ``node``."""
        n = self.end[node] - self.begin[node]
        pair = np.repeat(np.arange(len(node)), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + self.begin[node][pair]
        self.measured += len(pair)
        return pair, self.order[at]

    def route(self, q: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(point, box) where the box may hold the point's nearest place: it
        begins no farther away than the nearest far corner of any box, and
        than a place that is ``known`` to be that far away (squared)."""
        node = np.zeros(len(q), np.int64)
        for _ in range(self.depth):
            left, right = 2 * node + 1, 2 * node + 2
            nearer = _box_distance2(q, self.lo[left], self.hi[left]) <= _box_distance2(q, self.lo[right], self.hi[right])
            node = np.where(nearer, left, right)
        pair, box = self._boxes(node)
        bound = np.full(len(q), np.inf) if known is None else known.copy()
        np.minimum.at(bound, pair, self._far(q[pair], box))
        point, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        for _ in range(self.depth):
            point, node = np.concatenate([point, point]), np.concatenate([2 * node + 1, 2 * node + 2])
            keep = _box_distance2(q[point], self.lo[node], self.hi[node]) <= bound[point]
            point, node = point[keep], node[keep]
        pair, box = self._boxes(node)
        point = point[pair]
        np.minimum.at(bound, point, self._far(q[point], box))
        keep = _box_distance2(q[point], self.box_lo[box], self.box_hi[box]) <= bound[point]
        return point[keep], box[keep]


class PlaceTree:
    """Places in the order of their ids, for exact nearest search."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray):
        self.lat, self.lon = lat, lon
        self.xyz = _unit(lat, lon)
        self.depth, self.order, self.begin, self.end, self.lo, self.hi = _halves(self.xyz, self.xyz, LEAF_PLACES)
        self.scored = 0  # places scored so far, for tests

    def _points(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place) for all places of the leaves ``node``."""
        n = self.end[node] - self.begin[node]
        pair = np.repeat(np.arange(len(node)), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + self.begin[node][pair]
        self.scored += len(pair)
        return pair, self.order[at]

    def nearest(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place number, distance in mm) for each event; -1 without places."""
        place, mm = np.full(len(lat), -1, np.int64), np.full(len(lat), np.inf)
        for a in range(0, len(lat), EVENTS_AT_ONCE):
            part = slice(a, a + EVENTS_AT_ONCE)
            if len(self.lat):
                place[part], mm[part] = self._nearest(lat[part], lon[part])
        return place, mm

    def _nearest(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = _unit(lat, lon)
        node = np.zeros(len(q), np.int64)
        for _ in range(self.depth):
            left, right = 2 * node + 1, 2 * node + 2
            nearer = _box_distance2(q, self.lo[left], self.hi[left]) <= _box_distance2(q, self.lo[right], self.hi[right])
            node = np.where(nearer, left, right)
        pair, at = self._points(node)
        bound = np.full(len(q), np.inf)
        np.minimum.at(bound, pair, ((self.xyz[at] - q[pair]) ** 2).sum(axis=1))
        bound = (np.sqrt(bound) + _SLACK) ** 2

        event, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        for _ in range(self.depth):
            event, node = np.concatenate([event, event]), np.concatenate([2 * node + 1, 2 * node + 2])
            keep = _box_distance2(q[event], self.lo[node], self.hi[node]) <= bound[event]
            event, node = event[keep], node[keep]
        pair, at = self._points(node)
        event = event[pair]
        close = ((self.xyz[at] - q[event]) ** 2).sum(axis=1) <= bound[event]
        event, at = event[close], at[close]
        d = _millimetres(lat[event], lon[event], self.lat[at], self.lon[at])
        order = np.lexsort((at, d, event))
        first = np.searchsorted(event[order], np.arange(len(q)))
        best = order[first]
        return at[best], d[best]


def _places(places: DataFrame, place_id: str, place_lat: str, place_lon: str) -> DataFrame:
    """(__pid, __plat, __plon), one row for each valid coordinate: copies of a
    place are equally far from every event, and the smaller id wins."""
    return (
        places.select(F.col(place_id).alias("__pid"), coordinate(place_lat, 90.0).alias("__plat"), coordinate(place_lon, 180.0).alias("__plon"))
        .where(F.col("__plat").isNotNull() & F.col("__plon").isNotNull() & F.col("__pid").isNotNull())
        .groupBy("__plat", "__plon").agg(F.min("__pid").alias("__pid"))
    )


def _by_tree(events: DataFrame, rows: pd.DataFrame) -> DataFrame:
    """Events with ``__at``: the coordinates of their nearest place."""
    sent = events.sparkSession.sparkContext.broadcast(PlaceTree(rows["__plat"].to_numpy(float), rows["__plon"].to_numpy(float)))

    @F.pandas_udf("lat double, lon double")
    def search(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        tree = sent.value
        y, x = lat.to_numpy(float), lon.to_numpy(float)
        ok = np.isfinite(y) & np.isfinite(x)
        place, _ = tree.nearest(y[ok], x[ok])
        out = np.full((len(y), 2), np.nan)
        if len(tree.lat):
            out[ok, 0], out[ok, 1] = tree.lat[place], tree.lon[place]
        return pd.DataFrame({"lat": out[:, 0], "lon": out[:, 1]})

    return events.withColumn("__at", search("__elat", "__elon"))


def _tiles(places: DataFrame, tile_places: int) -> DataFrame:
    """Places with ``__tile``: bands of latitude cut by longitude, of about
    ``tile_places`` places each."""
    n = places.count()
    bands = max(1, math.ceil(math.sqrt(n / tile_places)))
    share = [k / bands for k in range(1, bands)]
    cuts = places.approxQuantile("__plat", share, 0.1 / bands) if share else []
    below = lambda col, bounds: F.size(F.filter(bounds, lambda b: b <= F.col(col)))
    banded = places.withColumn("__band", below("__plat", F.array(*map(F.lit, cuts))) if cuts else F.lit(0))
    if not share:
        return banded.withColumn("__tile", F.lit(0)).drop("__band")
    bounds = banded.groupBy("__band").agg(F.percentile_approx("__plon", share, 10_000).alias("__cuts"))
    return banded.join(F.broadcast(bounds), "__band").withColumn("__tile", F.col("__band") * bands + below("__plon", F.col("__cuts"))).drop("__band", "__cuts")


def tile_salts(routed: DataFrame, salt_events: int) -> DataFrame:
    """(__tile, __salts): in how many groups the coordinates of a tile are searched."""
    return routed.groupBy("__tile").agg(F.ceil(F.count("*") / F.lit(salt_events)).cast("int").alias("__salts"))


def salted_places(tiled: DataFrame, salts: DataFrame) -> DataFrame:
    """The places of the tiles asked for, once for each of the tile's groups."""
    return tiled.join(F.broadcast(salts), "__tile").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")


def _by_tiles(events: DataFrame, places: DataFrame, tile_places: int, salt_events: int = SALT_EVENTS) -> DataFrame:
    """Like ``_by_tree`` for more places than one tree holds."""
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    tiled = _tiles(places, tile_places).checkpoint(eager=True)
    phi, lmb = F.col("__plat") * DEG_TO_RAD, F.col("__plon") * DEG_TO_RAD
    axes = {"x": F.cos(phi) * F.cos(lmb), "y": F.cos(phi) * F.sin(lmb), "z": F.sin(phi)}
    boxes = tiled.groupBy("__tile").agg(
        *[f(c).alias(n + a) for n, f in (("lo_", F.min), ("hi_", F.max)) for a, c in axes.items()]
    ).orderBy("__tile").toPandas()  # one row a tile
    lo, hi = (boxes[[f"{n}_{a}" for a in "xyz"]].to_numpy() for n in ("lo", "hi"))
    every = max(1, tile_places // TILE_SAMPLE)
    some = tiled.where(F.pmod(F.xxhash64("__plat", "__plon"), F.lit(every)) == 0).select("__plat", "__plon").toPandas()  # a few a tile; only bounds distances
    near = PlaceTree(some["__plat"].to_numpy(float), some["__plon"].to_numpy(float))
    sent = spark.sparkContext.broadcast((boxes["__tile"].to_numpy(), BoxTree(lo - _SLACK, hi + _SLACK), near))

    @F.pandas_udf("array<int>")
    def tiles_of(lat: pd.Series, lon: pd.Series) -> pd.Series:
        tile, tree, near = sent.value
        out = []
        for a in range(0, len(lat), EVENTS_AT_ONCE):
            y, x = (v[a: a + EVENTS_AT_ONCE].to_numpy(float) for v in (lat, lon))
            q, (place, _) = _unit(y, x), near.nearest(y, x)
            known = (np.sqrt(((near.xyz[place] - q) ** 2).sum(axis=1)) + _SLACK) ** 2 if len(near.lat) else None
            point, box = tree.route(q, known)
            order = np.argsort(point, kind="stable")
            out += np.split(tile[box[order]], np.searchsorted(point[order], np.arange(1, len(q))))
        return pd.Series(out)

    at = events.where(F.col("__elat").isNotNull() & F.col("__elon").isNotNull()).select("__elat", "__elon").distinct()
    routed = at.select("__elat", "__elon", F.explode(tiles_of("__elat", "__elon")).alias("__tile")).checkpoint(eager=True)
    salts = tile_salts(routed, salt_events)  # one row a tile, like the boxes
    asked = routed.join(F.broadcast(salts), "__tile").withColumn("__salt", F.pmod(F.xxhash64("__elat", "__elon"), F.col("__salts")).cast("int"))
    copies = salted_places(tiled, salts)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("__pid", "ascending"), ("__plat", "ascending"), ("__plon", "ascending")])
        tree = PlaceTree(right["__plat"].to_numpy(), right["__plon"].to_numpy())
        place, mm = tree.nearest(left["__elat"].to_numpy(), left["__elon"].to_numpy())
        found = place >= 0
        hits = right.take(pa.array(place[found]))
        kept = left.filter(pa.array(found))
        return pa.table({"__elat": kept["__elat"], "__elon": kept["__elon"], "mm": pa.array(mm[found]), "pid": hits["__pid"], "lat": hits["__plat"], "lon": hits["__plon"]})

    pid_type = places.schema["__pid"].dataType.simpleString()
    per_tile = asked.groupBy("__tile", "__salt").cogroup(copies.groupBy("__tile", "__salt")).applyInArrow(
        search, f"__elat double, __elon double, mm double, pid {pid_type}, lat double, lon double"
    )
    best = per_tile.groupBy("__elat", "__elon").agg(F.min(F.struct("mm", "pid", "lat", "lon")).alias("b")).select(
        "__elat", "__elon", F.struct(F.col("b.lat"), F.col("b.lon")).alias("__at")
    )
    return events.join(best, ["__elat", "__elon"], "left")


def attach_nearest(
    events: DataFrame,
    places: DataFrame,
    attributes: dict[str, str] | None = None,
    event_lat: str = "latitude",
    event_lon: str = "longitude",
    place_id: str = "place_id",
    place_lat: str = "latitude",
    place_lon: str = "longitude",
    tree_places: int = TREE_PLACES,
) -> DataFrame:
    """``events`` row by row, with ``place_id``, ``attributes`` (place columns
    to output names) and ``distance_km`` of the nearest place. If a place id
    stands for several rows, one of them gives the attributes."""
    known = events.columns
    ev = events.withColumns({"__elat": coordinate(event_lat, 90.0), "__elon": coordinate(event_lon, 180.0)})
    pl = _places(places, place_id, place_lat, place_lon)
    rows = pl.limit(tree_places + 1).toPandas()
    one_tree = len(rows) <= tree_places
    found = _by_tree(ev, rows.sort_values(["__pid", "__plat", "__plon"])) if one_tree else _by_tiles(ev, pl, tree_places)
    lookup = pl
    if attributes:
        attrs = places.select(F.col(place_id).alias("__pid"), *[F.col(c).alias(o) for c, o in attributes.items()]).dropDuplicates(["__pid"])
        lookup = pl.join(attrs, "__pid", "left")
    lookup = lookup.withColumnsRenamed({"__plat": "__klat", "__plon": "__klon"})
    if one_tree:  # its rows are counted: at most ``tree_places``
        lookup = F.broadcast(lookup)
    joined = found.join(lookup, (F.col("__at.lat") == F.col("__klat")) & (F.col("__at.lon") == F.col("__klon")), "left")
    km = km_units(haversine_km(F.col("__elat"), F.col("__elon"), F.col("__klat"), F.col("__klon"))).cast("double") / F.lit(10.0 ** KM_DECIMALS)
    return joined.select(*[F.col(f"`{c}`") for c in known], F.col("__pid").alias(place_id), *(attributes or {}).values(), km.alias("distance_km"))


def nearest_place(
    events: DataFrame,
    places: DataFrame,
    event_id: str = "id",
    event_lat: str = "latitude",
    event_lon: str = "longitude",
    place_id: str = "place_id",
    place_lat: str = "latitude",
    place_lon: str = "longitude",
    keep_invalid: bool = False,
    tree_places: int = TREE_PLACES,
) -> DataFrame:
    """``(event_id, place_id, distance_km)`` for every event row with valid
    coordinates (and, with ``keep_invalid``, NULLs for the others)."""
    ev = events.select(F.col(event_id).alias("__eid"), F.col(event_lat).alias("__lat"), F.col(event_lon).alias("__lon"))
    if not keep_invalid:
        ev = ev.where(coordinate("__lat", 90.0).isNotNull() & coordinate("__lon", 180.0).isNotNull())
    out = attach_nearest(ev, places, None, "__lat", "__lon", place_id, place_lat, place_lon, tree_places)
    return out.select(F.col("__eid").alias(event_id), place_id, "distance_km")


def locate(
    events: DataFrame,
    places: DataFrame,
    attributes: dict[str, str],
    event_id: str = "id",
    event_lat: str = "latitude",
    event_lon: str = "longitude",
    place_id: str = "place_id",
    place_lat: str = "latitude",
    place_lon: str = "longitude",
    keep_unlocated: bool = True,
    tree_places: int = TREE_PLACES,
) -> DataFrame:
    """``(event_id, place_id, distance_km, attributes)``, a row for each event
    row; those without valid coordinates keep NULLs, or go without
    ``keep_unlocated`` (J3-J5)."""
    ev = events.select(F.col(event_id).alias("__eid"), F.col(event_lat).alias("__lat"), F.col(event_lon).alias("__lon"))
    if not keep_unlocated:
        ev = ev.where(coordinate("__lat", 90.0).isNotNull() & coordinate("__lon", 180.0).isNotNull())
    out = attach_nearest(ev, places, attributes, "__lat", "__lon", place_id, place_lat, place_lon, tree_places)
    return out.select(F.col("__eid").alias(event_id), place_id, "distance_km", *attributes.values())
