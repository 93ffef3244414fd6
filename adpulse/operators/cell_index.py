"""Nearest place of each coordinate by a multi-level cell index.

The globe is cut into cells of 45 degrees, each cell into four, down to cells of
about 150 m (``FINEST``).  The index has one row for every occupied cell of every
level, with one of its places as representative.  A coordinate is served in keyed
joins only, with work that follows the places near it, not its distance to them:

1. Home: the coordinate meets the occupied cells it lies in itself, and the
   distance to the nearest representative is its first bound.  The finest of
   these cells is about as large as the gap around the coordinate.
2. Direct, for a small bound: cells as wide as the bound are chosen, so the circle
   around the coordinate touches at most nine of them; their places are the
   candidates.
3. Descent, for the others (no place for many kilometres, or near a pole): from
   the occupied cells of a coarse level (at most ``TOP_CELLS``) down to the first
   level whose cells hold few places, ``STEP`` levels at a time.  The representatives
   of the cells reached tighten the bound, and only cells whose nearest point
   (exact on the sphere, also at the poles and the date line) is within it go on:
   in the end those along the circle of the nearest distance.

The result is exact: a cell that holds the nearest place is never pruned.  Both
ways are one lazy plan; only the index, the places and the bounds are stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.sources.sinks import materialize

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0
#: No two points are further apart.
FARTHEST_KM = 20_020.0
TOP_DEG = 45.0
FINEST = 15
#: Levels of the home cells; coarser ones would be met by too many coordinates to be of use.
HOME = 5
#: Coarsest cells (0.18 degrees) for which the cells around a coordinate are taken at once.
DIRECT = 8
#: Latitudes beyond this are left to the descent.
DIRECT_LATITUDE = 80.0
#: Levels that one step of the descent goes down.
STEP = 2
#: Occupied cells from which the descent begins, and places of a cell that are looked at without going further down.
TOP_CELLS, FEW = 128, 16
#: Coordinates of a task that begins the descent.
PER_TASK = 50_000
_COORDS = ["longitude", "latitude"]
_FINE_DEG = TOP_DEG / (1 << FINEST)
_FINE_ROWS, _FINE_COLS = 4 << FINEST, 8 << FINEST


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = p2 - p1
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def _fine(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Row and column at the finest level; shifted right they are those of coarser levels."""
    y = F.greatest(F.lit(0), F.least(F.lit(_FINE_ROWS - 1), F.floor((lat + 90.0) / _FINE_DEG)))
    return y.cast("int"), F.pmod(F.floor((lon + 180.0) / _FINE_DEG), F.lit(_FINE_COLS)).cast("int")


def _cell(y: Column, x: Column) -> Column:
    return F.shiftleft(y.cast("long"), 20) + x


def _cell_at(level: int) -> Column:
    return _cell(F.shiftright("fine_y", FINEST - level), F.shiftright("fine_x", FINEST - level))


def least_km(lat: Column, lon: Column, cell: Column, level: int) -> Column:
    """Distance to the nearest point of a cell: 0 inside, else on the nearer of its two
    meridians, where the distance has its only minimum at one latitude (held to the cell)."""
    size = TOP_DEG / (1 << level)
    south = F.shiftright(cell, 20) * size - 90.0
    west = cell.bitwiseAND((1 << 20) - 1) * size - 180.0
    east_of = F.pmod(lon - west, F.lit(360.0))
    gap = F.radians(F.when(east_of <= size, 0.0).otherwise(F.least(east_of - size, F.lit(360.0) - east_of)))
    phi = F.radians(lat)
    best = F.degrees(F.atan2(F.sin(phi), F.cos(phi) * F.cos(gap)))
    held = F.greatest(south, F.least(south + size, best))

    def to(latitude: Column) -> Column:
        p = F.radians(latitude)
        a = F.pow(F.sin((p - phi) / 2), 2) + F.cos(p) * F.cos(phi) * F.pow(F.sin(gap / 2), 2)
        return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))))
    # Beyond a quarter of the globe the far end of the meridian may be nearer.
    return F.when(gap <= math.pi / 2, to(held)).otherwise(F.least(to(held), to(south), to(south + size)))


def _reach(bound: Column) -> Column:
    """A bound with room for rounding (a millimetre and more)."""
    return bound * (1 + 1e-9) + 1e-6


def _with_cells(points: DataFrame, levels: list[int]) -> DataFrame:
    """One row for each of ``levels``, with the point's ``cell`` there."""
    y, x = _fine(F.col("latitude"), F.col("longitude"))
    cells = F.array(*(F.struct(F.lit(k).alias("level"), _cell_at(k).alias("cell"))
                      for k in levels))
    return (points.withColumns({"fine_y": y, "fine_x": x}).withColumn("__at", F.explode(cells))
            .select(*points.columns, "__at.level", "__at.cell"))


def build_index(places: DataFrame) -> DataFrame:
    """``level, cell, rlon, rlat, n``: every occupied cell with the first and the number of its places."""
    cells = _with_cells(places.select(*_COORDS), list(range(FINEST + 1)))
    return (cells.groupBy("level", "cell").agg(F.min(F.struct(*_COORDS)).alias("r"), F.count(F.lit(1)).alias("n"))
            .select("level", "cell", F.col("r.longitude").alias("rlon"), F.col("r.latitude").alias("rlat"), "n"))


def _span(index: DataFrame) -> tuple[int, int]:
    """Where the descent begins, the finest level of at most ``TOP_CELLS`` occupied cells, and where it ends,
    the first level whose cells hold at most ``FEW`` places (both read from one row per level)."""
    levels = {r["level"]: r for r in index.groupBy("level").agg(F.count(F.lit(1)).alias("cells"), F.max("n").alias("most")).collect()}
    start = max((k for k, r in levels.items() if r["cells"] <= TOP_CELLS), default=0)
    return start, max(start, min((k for k, r in levels.items() if r["most"] <= FEW), default=FINEST))


def _to_representative() -> Column:
    return haversine_km(F.col("latitude"), F.col("longitude"), F.col("rlat"), F.col("rlon"))


def _home(coords: DataFrame, index: DataFrame, limit: float) -> DataFrame:
    """``coords`` with ``bound``: the distance to a place that is at hand, or ``limit``."""
    met = _with_cells(coords, list(range(HOME, FINEST + 1))).join(index, ["level", "cell"], "left")
    return (met.groupBy(*_COORDS).agg(F.min(_to_representative()).alias("bound"))
            .withColumn("bound", F.least(F.coalesce("bound", F.lit(limit)), F.lit(limit))))


def _direct_level() -> tuple[Column, Column, Column]:
    """Degrees of latitude and of longitude that the bound spans at most, and the finest level as wide."""
    lat_deg = _reach(F.col("bound")) / KM_PER_DEGREE
    lon_deg = lat_deg / F.cos(F.radians(F.least(F.lit(89.0), F.abs("latitude") + lat_deg)))
    return lat_deg, lon_deg, F.least(F.lit(FINEST), F.floor(F.log2(F.lit(TOP_DEG * (1 - 1e-9)) / lon_deg))).cast("int")


def _around(bounded: DataFrame) -> DataFrame:
    """``longitude, latitude, level, cell`` of the cells that the circle around a coordinate can touch."""
    lat_deg, lon_deg, _ = _direct_level()
    y, x = _fine(F.col("latitude"), F.col("longitude"))
    df = bounded.withColumns({"fine_y": y, "fine_x": x, "fine_up": F.lit(FINEST) - F.col("level"),
                              "size": F.expr(f"{TOP_DEG}D / shiftleft(1, level)"), "la": lat_deg, "lo": lon_deg})
    df = df.withColumns({"cy": F.expr("shiftright(fine_y, fine_up)"), "cx": F.expr("shiftright(fine_x, fine_up)"),
                         "cols": F.expr("shiftleft(8, level)")})
    # Distance to the cell's own borders, with room for rounding.
    south = F.col("latitude") + 90.0 - F.col("cy") * F.col("size")
    west = F.pmod(F.col("longitude") + 180.0, F.lit(360.0)) - F.col("cx") * F.col("size")

    def steps(inner: Column, reach: str) -> Column:
        room = F.col(reach) + 1e-9
        return F.array_compact(F.array(F.when(inner <= room, -1), F.lit(0), F.when(F.col("size") - inner <= room, 1)))
    df = df.withColumn("dy", F.explode(steps(south, "la"))).withColumn("dx", F.explode(steps(west, "lo")))
    return df.select(*_COORDS, "level", _cell(F.col("cy") + F.col("dy"), F.pmod(F.col("cx") + F.col("dx"), F.col("cols"))).alias("cell"))


def _descended(far: DataFrame, index: DataFrame, level: int, last: int) -> DataFrame:
    """``longitude, latitude, cell`` of the cells at the ``last`` level that can hold the nearest place."""
    top = index.filter(F.col("level") == level).agg(F.collect_list(F.struct("cell", "rlon", "rlat"))).scalar()
    rows = far.select(*_COORDS, "bound", F.explode(top).alias("c")).select(*_COORDS, "bound", "c.*")
    while True:
        rows = rows.withColumns({"d": _to_representative(),
                                 "least": least_km(F.col("latitude"), F.col("longitude"), F.col("cell"), level)})
        near = rows.groupBy(*_COORDS).agg(
            F.least(F.min("bound"), F.min("d")).alias("bound"), F.collect_list(F.struct("least", "cell")).alias("cells"))
        near = near.withColumn("limit", _reach(F.col("bound")))
        kept = (near.withColumn("c", F.explode(F.filter("cells", lambda c: c["least"] <= F.col("limit"))))
                .select(*_COORDS, "bound", F.col("c.cell").alias("cell")))
        if level == last:
            return kept.select(*_COORDS, F.lit(level).alias("level"), "cell")
        down = min(STEP, last - level)
        level += down
        parent = _cell(F.shiftright(F.shiftright("cell", 20), down), F.shiftright(F.col("cell").bitwiseAND((1 << 20) - 1), down))
        children = index.filter(F.col("level") == level).select(parent.alias("parent"), F.col("cell").alias("child"), "rlon", "rlat")
        rows = (kept.join(children, F.col("cell") == F.col("parent"))
                .select(*_COORDS, "bound", F.col("child").alias("cell"), "rlon", "rlat"))


def nearest(coords: DataFrame, places: DataFrame, columns: list[str], max_km: float | None = None) -> DataFrame:
    """``longitude, latitude``, the ``columns`` of the nearest place and its ``distance_km``, for each distinct
    coordinate of ``coords`` (within ``max_km``, if given).  ``places`` has one row per coordinate; of
    places equally near, the one with the smallest longitude and latitude is taken."""
    limit = FARTHEST_KM if max_km is None else float(max_km)
    places = materialize(places.select(*_COORDS, *columns).dropna(subset=_COORDS), "places")
    index = materialize(build_index(places), "cells")
    bounded = _home(coords.select(*_COORDS).dropna().distinct(), index, limit)
    near = F.col("level") >= DIRECT
    bounded = materialize(bounded.withColumn("level", _direct_level()[2])
                          .withColumn("direct", near & (F.abs("latitude") <= DIRECT_LATITUDE)), "bounds")
    direct = _around(bounded.filter("direct"))
    start, last = _span(index)
    # Each coordinate meets all top cells, so the few files of the bounds are spread first.
    tasks = max(coords.sparkSession.sparkContext.defaultParallelism, bounded.count() // PER_TASK)
    far = bounded.filter("not direct").repartition(tasks, *_COORDS)
    cells = direct.unionByName(_descended(far, index, start, last))
    levels = sorted({*range(DIRECT, FINEST + 1), last})
    held = _with_cells(places.withColumnsRenamed({c: f"p_{c}" for c in columns}), levels) \
        .withColumnsRenamed({"longitude": "plon", "latitude": "plat"})
    distance = haversine_km(F.col("latitude"), F.col("longitude"), F.col("plat"), F.col("plon"))
    found = cells.join(held, ["level", "cell"]).withColumn("d", distance).filter(F.col("d") <= limit)
    best = found.groupBy(*_COORDS).agg(F.min(F.struct(F.col("d").alias("distance_km"), F.col("plon").alias("lon"),
                                                      F.col("plat").alias("lat"), *(f"p_{c}" for c in columns))).alias("b"))
    return best.select(*_COORDS, *(F.col("b")[f"p_{c}"].alias(c) for c in columns), F.col("b.distance_km").alias("distance_km"))
