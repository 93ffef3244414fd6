"""Place completion: missing places (P12), lookup fill (J5 + P15) and
nearest-place reverse geocoding (J9) by the cell index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.scalars import place_name_fallback
from adpulse.operators.cell_index import nearest
from adpulse.schemas import PLACE_COLUMNS

COORDS = ["longitude", "latitude"]


def any_place_missing(cols: Sequence[str] = PLACE_COLUMNS) -> Column:
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return cond


def missing_locations(df: DataFrame) -> DataFrame:
    """P12 + A6: distinct (longitude, latitude) of rows lacking any place part."""
    return df.filter(any_place_missing()).select(*COORDS).distinct()


def normalize_places(places: DataFrame) -> DataFrame:
    """Gazetteer rows -> (longitude, latitude, city, county, state, country):
    city falls back to town, then road (blank text falls through), country
    code upper-cased.  One row per coordinate: the smallest (city, county,
    state, country) wins when a coordinate is listed twice."""
    cols = set(places.columns)
    city_chain = [c for c in ("city", "town", "road") if c in cols]
    shaped = places.select(
        *COORDS,
        place_name_fallback(*city_chain).alias("city"),
        F.col("county"), F.col("state"), F.upper(F.col("country")).alias("country"))
    best = shaped.groupBy(*COORDS).agg(F.min(F.struct(*PLACE_COLUMNS)).alias("__p"))
    return best.select(*COORDS, *[F.col("__p")[c].alias(c) for c in PLACE_COLUMNS])


def fill_from_lookup(df: DataFrame, places: DataFrame) -> DataFrame:
    """J5 + P15: complete null place parts from the place of the same
    (longitude, latitude); a part that is present is never replaced.

    Only rows that lack a part go through the join; complete rows skip the
    shuffle entirely.  The gazetteer is joined by key (AQE broadcasts it when
    its measured size is small, otherwise both sides are hash-partitioned).
    """
    lookup = normalize_places(places).select(*COORDS, *[F.col(c).alias(f"__l_{c}") for c in PLACE_COLUMNS])
    need = df.filter(any_place_missing())
    done = df.filter(~any_place_missing())
    filled = (need.join(lookup, COORDS, "left")
              .withColumns({c: F.coalesce(F.col(c), F.col(f"__l_{c}")) for c in PLACE_COLUMNS})
              .select(*df.columns))
    return done.unionByName(filled)


def nearest_places(coords: DataFrame, places: DataFrame, max_km: float | None = None) -> DataFrame:
    """Nearest place of each distinct (longitude, latitude), however far it is
    (or within ``max_km``, if given), by a multi-level cell index.
    Coordinates without latitude or longitude have no place."""
    return nearest(coords, normalize_places(places), list(PLACE_COLUMNS), max_km)


def reverse_geocode(points: DataFrame, places: DataFrame, id_col: str = "point_id",
                    max_km: float | None = None) -> DataFrame:
    """Each point with its nearest place (nulls if ``max_km`` is given and none is that near)."""
    near = nearest_places(points, places, max_km)
    return (points.join(near, COORDS, "left")
            .select(*points.columns, *PLACE_COLUMNS, "distance_km"))


def fill_from_nearest(df: DataFrame, places: DataFrame, max_km: float | None = None) -> DataFrame:
    """C2 variant: complete null place parts from the nearest place."""
    need = df.filter(any_place_missing())
    done = df.filter(~any_place_missing())
    near = nearest_places(need, places, max_km) \
        .select(*COORDS, *[F.col(c).alias(f"__n_{c}") for c in PLACE_COLUMNS])
    filled = (need.join(near, COORDS, "left")
              .withColumns({c: F.coalesce(F.col(c), F.col(f"__n_{c}")) for c in PLACE_COLUMNS})
              .select(*df.columns))
    return done.unionByName(filled)
