"""Distances and grid arithmetic on latitudes and longitudes in degrees; one sphere of 6371 km throughout."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_M = 6_371_000.0
#: Metres of one degree of latitude on the sphere, for search boxes.
DEGREE_M = RADIUS_M * math.pi / 180
#: Kilometres of a degree as the grid planner counts them (a fixed value).
KM_PER_DEGREE = 111.32
#: Steps of the cell grid in degrees, near the area of a cell of 0.1 km2 at this latitude.
CELL_STEP = 0.003


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x)) if isinstance(x, (int, float)) else F.col(x)


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    """Metres between two points; null if any coordinate is."""
    a1, o1, a2, o2 = map(_c, (lat1, lng1, lat2, lng2))
    a = F.pow(F.sin(F.radians(a2 - a1) / 2), 2) + F.cos(F.radians(a1)) * F.cos(F.radians(a2)) * F.pow(F.sin(F.radians(o2 - o1) / 2), 2)
    return 2 * RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_sql(a1: str, o1: str, a2: str, o2: str) -> str:
    """The same distance as SQL text."""
    a = f"(power(sin(radians({a2} - {a1}) / 2), 2) + cos(radians({a1})) * cos(radians({a2})) * power(sin(radians({o2} - {o1}) / 2), 2))"
    return f"(2 * CAST(6371000 AS DOUBLE) * atan2(sqrt({a}), sqrt(1 - {a})))"


def in_box(lat, lng, lat0: float, lng0: float, metres: float) -> Column:
    """A box around a point that holds its circle: plain ranges, which reach a Parquet scan."""
    high = min(89.9, abs(lat0) + metres / DEGREE_M)
    dy, dx = metres / DEGREE_M * 1.0001, metres / (DEGREE_M * math.cos(math.radians(high))) * 1.0001
    return _c(lat).between(lat0 - dy, lat0 + dy) & _c(lng).between(lng0 - dx, lng0 + dx)


def within(lat, lng, lat0: float, lng0: float, metres: float) -> Column:
    return in_box(lat, lng, lat0, lng0, metres) & (haversine_m(lat, lng, lat0, lng0) <= metres)


def km_to_degrees_lat(km) -> Column:
    return _c(km) / KM_PER_DEGREE


def km_to_degrees_lng(km, lat) -> Column:
    return _c(km) / (KM_PER_DEGREE * F.cos(F.radians(_c(lat))))


def cell_id(lat, lng, step: float = CELL_STEP) -> Column:
    """Number of the square cell that a point lies in."""
    return (F.floor((_c(lat) + 90.0) / step) * 1_000_000 + F.floor((_c(lng) + 180.0) / step)).cast("bigint")


def block_id(lat, lng, step: float = 0.1) -> Column:
    return F.concat_ws("_", F.floor(_c(lat) / step).cast("string"), F.floor(_c(lng) / step).cast("string"))


def box_area_km2(lat_min, lat_max, lng_min, lng_max) -> Column:
    middle = (_c(lat_min) + _c(lat_max)) / 2
    return F.abs(_c(lat_max) - _c(lat_min)) * KM_PER_DEGREE * F.abs(_c(lng_max) - _c(lng_min)) * KM_PER_DEGREE * F.cos(F.radians(middle))


#: Areas in km2, strictly above which a zoom level holds, from the largest down (fixed values).
ZOOM_LEVELS = ((500, 10), (100, 12), (25, 14), (5, 15), (1, 16), (0.25, 17), (0.06, 18), (0.015, 19))


def zoom_level(area_km2) -> Column:
    area = _c(area_km2)
    out = F.when(area > ZOOM_LEVELS[0][0], ZOOM_LEVELS[0][1])
    for least, zoom in ZOOM_LEVELS[1:]:
        out = out.when(area > least, zoom)
    return out.otherwise(20).cast("int")


def quadrants(cell: Column) -> Column:
    """The four quarters of a cell struct (lat_min, lat_max, lng_min, lng_max): SW, SE, NW, NE."""
    lat, lng = (cell["lat_min"] + cell["lat_max"]) / 2, (cell["lng_min"] + cell["lng_max"]) / 2
    make = lambda a, b, c, d: F.struct(a.alias("lat_min"), b.alias("lat_max"), c.alias("lng_min"), d.alias("lng_max"))
    return F.array(
        make(cell["lat_min"], lat, cell["lng_min"], lng), make(cell["lat_min"], lat, lng, cell["lng_max"]), make(lat, cell["lat_max"], cell["lng_min"], lng), make(lat, cell["lat_max"], lng, cell["lng_max"])
    )
