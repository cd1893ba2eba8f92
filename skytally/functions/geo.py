"""Distances, boxes and the nearest reference point."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.constants import AIRPORTS, BOX, EARTH_RADIUS_KM, MAX_REGION_KM, NO_REGION, ZONES

Point = tuple[str, float, float]

GRID_DEGREES = 1.0
GRID_COLUMNS = round(360 / GRID_DEGREES)
BROADCAST_BYTES = 8 * 1024 * 1024
MOST_DEGREES = 36_000  # of longitude, which wraps


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def in_box(lat: Column, lon: Column, box: dict = BOX) -> Column:
    """Inclusive at every edge; a missing coordinate is outside."""
    inside = lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])
    return F.coalesce(inside, F.lit(False))


def zone_of(lat: Column, lon: Column, zones: Sequence[tuple] = ZONES) -> Column:
    """Name of the first zone holding the point, NULL outside all of them."""
    name = None
    for zone, lat_min, lat_max, lon_min, lon_max in zones:
        hit = lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)
        name = F.when(hit, zone) if name is None else name.when(hit, zone)
    return name


def _cells_in_reach(lat: float, lon: float, max_km: float) -> list[int]:
    """Grid cells that may hold a position within ``max_km`` of the point (longitude wraps)."""
    reach = math.degrees(max_km / EARTH_RADIUS_KM)
    south, north = lat - reach, lat + reach
    if south <= -90 or north >= 90:
        columns = range(GRID_COLUMNS)  # a pole is in reach, and with it every longitude
    else:
        spread = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(lat)))))
        west, east = math.floor((lon - spread) / GRID_DEGREES), math.floor((lon + spread) / GRID_DEGREES)
        columns = range(west, min(east, west + GRID_COLUMNS - 1) + 1)
    rows = range(math.floor(max(south, -90.0) / GRID_DEGREES), math.floor(min(north, 90.0) / GRID_DEGREES) + 1)
    return [row * GRID_COLUMNS + column % GRID_COLUMNS for row in rows for column in columns]


def _candidates_by_cell(points: Sequence[Point], max_km: float) -> pa.Table:
    """For each grid cell in reach of any point, the points to compare with, in list order."""
    cells: dict[int, list[dict]] = {}
    for order, (code, lat, lon) in enumerate(points):
        for cell in _cells_in_reach(lat, lon, max_km):
            cells.setdefault(cell, []).append({"lat": lat, "lon": lon, "ord": order, "code": code})
    point = pa.struct([("lat", pa.float64()), ("lon", pa.float64()), ("ord", pa.int32()), ("code", pa.string())])
    return pa.table(
        {
            "__cell": pa.array(list(cells), pa.int64()),
            "__candidates": pa.array(list(cells.values()), pa.list_(point)),
        }
    )


def assign_nearest(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    out: str = "nearest_region",
    km_out: str | None = None,
    points: Sequence[Point] = AIRPORTS,
    max_km: float = MAX_REGION_KM,
    other: str = NO_REGION,
) -> DataFrame:
    """Add the code of the nearest point, ``other`` when none is within ``max_km`` (inclusive).

    The reach of every point is laid out on a grid beforehand, so a row is compared only with the
    points near its cell, mostly none or one. Looking the cell up is a join on one number with a
    table whose size follows from ``points``; it is broadcast when that is small, the big side
    is neither shuffled nor multiplied, and a later filter on the region stays above the join.
    Equally near points are settled by list order. A missing coordinate gives NULL, one that is off the globe
    (infinity and NaN too) ``other``.

    ``km_out`` adds the distance, NULL where the code is ``other``.
    """
    table = _candidates_by_cell(points, max_km)
    grid = df.sparkSession.createDataFrame(table)
    if table.nbytes <= BROADCAST_BYTES:
        grid = F.broadcast(grid)
    latitude, longitude = F.col(lat), F.col(lon)
    row, column = (F.floor(x / GRID_DEGREES) for x in (latitude, longitude))
    # Off the globe there is no cell (and no point in reach); far-off numbers would overflow.
    on_globe = latitude.between(-90, 90) & longitude.between(-MOST_DEGREES, MOST_DEGREES)
    cell = F.when(on_globe, row * GRID_COLUMNS + F.pmod(column, F.lit(GRID_COLUMNS)))

    def distance(point: Column) -> Column:
        km = haversine_km(latitude, longitude, point["lat"], point["lon"])
        return F.struct(km.alias("km"), point["ord"].alias("ord"), point["code"].alias("code"))

    nearest = F.array_min(F.transform("__candidates", distance))
    found = df.withColumn("__cell", cell).join(grid, "__cell", "left").withColumn("__best", nearest)
    best, reached = F.col("__best"), F.col("__best.km") <= max_km
    placed = latitude.isNotNull() & longitude.isNotNull()
    added = {out: F.when(placed, F.when(reached, best["code"]).otherwise(other))}
    if km_out:
        added[km_out] = F.when(reached, best["km"])
    return found.withColumns(added).drop("__cell", "__candidates", "__best")
