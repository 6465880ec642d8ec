"""Nearest place within a radius, without comparing every position to every place.

A distance predicate gives the optimizer no equality to join on, so space is cut into
cells about as wide as the radius. Each *place* is listed under every cell its circle
can reach, and each position looks up its own single cell. The large side is therefore
neither multiplied nor grouped: it meets one array of candidates, takes the smallest
distance in that array, and keeps its row. When the place table is small Spark
broadcasts it (by its own size threshold) and positions are not shuffled at all; beyond
that the same equi-join runs shuffled, and adaptive execution splits a crowded cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from airlake.functions.geo import EARTH_RADIUS_KM, degree_floor, haversine_km

KM_PER_DEGREE = math.radians(1) * EARTH_RADIUS_KM


def cells_per_degree(radius_km: float) -> int:
    """Grid resolution giving cells close to the radius, and one degree at the coarsest."""
    return max(1, int(KM_PER_DEGREE // radius_km))


def _reach(places: DataFrame, radius_km: float, wrap: bool) -> DataFrame:
    """One row per place and cell within reach, as integer columns ``cell_lat, cell_lon``.

    Without ``wrap`` the reach stops one whole degree cell away from the place's own, on
    both axes, which is how the marts define it: close to the poles, and across the 180th
    meridian, farther cells do not count. With ``wrap`` the circle is followed everywhere.
    """
    k = cells_per_degree(radius_km)
    angle = radius_km / EARTH_RADIUS_KM
    slack = 1e-6
    lat, lon = F.col("latitude"), F.col("longitude")
    d_lat = math.degrees(angle) + slack
    shrink = F.cos(F.radians(lat))
    d_lon = F.when(
        F.abs(lat) + d_lat < 90, F.degrees(F.asin(F.lit(math.sin(angle)) / shrink)) + slack
    ).otherwise(180.0)
    south, north = degree_floor(lat - d_lat, k), degree_floor(lat + d_lat, k)
    west, east = degree_floor(lon - d_lon, k), degree_floor(lon + d_lon, k)
    if not wrap:
        south = F.greatest(south, (degree_floor(lat) - 1) * k)
        north = F.least(north, (degree_floor(lat) + 2) * k - 1)
        west = F.greatest(west, (degree_floor(lon) - 1) * k)
        east = F.least(east, (degree_floor(lon) + 2) * k - 1)
    else:
        east = F.least(east, west + (360 * k - 1))
    return (
        places.withColumn("cell_lat", F.explode(F.sequence(south, north)))
        .withColumn("cell_lon", F.explode(F.sequence(west, east)))
        .withColumn("cell_lon", _longitude_cell(F.col("cell_lon"), k, wrap))
    )


def _longitude_cell(cell: Column, k: int, wrap: bool) -> Column:
    return F.pmod(cell + 180 * k, F.lit(360 * k)) - 180 * k if wrap else cell


def places_by_cell(places: DataFrame, place_id: str, radius_km: float, wrap: bool) -> DataFrame:
    """Candidate array per cell.

    Places at one spot can only be told apart by their id, and the smallest id wins a tie,
    so each spot is reduced to that id first. An array then holds distinct spots within
    reach of one small cell.
    """
    spots = places.groupBy("latitude", "longitude").agg(F.min(place_id).alias("place_id"))
    candidate = F.struct("place_id", "latitude", "longitude")
    return (
        _reach(spots, radius_km, wrap)
        .groupBy("cell_lat", "cell_lon")
        .agg(F.collect_list(candidate).alias("candidates"))
    )


def nearest_within(
    positions: DataFrame,
    places: DataFrame,
    radius_km: float,
    *,
    place_id: str,
    distance: str = "distance_km",
    wrap: bool = True,
) -> DataFrame:
    """Positions within ``radius_km`` of a place, with the nearest one's id and distance.

    Both sides carry ``latitude`` and ``longitude``. A position yields at most one row. With
    ``wrap=False`` (see ``_reach``) places more than one whole degree cell away do not count.
    """
    k = cells_per_degree(radius_km)
    cells = places_by_cell(places.select(place_id, "latitude", "longitude"), place_id, radius_km, wrap)
    located = positions.withColumn("cell_lat", degree_floor(F.col("latitude"), k)).withColumn(
        "cell_lon", _longitude_cell(degree_floor(F.col("longitude"), k), k, wrap)
    )
    lat, lon = F.col("latitude"), F.col("longitude")
    measured = F.transform(
        "candidates",
        lambda place: F.struct(
            haversine_km(lat, lon, place["latitude"], place["longitude"]).alias(distance),
            place["place_id"].alias(place_id),
        ),
    )
    nearest = F.filter(F.array(F.array_min(measured)), lambda best: best[distance] <= radius_km)
    return located.join(cells, ["cell_lat", "cell_lon"]).select(
        *positions.columns, F.inline(nearest)
    )
