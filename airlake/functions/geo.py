"""Distances, grid cells and named regions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


@dataclass(frozen=True)
class Region:
    """A latitude/longitude rectangle; its edges belong to it."""

    name: str
    south: float
    west: float
    north: float
    east: float

    def contains(self, latitude: Column, longitude: Column) -> Column:
        return latitude.between(self.south, self.north) & longitude.between(self.west, self.east)


# The collection windows.
REGIONS = {
    "france": Region("france", 41.0, -5.5, 51.5, 9.8),
    "benelux": Region("benelux", 49.4, 2.4, 53.6, 7.3),
    "europe": Region("europe", 35.0, -12.0, 62.0, 32.0),
    "world": Region("world", -90.0, -180.0, 90.0, 180.0),
}


def region(name: str) -> Region:
    key = name.strip().lower()
    if key not in REGIONS:
        raise ValueError(f"unknown region {name!r}, expected one of {', '.join(sorted(REGIONS))}")
    return REGIONS[key]


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance on a sphere."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    )
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def degree_floor(angle: Column, cells_per_degree: int = 1) -> Column:
    """Index of the grid line at or below an angle."""
    return F.floor(angle * F.lit(float(cells_per_degree))).cast("int")


def grid_cell(latitude: Column, longitude: Column) -> Column:
    """Readable key of the one-degree cell, e.g. ``48_2``. Joins use the two integers."""
    return F.concat(
        degree_floor(latitude).cast("string"), F.lit("_"), degree_floor(longitude).cast("string")
    )
