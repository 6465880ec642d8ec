"""Airports whose air quality is followed, as a small dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Code, short code, latitude, longitude.
TRACKED_AIRPORTS = [
    ("LFPG", "CDG", 49.0128, 2.5500),
    ("LFPO", "ORY", 48.7233, 2.3794),
    ("LFLL", "LYS", 45.7256, 5.0811),
    ("LFMN", "NCE", 43.6584, 7.2159),
    ("LFML", "MRS", 43.4393, 5.2214),
    ("LFBO", "TLS", 43.6291, 1.3638),
    ("LFBD", "BOD", 44.8283, -0.7156),
    ("LFRS", "NTE", 47.1532, -1.6107),
    ("LFSB", "BSL", 47.5896, 7.5299),
    ("LSZH", "ZRH", 47.4647, 8.5492),
    ("LEBL", "BCN", 41.2971, 2.0785),
    ("LIMC", "MXP", 45.6306, 8.7281),
    ("EGKK", "LGW", 51.1481, -0.1903),
    ("EDDF", "FRA", 50.0379, 8.5622),
]

SCHEMA = "airport_icao string, airport_iata string, latitude double, longitude double"


def tracked_airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRACKED_AIRPORTS, SCHEMA)
