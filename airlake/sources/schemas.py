"""Declared schemas of the raw (bronze) tables.

They are never inferred: a column that is null throughout one file would otherwise get
another type there and break reads over the whole lake.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The order of the positional state vector.
STATE_VECTOR = (
    ("icao24", T.StringType()),
    ("callsign", T.StringType()),
    ("origin_country", T.StringType()),
    ("time_position", T.LongType()),
    ("last_contact", T.LongType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("baro_altitude", T.DoubleType()),
    ("on_ground", T.BooleanType()),
    ("velocity", T.DoubleType()),
    ("true_track", T.DoubleType()),
    ("vertical_rate", T.DoubleType()),
    ("sensors", T.ArrayType(T.IntegerType())),
    ("geo_altitude", T.DoubleType()),
    ("squawk", T.StringType()),
    ("spi", T.BooleanType()),
    ("position_source", T.IntegerType()),
    ("category", T.IntegerType()),
)

STATES = T.StructType(
    [T.StructField(name, kind, name != "icao24") for name, kind in STATE_VECTOR]
    + [
        T.StructField("snapshot_ts", T.LongType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)

STATES_PARTITIONS = T.StructType(
    [
        T.StructField("ingest_date", T.DateType()),
        T.StructField("ingest_hour", T.IntegerType()),
    ]
)

LAKE_STATES = T.StructType(STATES.fields + STATES_PARTITIONS.fields)

AIR_QUALITY = T.StructType(
    [
        T.StructField("airport_icao", T.StringType(), False),
        T.StructField("airport_iata", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("measured_at", T.TimestampType(), False),
        T.StructField("nitrogen_dioxide", T.DoubleType()),
        T.StructField("pm2_5", T.DoubleType()),
        T.StructField("pm10", T.DoubleType()),
        T.StructField("ozone", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("source", T.StringType(), False),
    ]
)


def text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column order of the reference files.
AIRPORTS = text_columns(
    "id", "ident", "type", "name", "latitude_deg", "longitude_deg", "elevation_ft", "continent",
    "iso_country", "iso_region", "municipality", "scheduled_service", "icao_code", "iata_code",
    "gps_code", "local_code", "home_link", "wikipedia_link", "keywords",
)
REGISTRY = text_columns(
    "icao24", "registration", "typecode", "manufacturername", "model", "operator", "operatoricao",
    "owner", "built", "categoryDescription",
)
AIRLINES = text_columns(
    "airline_id", "name", "alias", "iata", "icao", "callsign", "country", "active",
)
