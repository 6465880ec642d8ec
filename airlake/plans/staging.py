"""Staging: one cleaned, typed frame per raw source. Narrow, except the two de-duplications."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airlake.functions.text import blank_to_null, parse_double, parse_int, strip
from airlake.functions.moments import hour_bucket
from airlake.operators.pick import keep_first

# The airfield kinds fixed-wing traffic uses.
AIRFIELD_TYPES = ("large_airport", "medium_airport", "small_airport")


def stg_states(states: DataFrame) -> DataFrame:
    """Positions with a usable place; out-of-range coordinates are wrong, not missing."""
    c = F.col
    usable = (
        c("icao24").isNotNull()
        & c("latitude").between(-90.0, 90.0)
        & c("longitude").between(-180.0, 180.0)
    )
    return states.where(usable).select(
        F.lower(strip(c("icao24"))).alias("aircraft_icao24"),
        blank_to_null(c("callsign")).alias("callsign"),
        blank_to_null(c("origin_country")).alias("origin_country"),
        F.timestamp_seconds("snapshot_ts").alias("snapshot_at"),
        F.timestamp_seconds("time_position").alias("position_at"),
        F.timestamp_seconds("last_contact").alias("last_contact_at"),
        "longitude",
        "latitude",
        c("baro_altitude").alias("barometric_altitude_m"),
        c("geo_altitude").alias("geometric_altitude_m"),
        F.coalesce("on_ground", F.lit(False)).alias("is_on_ground"),
        c("velocity").alias("ground_speed_ms"),
        c("true_track").alias("heading_deg"),
        c("vertical_rate").alias("vertical_rate_ms"),
        blank_to_null(c("squawk")).alias("squawk"),
        F.coalesce("spi", F.lit(False)).alias("has_special_purpose_indicator"),
        c("position_source").alias("position_source_code"),
        c("category").alias("aircraft_category_code"),
        c("region").alias("ingestion_region"),
        "ingested_at",
        c("ingest_date").cast("date").alias("ingest_date"),
        c("ingest_hour").cast("int").alias("ingest_hour"),
    )


def stg_airports(airports: DataFrame) -> DataFrame:
    """Fixed-wing airfields; unreadable numbers become null instead of failing the build."""
    c = F.col
    scheduled = F.lower(strip(F.coalesce("scheduled_service", F.lit(""))))
    typed = airports.select(
        parse_int(c("id")).alias("airport_id"),
        blank_to_null(c("ident")).alias("airport_ident"),
        blank_to_null(c("type")).alias("airport_type"),
        blank_to_null(c("name")).alias("airport_name"),
        parse_double(c("latitude_deg")).alias("latitude"),
        parse_double(c("longitude_deg")).alias("longitude"),
        parse_int(c("elevation_ft")).alias("elevation_ft"),
        *[
            blank_to_null(c(name)).alias(name)
            for name in ("continent", "iso_country", "iso_region", "municipality")
        ],
        (scheduled == "yes").alias("has_scheduled_service"),
        *[blank_to_null(c(name)).alias(name) for name in ("icao_code", "iata_code", "gps_code")],
    )
    return typed.where(
        c("airport_type").isin(*AIRFIELD_TYPES)
        & c("airport_id").isNotNull()
        & c("latitude").isNotNull()
        & c("longitude").isNotNull()
    )


def stg_air_quality(air_quality: DataFrame) -> DataFrame:
    """Hourly pollutants, truncated to the hour so that they join hourly activity."""
    c = F.col
    return air_quality.where(c("airport_icao").isNotNull() & c("measured_at").isNotNull()).select(
        F.upper(strip(c("airport_icao"))).alias("airport_icao"),
        blank_to_null(c("airport_iata")).alias("airport_iata"),
        "latitude",
        "longitude",
        hour_bucket(c("measured_at")).alias("measured_hour"),
        c("nitrogen_dioxide").alias("no2_ugm3"),
        c("pm2_5").alias("pm25_ugm3"),
        c("pm10").alias("pm10_ugm3"),
        c("ozone").alias("ozone_ugm3"),
        "ingested_at",
    )


def stg_registry(registry: DataFrame) -> DataFrame:
    """One row per 24-bit address, preferring an entry that has a registration."""
    c = F.col
    typed = registry.select(
        F.lower(strip(c("icao24"))).alias("aircraft_icao24"),
        blank_to_null(c("registration")).alias("registration"),
        blank_to_null(c("typecode")).alias("aircraft_type"),
        blank_to_null(c("manufacturername")).alias("manufacturer"),
        blank_to_null(c("model")).alias("model"),
        blank_to_null(c("operator")).alias("operator"),
        F.upper(blank_to_null(c("operatoricao"))).alias("operator_icao"),
        blank_to_null(c("owner")).alias("owner"),
        parse_int(F.left(strip(c("built")), F.lit(4))).alias("built_year"),
        blank_to_null(c("categoryDescription")).alias("category_description"),
    ).where(F.length("aircraft_icao24") == 6)
    return keep_first(
        typed, ["aircraft_icao24"], c("registration").isNull(), c("registration")
    )


def stg_airlines(airlines: DataFrame) -> DataFrame:
    """One row per three-letter code, preferring an active airline."""
    c = F.col
    typed = airlines.select(
        F.upper(blank_to_null(c("icao"))).alias("airline_icao"),
        blank_to_null(c("name")).alias("airline_name"),
        F.upper(blank_to_null(c("iata"))).alias("airline_iata"),
        blank_to_null(c("country")).alias("country"),
        (strip(F.coalesce("active", F.lit(""))) == "Y").alias("is_active"),
    ).where((F.length("airline_icao") == 3) & c("airline_name").isNotNull())
    return keep_first(typed, ["airline_icao"], ~c("is_active"), c("airline_name"))
