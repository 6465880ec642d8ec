"""Position facts: one row per aircraft and instant."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airlake.functions.flight import feet, flight_phase, knots
from airlake.functions.moments import seconds_between
from airlake.operators.pick import keep_latest
from airlake.plans.staging import stg_states

GRAIN = ["aircraft_icao24", "snapshot_at"]


def int_positions_deduplicated(stg_states: DataFrame) -> DataFrame:
    """Keep the version ingested last for each aircraft and instant."""
    return keep_latest(stg_states, GRAIN, "ingested_at")


def fct_aircraft_positions(deduplicated: DataFrame) -> DataFrame:
    """Unit conversions, flight phase and position age; narrow."""
    c = F.col
    return deduplicated.select(
        "aircraft_icao24",
        "snapshot_at",
        "callsign",
        "origin_country",
        "latitude",
        "longitude",
        "barometric_altitude_m",
        "geometric_altitude_m",
        feet(c("barometric_altitude_m")).alias("barometric_altitude_ft"),
        "ground_speed_ms",
        knots(c("ground_speed_ms")).alias("ground_speed_kt"),
        "heading_deg",
        "vertical_rate_ms",
        "is_on_ground",
        "squawk",
        "has_special_purpose_indicator",
        flight_phase(c("is_on_ground"), c("vertical_rate_ms")).alias("flight_phase"),
        seconds_between(c("position_at"), c("snapshot_at")).alias("position_age_seconds"),
        "ingestion_region",
        "ingested_at",
        "ingest_date",
        "ingest_hour",
    )


def positions_from_states(states: DataFrame) -> DataFrame:
    """Raw states to facts in one plan."""
    return fct_aircraft_positions(int_positions_deduplicated(stg_states(states)))
