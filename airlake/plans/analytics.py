"""Consumption queries: they read marts only and return small frames.

Facts have one row per aircraft and instant, so counting aircraft inside one snapshot is
counting rows; no distinct is needed there.

Fixed values: the French result names are the columns that the dashboards expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airlake.functions.flight import UNKNOWN
from airlake.functions.text import airline_prefix, strip
from airlake.operators.correlate import correlation_by, correlation_levels
from airlake.operators.keys import top_k

SCHEDULE_MINUTES = 15


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


# Freshness and overview ---------------------------------------------------------------


def overview(positions: DataFrame) -> DataFrame:
    """Size and span of the history; each distinct count has its own spread shuffle, so the fact
    is not multiplied by the number of distinct columns."""
    per_snapshot = positions.groupBy("snapshot_at").agg(_rows("n"))
    aircraft = positions.agg(F.count_distinct("aircraft_icao24").alias("n")).scalar()
    return per_snapshot.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("positions"),
        F.count("snapshot_at").alias("snapshots"),
        F.min("snapshot_at").alias("debut"),
        F.max("snapshot_at").alias("fin"),
    ).select("positions", aircraft.alias("aeronefs"), "snapshots", "debut", "fin")


def active_airports(airport_activity: DataFrame) -> DataFrame:
    return airport_activity.agg(F.count_distinct("airport_id").alias("n"))


def signal_status(positions: DataFrame, now: Column) -> DataFrame:
    """Age of the last snapshot, history length, and whether a collection was missed."""
    spans = positions.agg(F.min("snapshot_at").alias("debut"), F.max("snapshot_at").alias("fin"))
    age = (F.unix_micros(now) - F.unix_micros("fin")) / F.lit(6e7)
    span = (F.unix_micros("fin") - F.unix_micros("debut")) / F.lit(3.6e9)
    return spans.select(
        "fin",
        age.alias("age_minutes"),
        span.alias("span_hours"),
        F.when(age <= SCHEDULE_MINUTES + 5, "ok")
        .when(age <= SCHEDULE_MINUTES * 3, "warn")
        .otherwise("err")
        .alias("status"),
    )


def latest_region(positions: DataFrame) -> DataFrame:
    newest = F.max(F.struct("snapshot_at", "ingestion_region"))
    return positions.agg(newest["ingestion_region"].alias("ingestion_region"))


# Snapshots ----------------------------------------------------------------------------


def snapshot_series(positions: DataFrame) -> DataFrame:
    return (
        positions.groupBy("snapshot_at")
        .agg(_rows("positions"), _rows("aeronefs"), F.count_if("is_on_ground").alias("au_sol"))
        .orderBy("snapshot_at")
    )


def latest_slice(positions: DataFrame) -> DataFrame:
    """Rows of the newest snapshot.

    Give it the newest partition of the facts (``Warehouse.newest``): partitions follow from the snapshot time,
    so the newest snapshot is in it, and no other file is opened.
    """
    newest = positions.select(F.max("snapshot_at")).scalar()
    return positions.where(F.col("snapshot_at") == newest)


def latest_snapshot(positions: DataFrame) -> DataFrame:
    return latest_slice(positions).select(
        "latitude",
        "longitude",
        "callsign",
        "origin_country",
        "barometric_altitude_ft",
        "ground_speed_kt",
        "flight_phase",
        "aircraft_icao24",
    )


def flight_phase_mix(positions: DataFrame) -> DataFrame:
    return latest_slice(positions).groupBy("flight_phase").agg(_rows("aeronefs"))


def latest_medians(positions: DataFrame) -> DataFrame:
    """Exact medians of one snapshot in one scan: tasks send distinct values with their counts, and
    one snapshot's values are bounded by the aircraft in the air."""
    return latest_slice(positions).agg(
        F.median("barometric_altitude_ft").alias("median_altitude_ft"),
        F.median("ground_speed_kt").alias("median_speed_kt"),
    )


# Rankings -----------------------------------------------------------------------------


def hourly_trend(traffic_hourly: DataFrame) -> DataFrame:
    return (
        traffic_hourly.groupBy("traffic_hour")
        .agg(F.sum("position_count").alias("positions"))
        .orderBy("traffic_hour")
    )


def top_countries(traffic_hourly: DataFrame, k: int = 12) -> DataFrame:
    totals = traffic_hourly.groupBy("origin_country").agg(F.sum("position_count").alias("positions"))
    return top_k(totals, k, "positions", "origin_country")


def top_airports(airport_activity: DataFrame, k: int = 15) -> DataFrame:
    """Busiest airports by aircraft-hours: hourly distinct counts are summed, as dashboards do."""
    totals = airport_activity.groupBy(
        F.col("airport_label").alias("aeroport"), F.col("airport_municipality").alias("ville")
    ).agg(
        F.sum("distinct_aircraft").alias("aeronefs"),
        F.sum("descending_aircraft").alias("en_approche"),
        F.sum("climbing_aircraft").alias("en_montee"),
        F.round(F.avg("avg_distance_km"), 2).alias("distance_moy_km"),
    )
    return top_k(totals, k, "aeronefs", "aeroport", "ville")


def top_airports_exact(near_airports: DataFrame, k: int = 15) -> DataFrame:
    """Busiest airports by aircraft really distinct over the whole period."""
    names = ["airport_label", "airport_municipality"]
    totals = (
        near_airports.groupBy(*names, "aircraft_icao24")
        .agg(F.lit(1).alias("seen"))
        .groupBy(F.col("airport_label").alias("aeroport"), F.col("airport_municipality").alias("ville"))
        .agg(F.sum("seen").alias("aeronefs"))
    )
    return top_k(totals, k, "aeronefs", "aeroport", "ville")


def airline_rows(airline_activity: DataFrame) -> DataFrame:
    return airline_activity.where(F.col("airline_name").isNotNull()).agg(_rows("n"))


def top_airline_airports(airline_activity: DataFrame, k: int = 12) -> DataFrame:
    identified = airline_activity.where(
        F.col("airline_name").isNotNull() & F.col("airport_iata_code").isNotNull()
    )
    totals = identified.groupBy("airport_iata_code", "airport_label").agg(
        F.sum("distinct_aircraft").alias("n")
    )
    return top_k(totals, k, "n", "airport_iata_code", "airport_label")


def airline_market_share(airline_activity: DataFrame, airport_iata: str, k: int = 10) -> DataFrame:
    """The airport code is bound as a literal, never pasted into SQL."""
    here = airline_activity.where(
        (F.col("airport_iata_code") == F.lit(airport_iata)) & F.col("airline_name").isNotNull()
    )
    totals = here.groupBy("airline_name").agg(F.sum("distinct_aircraft").alias("aeronefs"))
    return top_k(totals, k, "aeronefs", "airline_name")


def airline_market_share_exact(near_airports: DataFrame, airlines: DataFrame) -> DataFrame:
    """Distinct aircraft per airport and identified airline over the whole period."""
    callsign = strip(F.col("callsign"))
    pairs = (
        near_airports.where((F.length(callsign) >= 3) & F.col("airport_iata_code").isNotNull())
        .groupBy("airport_iata_code", airline_prefix(callsign).alias("airline_icao"), "aircraft_icao24")
        .agg(F.lit(1).alias("seen"))
    )
    totals = pairs.groupBy("airport_iata_code", "airline_icao").agg(F.sum("seen").alias("aeronefs"))
    return totals.join(airlines.select("airline_icao", "airline_name"), "airline_icao")


def manufacturer_mix(aircraft: DataFrame) -> DataFrame:
    return (
        aircraft.where(F.col("manufacturer_group") != UNKNOWN)
        .groupBy("manufacturer_group")
        .agg(_rows("aeronefs"))
        .orderBy(F.desc("aeronefs"), "manufacturer_group")
    )


def top_aircraft_types(aircraft: DataFrame, k: int = 15) -> DataFrame:
    totals = (
        aircraft.where(F.col("aircraft_type").isNotNull())
        .groupBy("aircraft_type")
        .agg(_rows("aeronefs"))
    )
    return top_k(totals, k, "aeronefs", "aircraft_type")


# Traffic and air quality --------------------------------------------------------------

# Panel column -> pollutant name.
POLLUTANTS = {"no2_ugm3": "NO2", "pm25_ugm3": "PM2.5"}


def dashboard_correlation(panel: DataFrame) -> DataFrame:
    """Traffic against NO2: plain, and within airports."""
    return correlation_levels(
        panel, "distinct_aircraft", "no2_ugm3", {"r_naive": [], "r_within": ["airport_id"]}
    )


def correlation_study(panel: DataFrame, airport_key: str = "airport_iata_code") -> DataFrame:
    """Three levels of control for each pollutant: plain, within airport, within airport and
    hour of day. Airports without a code only take part in the plain level."""
    levels = {"naive": [], "within": [airport_key], "resid": [airport_key, "hour_of_day"]}
    parts = [
        correlation_levels(panel, "distinct_aircraft", column, levels).select(
            F.lit(name).alias("pollutant"), "n", *levels
        )
        for column, name in POLLUTANTS.items()
    ]
    return parts[0].unionByName(parts[1])


def correlation_per_airport(
    panel: DataFrame, pollutant: str = "no2_ugm3", min_hours: int = 10
) -> DataFrame:
    """Correlation airport by airport, where enough hours exist, most negative first."""
    coded = panel.where(F.col("airport_iata_code").isNotNull())
    return (
        correlation_by(coded, "distinct_aircraft", pollutant, ["airport_iata_code"], min_hours)
        .select(
            F.col("airport_iata_code").alias("aeroport"), F.col("n").alias("heures"), "r"
        )
        .orderBy(F.asc_nulls_last("r"), "aeroport")
    )


def negative_airports(per_airport: DataFrame) -> DataFrame:
    return per_airport.agg(_rows("airports"), F.count_if(F.col("r") < 0).alias("negative"))


def panel_summary(panel: DataFrame) -> DataFrame:
    return panel.agg(
        _rows("observations"),
        F.count_distinct("airport_iata_code").alias("airports"),
        F.min("activity_hour").alias("first_hour"),
        F.max("activity_hour").alias("last_hour"),
    )


def scatter_panel(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("no2_ugm3").isNotNull()).select(
        "distinct_aircraft", "no2_ugm3", "airport_iata_code"
    )
