"""The star schema: dimensions, aggregated facts and the traffic × air-quality panel.

Distinct counts go through an intermediate grain (group × aircraft) carrying flags. The
first shuffle is spread over aircraft, so a group holding a large share of all rows is
still cut into many pieces, and the second one only moves partial sums. Descriptive
columns are joined after the aggregation, on the dimension's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airlake.functions.flight import (
    CLIMB,
    CRUISE,
    DESCENT,
    UNKNOWN,
    manufacturer_group,
)
from airlake.functions.geo import grid_cell
from airlake.functions.moments import (
    day_of_week,
    hour_bucket,
    hour_of_day,
    ratio,
    second_boundaries,
)
from airlake.functions.text import airline_prefix, display_label, strip
from airlake.operators.median import grouped_median
from airlake.operators.pick import most_frequent
from airlake.operators.proximity import KM_PER_DEGREE, nearest_within

RADIUS_KM = 8.0
APPROACH_ALTITUDE_M = 1200.0
# Logarithm of the registers of a sketch: at most 8 KB per airport and hour, and far less where few aircraft are.
SKETCH_BITS = 14


# Dimensions ---------------------------------------------------------------------------


def dim_airport(stg_airports: DataFrame) -> DataFrame:
    c = F.col
    return stg_airports.select(
        "airport_id",
        "airport_ident",
        F.coalesce("icao_code", "gps_code", "airport_ident").alias("icao_code"),
        "iata_code",
        "airport_name",
        "airport_type",
        "latitude",
        "longitude",
        "elevation_ft",
        "continent",
        "iso_country",
        "iso_region",
        "municipality",
        "has_scheduled_service",
        display_label(c("airport_name"), c("iata_code")).alias("airport_label"),
        grid_cell(c("latitude"), c("longitude")).alias("grid_cell"),
    )


def dim_airline(stg_airlines: DataFrame) -> DataFrame:
    return stg_airlines.select(
        "airline_icao", "airline_name", "airline_iata", "country", "is_active"
    )


def aircraft_usage(positions: DataFrame) -> DataFrame:
    """Facts counted per aircraft, callsign and day: the additive grain that both profile parts start
    from, kept as a table so that the profile needs no fact and a day is refreshed alone."""
    return positions.groupBy(
        "aircraft_icao24", "callsign", "ingest_date", "origin_country"
    ).agg(
        F.min("snapshot_at").alias("first_seen_at"),
        F.max("snapshot_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("observation_count"),
        F.max("barometric_altitude_m").alias("max_altitude_m"),
        F.max("ground_speed_kt").alias("max_ground_speed_kt"),
        F.count_if("is_on_ground").alias("ground_count"),
    )


def aircraft_profile(usage: DataFrame) -> DataFrame:
    return usage.groupBy("aircraft_icao24").agg(
        F.min("origin_country").alias("origin_country"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("observation_count").alias("observation_count"),
        F.count_distinct("callsign").alias("distinct_callsign_count"),
        F.count_distinct("ingest_date").alias("active_day_count"),
        F.max("max_altitude_m").alias("max_altitude_m"),
        F.max("max_ground_speed_kt").alias("max_ground_speed_kt"),
        ratio(F.sum("ground_count"), F.sum("observation_count")).alias("on_ground_ratio"),
    )


def usual_callsign(usage: DataFrame) -> DataFrame:
    return most_frequent(usage, ["aircraft_icao24"], "callsign", weight="observation_count")


def dim_aircraft(usage: DataFrame, registry: DataFrame, airlines: DataFrame) -> DataFrame:
    """Observed profile of each aircraft (from :func:`aircraft_usage`), enriched with the registry and the
    airline."""
    profile = aircraft_profile(usage)
    callsigns = usual_callsign(usage).select(
        "aircraft_icao24", F.col("callsign").alias("most_frequent_callsign")
    )
    described = registry.select(
        "aircraft_icao24",
        "registration",
        "aircraft_type",
        "manufacturer",
        "model",
        "operator",
        "built_year",
    )
    named = airlines.select("airline_icao", "airline_name", F.col("country").alias("airline_country"))
    return (
        profile.join(callsigns, "aircraft_icao24", "left")
        .join(described, "aircraft_icao24", "left")
        .withColumn("airline_icao", airline_prefix(F.col("most_frequent_callsign")))
        .join(named, "airline_icao", "left")
        .select(
            *profile.columns,
            "most_frequent_callsign",
            second_boundaries(F.col("first_seen_at"), F.col("last_seen_at")).alias(
                "observed_span_seconds"
            ),
            *[name for name in described.columns if name != "aircraft_icao24"],
            manufacturer_group(F.col("manufacturer")).alias("manufacturer_group"),
            "airline_icao",
            "airline_name",
            "airline_country",
        )
    )


# Proximity ----------------------------------------------------------------------------


def low_positions(positions: DataFrame, ceiling_m: float = APPROACH_ALTITUDE_M) -> DataFrame:
    """Positions that can belong to an airport: on the ground or under the approach ceiling."""
    return positions.where(F.col("is_on_ground") | (F.col("barometric_altitude_m") <= ceiling_m))


def int_positions_near_airports(
    positions: DataFrame,
    airports: DataFrame,
    *,
    radius_km: float = RADIUS_KM,
    ceiling_m: float = APPROACH_ALTITUDE_M,
    wrap: bool = False,
) -> DataFrame:
    """Each low position with its nearest airport inside the radius.

    Without ``wrap`` only neighbouring degree cells are looked at; a radius beyond one degree would lose
    airports there and is refused.
    """
    if not wrap and radius_km > KM_PER_DEGREE:
        raise ValueError(f"a radius of {radius_km} km needs wrap=True")
    low = low_positions(positions, ceiling_m).select(
        "aircraft_icao24",
        "snapshot_at",
        "callsign",
        "origin_country",
        "latitude",
        "longitude",
        "barometric_altitude_m",
        "ground_speed_kt",
        "vertical_rate_ms",
        "is_on_ground",
        "flight_phase",
        "ingest_date",
        "ingest_hour",
    )
    matched = nearest_within(low, airports, radius_km, place_id="airport_id", wrap=wrap)
    return with_airport(matched, airports, "airport_name", "airport_municipality").select(
        *low.columns, "airport_id", *AIRPORT_COLUMNS, "distance_km"
    )


AIRPORT_COLUMNS = [
    "airport_icao_code",
    "airport_iata_code",
    "airport_name",
    "airport_label",
    "airport_iso_country",
    "airport_municipality",
]


def with_airport(df: DataFrame, airports: DataFrame, *extra: str) -> DataFrame:
    """Attach the airport's descriptive columns by its id."""
    described = airports.select(
        "airport_id",
        F.col("icao_code").alias("airport_icao_code"),
        F.col("iata_code").alias("airport_iata_code"),
        "airport_label",
        F.col("iso_country").alias("airport_iso_country"),
        *[
            F.col("municipality").alias(name) if name == "airport_municipality" else F.col(name)
            for name in extra
        ],
    )
    return df.join(described, "airport_id")


# Aggregated facts ---------------------------------------------------------------------


def _by_aircraft(df: DataFrame, keys: list[str], flags: dict[str, Column], **sums) -> DataFrame:
    """One row per group and aircraft: 0/1 flags (did it ever hold?) and mergeable measures."""
    return df.groupBy(*keys, "aircraft_icao24").agg(
        F.count(F.lit(1)).alias("position_count"),
        *[F.max(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in flags.items()],
        *[measure.alias(name) for name, measure in sums.items()],
    )


def fct_traffic_hourly(positions: DataFrame) -> DataFrame:
    """Traffic per hour, day, country and region.

    Three narrow pre-aggregations (per aircraft, per snapshot, per altitude) are united and
    rolled up once; grouping rather than joining them keeps null keys.
    """
    c = F.col
    keys = ["traffic_hour", "ingest_date", "origin_country", "ingestion_region"]
    base = positions.select(
        hour_bucket(c("snapshot_at")).alias("traffic_hour"),
        "ingest_date",
        F.coalesce("origin_country", F.lit(UNKNOWN)).alias("origin_country"),
        "ingestion_region",
        "aircraft_icao24",
        "snapshot_at",
        "is_on_ground",
        "flight_phase",
        "barometric_altitude_m",
        "ground_speed_kt",
    )
    aircraft = _by_aircraft(
        base,
        keys,
        {"ground": c("is_on_ground"), "cruise": c("flight_phase") == CRUISE},
        altitude_sum=F.sum("barometric_altitude_m"),
        altitude_count=F.count("barometric_altitude_m"),
        speed_sum=F.sum("ground_speed_kt"),
        speed_count=F.count("ground_speed_kt"),
        speed_max=F.max("ground_speed_kt"),
    ).withColumn("aircraft", F.lit(1))
    snapshots = base.groupBy(*keys, "snapshot_at").agg(F.lit(1).alias("snapshots"))
    medians = grouped_median(base, keys, "barometric_altitude_m")
    parts = aircraft.drop("aircraft_icao24")
    for part in (snapshots.drop("snapshot_at"), medians):
        parts = parts.unionByName(part, allowMissingColumns=True)
    totals = parts.groupBy(*keys).agg(
        F.sum("aircraft").alias("distinct_aircraft"),
        F.sum("position_count").alias("position_count"),
        F.sum("snapshots").alias("snapshot_count"),
        F.sum("ground").alias("aircraft_on_ground"),
        F.sum("cruise").alias("aircraft_cruising"),
        F.round(ratio(F.sum("altitude_sum"), F.sum("altitude_count")), 0).alias("avg_altitude_m"),
        F.round(F.max("median"), 0).alias("median_altitude_m"),
        F.round(ratio(F.sum("speed_sum"), F.sum("speed_count")), 1).alias("avg_ground_speed_kt"),
        F.max("speed_max").alias("max_ground_speed_kt"),
    )
    return totals.withColumn(
        "avg_aircraft_per_snapshot", F.round(ratio(c("position_count"), c("snapshot_count")), 1)
    )


def fct_airport_activity(near_airports: DataFrame, airports: DataFrame) -> DataFrame:
    """Activity per airport and hour; climbs and descents are inferred, not declared."""
    c = F.col
    keys = ["airport_id", "activity_hour", "ingest_date"]
    aircraft = _by_aircraft(
        near_airports.withColumn("activity_hour", hour_bucket(c("snapshot_at"))),
        keys,
        {
            "climbing": c("flight_phase") == CLIMB,
            "descending": c("flight_phase") == DESCENT,
            "ground": c("is_on_ground"),
        },
        distance_sum=F.sum("distance_km"),
        altitude_sum=F.sum("barometric_altitude_m"),
        altitude_count=F.count("barometric_altitude_m"),
        speed_max=F.max("ground_speed_kt"),
    )
    hourly = aircraft.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("distinct_aircraft"),
        F.sum("position_count").alias("position_count"),
        F.sum("climbing").alias("climbing_aircraft"),
        F.sum("descending").alias("descending_aircraft"),
        F.sum("ground").alias("ground_aircraft"),
        F.round(ratio(F.sum("distance_sum"), F.sum("position_count")), 2).alias("avg_distance_km"),
        F.round(ratio(F.sum("altitude_sum"), F.sum("altitude_count")), 0).alias("avg_altitude_m"),
        F.max("speed_max").alias("max_ground_speed_kt"),
    )
    return with_airport(hourly, airports, "airport_municipality").select(
        "airport_id",
        "airport_icao_code",
        "airport_iata_code",
        "airport_label",
        "airport_iso_country",
        "airport_municipality",
        "activity_hour",
        "ingest_date",
        *[name for name in hourly.columns if name not in keys],
    )


def fct_airport_aircraft_sketches(near_airports: DataFrame) -> DataFrame:
    """A mergeable sketch of the aircraft at each airport in each hour.

    Distinct counts cannot be added over hours; sketches can be united (:func:`aircraft_over`).
    """
    hour = hour_bucket(F.col("snapshot_at")).alias("activity_hour")
    sketch = F.hll_sketch_agg("aircraft_icao24", F.lit(SKETCH_BITS))
    return near_airports.groupBy("airport_id", hour, "ingest_date").agg(sketch.alias("aircraft_sketch"))


def aircraft_over(sketches: DataFrame, *keys: str) -> DataFrame:
    """Distinct aircraft per group over all its hours, from one small row per airport and hour.

    The relative error has a standard deviation of 1.04 / sqrt(2 ** SKETCH_BITS), 0.8 %; up to some hundred
    aircraft the count is exact.
    """
    united = F.hll_union_agg("aircraft_sketch")
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(united).alias("distinct_aircraft"))


def fct_airline_airport_activity(
    near_airports: DataFrame, airports: DataFrame, airlines: DataFrame
) -> DataFrame:
    """Aircraft and observations per airport and airline code; unknown codes keep a null name."""
    keys = ["airport_id", "airline_icao"]
    callsign = strip(F.col("callsign"))
    tagged = near_airports.where(F.length(callsign) >= 3).withColumn(
        "airline_icao", airline_prefix(callsign)
    )
    totals = (
        _by_aircraft(tagged, keys, {})
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("distinct_aircraft"),
            F.sum("position_count").alias("observation_count"),
        )
    )
    named = airlines.select("airline_icao", "airline_name", F.col("country").alias("airline_country"))
    return with_airport(totals, airports).join(named, "airline_icao", "left").select(
        "airport_id",
        "airport_icao_code",
        "airport_iata_code",
        "airport_label",
        "airport_iso_country",
        "airline_icao",
        "airline_name",
        "airline_country",
        "distinct_aircraft",
        "observation_count",
    )


def fct_airport_hourly_air_quality(activity: DataFrame, air_quality: DataFrame) -> DataFrame:
    """Airport hours that have both traffic and pollutant readings."""
    c = F.col
    readings = air_quality.select(
        c("airport_icao").alias("airport_icao_code"),
        c("measured_hour").alias("activity_hour"),
        "no2_ugm3",
        "pm25_ugm3",
        "pm10_ugm3",
        "ozone_ugm3",
    )
    return activity.join(readings, ["airport_icao_code", "activity_hour"]).select(
        "airport_id",
        "airport_icao_code",
        "airport_iata_code",
        "airport_label",
        "airport_iso_country",
        "activity_hour",
        hour_of_day(c("activity_hour")).alias("hour_of_day"),
        day_of_week(c("activity_hour")).alias("day_of_week"),
        "distinct_aircraft",
        "position_count",
        "climbing_aircraft",
        "descending_aircraft",
        "no2_ugm3",
        "pm25_ugm3",
        "pm10_ugm3",
        "ozone_ugm3",
    )
