"""What every model promises. Columns, bounds, labels and severities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airlake.functions.flight import PHASES
from airlake.operators.quality import ERROR, WARN, Contract, Range, repeated
from airlake.plans.staging import AIRFIELD_TYPES

CONTRACTS: dict[str, Contract] = {
    "stg_states": Contract(
        not_null=("aircraft_icao24", "snapshot_at", "latitude", "longitude", "is_on_ground"),
        ranges=(
            Range("latitude", -90, 90),
            Range("longitude", -180, 180),
            # Sensor plausibility only warns: a faulty transponder must not stop the build.
            Range("barometric_altitude_m", -500, 20000, WARN),
            Range("ground_speed_ms", 0, 400, WARN),
            Range("heading_deg", 0, 360),
        ),
    ),
    "stg_airports": Contract(
        not_null=("airport_id", "airport_ident", "latitude", "longitude"),
        unique=("airport_id",),
        ranges=(Range("latitude", -90, 90), Range("longitude", -180, 180)),
        values={"airport_type": AIRFIELD_TYPES},
    ),
    "stg_air_quality": Contract(
        not_null=("airport_icao", "measured_hour"),
        ranges=(Range("no2_ugm3", 0, 1000, WARN), Range("pm25_ugm3", 0, 1000, WARN)),
    ),
    "stg_registry": Contract(not_null=("aircraft_icao24",), unique=("aircraft_icao24",)),
    "stg_airlines": Contract(
        not_null=("airline_icao", "airline_name"), unique=("airline_icao",)
    ),
    "int_positions_deduplicated": Contract(not_null=("aircraft_icao24", "snapshot_at")),
    "fct_aircraft_positions": Contract(
        not_null=("aircraft_icao24", "snapshot_at", "flight_phase"),
        ranges=(
            Range("barometric_altitude_ft", -1650, 66000, WARN),
            Range("ground_speed_kt", 0, 780, WARN),
            Range("position_age_seconds", 0),
        ),
        values={"flight_phase": PHASES},
        references={"aircraft_icao24": ("dim_aircraft", "aircraft_icao24")},
    ),
    "fct_traffic_hourly": Contract(
        not_null=("traffic_hour", "origin_country", "distinct_aircraft", "position_count"),
        ranges=(Range("distinct_aircraft", 1), Range("position_count", 1)),
    ),
    "fct_airport_activity": Contract(
        not_null=("airport_id", "activity_hour", "distinct_aircraft"),
        ranges=(Range("distinct_aircraft", 1), Range("avg_distance_km", 0, 8)),
        references={"airport_id": ("dim_airport", "airport_id")},
    ),
    "dim_aircraft": Contract(
        not_null=("aircraft_icao24", "observation_count", "first_seen_at", "last_seen_at"),
        unique=("aircraft_icao24",),
        ranges=(Range("observation_count", 1), Range("on_ground_ratio", 0, 1)),
    ),
    "dim_airport": Contract(
        not_null=("airport_id", "airport_label", "grid_cell"),
        unique=("airport_id",),
        ranges=(Range("latitude", -90, 90), Range("longitude", -180, 180)),
    ),
    "fct_airport_hourly_air_quality": Contract(
        not_null=("airport_id", "activity_hour", "hour_of_day", "distinct_aircraft"),
        ranges=(Range("hour_of_day", 0, 23), Range("distinct_aircraft", 1)),
        references={"airport_id": ("dim_airport", "airport_id")},
    ),
    "dim_airline": Contract(not_null=("airline_icao", "airline_name"), unique=("airline_icao",)),
    "fct_airline_airport_activity": Contract(
        not_null=("airport_id", "airline_icao", "distinct_aircraft"),
        ranges=(Range("distinct_aircraft", 1),),
        references={"airport_id": ("dim_airport", "airport_id")},
    ),
}

# Source table -> hours after which missing data warns, and fails.
FRESHNESS_HOURS = {"states": (2, 12), "air_quality": (36, 96)}


def quarantine_report(quarantine: DataFrame) -> DataFrame:
    """One check row: payloads that were landed, could not be read, and were not delivered again since."""
    return quarantine.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("payload_quarantine").alias("table_name"),
        F.lit("payload").alias("column_name"),
        F.lit("readable").alias("check_name"),
        F.lit(ERROR).alias("severity"),
        "violations",
    )


def repeated_grain(positions: DataFrame) -> DataFrame:
    """Facts breaking the (aircraft, instant) grain."""
    return repeated(positions, ["aircraft_icao24", "snapshot_at"])


def inconsistent_hours(traffic_hourly: DataFrame) -> DataFrame:
    """Hourly rows whose parts exceed their whole, the trace of a join that multiplied rows."""
    aircraft = F.col("distinct_aircraft")
    return traffic_hourly.where(
        (aircraft > F.col("position_count"))
        | (F.col("aircraft_on_ground") > aircraft)
        | (F.col("aircraft_cruising") > aircraft)
    ).select(
        "traffic_hour",
        "origin_country",
        "distinct_aircraft",
        "position_count",
        "aircraft_on_ground",
        "aircraft_cruising",
    )


def future_snapshots(positions: DataFrame, now: Column) -> DataFrame:
    """Facts dated after ``now``, five minutes of clock drift allowed."""
    return positions.where(F.col("snapshot_at") > now + F.expr("interval 5 minutes")).select(
        "aircraft_icao24", "snapshot_at", "ingested_at"
    )


def source_freshness(name: str, source: DataFrame, now: Column) -> DataFrame:
    """Age of a source's newest row and the resulting status."""
    warn, error = FRESHNESS_HOURS[name]
    age = (F.unix_micros(now) - F.unix_micros(F.max("ingested_at"))) / F.lit(3.6e9)
    return source.agg(
        F.max("ingested_at").alias("newest"), age.alias("age_hours")
    ).select(
        F.lit(name).alias("source_name"),
        "newest",
        "age_hours",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error), "error")
        .when(F.col("age_hours") > warn, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def latest_snapshot_rows(states: DataFrame, received: DataFrame | None = None) -> DataFrame:
    """Row count of the newest snapshot and whether it passed.

    An empty snapshot leaves no rows in the lake; the landing audit (``snapshot_ts, rows,
    ingested_at``) says it happened. The delivery ingested last decides; the lake counts only
    where there is no audit.
    """
    seen = states.groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("rows"))
    if received is not None:
        audited = received.where("snapshot_ts is not null").groupBy("snapshot_ts").agg(
            F.max_by("rows", "ingested_at").alias("rows")
        )
        seen = seen.join(audited, "snapshot_ts", "left_anti").unionByName(audited)
    return seen.agg(
        F.max("snapshot_ts").alias("snapshot_ts"),
        F.coalesce(F.max_by("rows", "snapshot_ts"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("snapshots"),
    ).withColumn("passed", F.col("rows") > 0)
