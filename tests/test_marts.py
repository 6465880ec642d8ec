"""Models against plain, unoptimised formulations of the same definitions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airlake.functions.geo import haversine_km
from airlake.plans import analytics, marts, positions, staging
from airlake.plans.warehouse import TABLES, Warehouse
from airlake.sources.adapter import bronze_from_tables
from airlake.sources.schemas import AIRLINES, AIRPORTS, REGISTRY
from tests.conftest import SMALL
from tests.test_lake import T, snapshot


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    bronze = bronze_from_tables(spark, SMALL)
    return Warehouse(spark, bronze, str(tmp_path_factory.mktemp("warehouse")))


def close(left, right):
    """Rows equal, doubles to nine digits."""
    def key(row):
        return [round(v, 6) if isinstance(v, float) else v for v in row]

    assert sorted(map(key, left.collect()), key=repr) == sorted(map(key, right.collect()), key=repr)


def reference(df, names, cls):
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in cls.names])


# Staging ------------------------------------------------------------------------------


def test_states_without_a_usable_place_are_rejected(spark):
    raw = snapshot(spark, T, 7).withColumn("ingest_date", F.current_date()).withColumn("ingest_hour", F.lit(1))
    n = F.col("icao24").cast("int")
    raw = raw.withColumn(
        "latitude", F.when(n == 1, 90.5).when(n == 2, None).when(n == 3, float("nan")).otherwise(F.lit(-90.0))
    ).withColumn("longitude", F.when(n == 4, -180.5).otherwise(F.lit(180.0)))
    kept = staging.stg_states(raw)
    assert sorted(r["aircraft_icao24"] for r in kept.collect()) == ["000000", "000005", "000006"]
    row = kept.first()
    assert row["is_on_ground"] is False and row["has_special_purpose_indicator"] is False
    assert len(kept.columns) == 22


def test_airports_are_typed_and_restricted(spark):
    data = [
        ("1", " LFPG ", "large_airport", "CDG", "49.01", "2.55", "391.5", " yes", "", "CDG", "LFPG"),
        ("2", "H1", "heliport", "H", "49.0", "2.5", "1", "no", None, None, None),
        ("x", "X", "small_airport", "X", "49.0", "2.5", "1", "no", None, None, None),
        ("3", "Y", "small_airport", "Y", "north", "2.5", "1", "no", None, None, None),
        ("4", "Z", "small_airport", "Z", "1", "2", "high", None, None, " ", None),
    ]
    names = "id ident type name latitude_deg longitude_deg elevation_ft scheduled_service icao_code iata_code gps_code"
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))
    dim = marts.dim_airport(staging.stg_airports(reference(df, names, AIRPORTS)))
    first, second = dim.orderBy("airport_id").collect()
    assert (first["airport_id"], first["elevation_ft"], first["has_scheduled_service"]) == (1, 392, True)
    assert (first["icao_code"], first["airport_label"], first["grid_cell"]) == ("LFPG", "CDG (CDG)", "49_2")
    assert (second["elevation_ft"], second["icao_code"], second["airport_label"]) == (None, "Z", "Z")


def test_registry_prefers_a_registration_and_reads_the_year(spark):
    data = [
        ("ABC123", None, "2005-01-01"), (" abc123", "F-B", "abcd"), ("abc123", "F-A", "1999"),
        ("short", "X", "2000"), ("def456", " ", ""),
    ]
    df = spark.createDataFrame(data, "icao24 string, registration string, built string")
    got = staging.stg_registry(reference(df, None, REGISTRY)).orderBy("aircraft_icao24").collect()
    assert [(r["aircraft_icao24"], r["registration"], r["built_year"]) for r in got] == [
        ("abc123", "F-A", 1999), ("def456", None, None),
    ]


def test_airlines_prefer_the_active_one(spark):
    data = [
        ("Old", "afr", "N"), ("Air France", "AFR ", "Y"), ("Zed", "AFR", "Y"), ("Unknown", "N/A", "Y"),
        ("Bad", "-", "Y"), ("  ", "DLH", "Y"), ("Nul", "KLM", None),
    ]
    df = spark.createDataFrame(data, "name string, icao string, active string")
    got = staging.stg_airlines(reference(df, None, AIRLINES)).orderBy("airline_icao").collect()
    assert [(r["airline_icao"], r["airline_name"], r["is_active"]) for r in got] == [
        ("AFR", "Air France", True), ("KLM", "Nul", False), ("N/A", "Unknown", True),
    ]


# Facts --------------------------------------------------------------------------------


def test_hourly_traffic_equals_plain_distinct_counts(warehouse):
    facts = warehouse["fct_aircraft_positions"]
    plain = facts.groupBy(
        F.date_trunc("hour", "snapshot_at").alias("traffic_hour"),
        "ingest_date",
        F.coalesce("origin_country", F.lit("Inconnu")).alias("origin_country"),
        "ingestion_region",
    ).agg(
        F.count_distinct("aircraft_icao24"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("snapshot_at").alias("s"),
        F.count_distinct(F.when(F.col("is_on_ground"), F.col("aircraft_icao24"))),
        F.count_distinct(F.when(F.col("flight_phase") == "croisiere", F.col("aircraft_icao24"))),
        F.round(F.avg("barometric_altitude_m"), 0),
        F.round(F.percentile("barometric_altitude_m", F.lit(0.5)), 0),
        F.round(F.avg("ground_speed_kt"), 1),
        F.max("ground_speed_kt"),
    ).withColumn("r", F.round(F.col("n") / F.col("s"), 1))
    close(warehouse.plan("fct_traffic_hourly"), plain)


def test_null_regions_stay_a_group(spark, warehouse):
    facts = warehouse["fct_aircraft_positions"].withColumn(
        "ingestion_region", F.when(F.col("ingest_hour") % 2 == 0, F.col("ingestion_region"))
    )
    hourly = marts.fct_traffic_hourly(facts)
    assert hourly.agg(F.sum("position_count")).first()[0] == facts.count()
    assert hourly.where("ingestion_region is null and median_altitude_m is not null").count() > 0


def test_near_airports_equal_the_nine_cell_formulation(warehouse):
    low = marts.low_positions(warehouse["fct_aircraft_positions"])
    offsets = F.array([F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    probes = low.withColumn("o", F.explode(offsets)).select(
        "*", F.concat_ws("_", (F.floor("latitude") + F.col("o.a")), (F.floor("longitude") + F.col("o.b"))).alias("grid_cell")
    )
    places = warehouse["dim_airport"].select(
        "grid_cell", "airport_id", F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon")
    )
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("a_lat"), F.col("a_lon"))
    nearest = (
        probes.join(places, "grid_cell").withColumn("km", km).where("km <= 8")
        .groupBy("aircraft_icao24", "snapshot_at")
        .agg(F.min(F.struct("km", "airport_id")).alias("best"))
        .select("aircraft_icao24", "snapshot_at", "best.airport_id", "best.km")
    )
    got = warehouse["int_positions_near_airports"]
    assert got.count() > 100
    close(got.select("aircraft_icao24", "snapshot_at", "airport_id", "distance_km"), nearest)


def test_a_radius_beyond_the_cells_is_refused(spark, warehouse):
    facts, airports = warehouse["fct_aircraft_positions"], warehouse["dim_airport"]
    with pytest.raises(ValueError, match="wrap"):
        marts.int_positions_near_airports(facts, airports, radius_km=150.0)
    assert marts.int_positions_near_airports(facts, airports, radius_km=150.0, wrap=True).columns


def test_low_phase_filter_depends_on_altitude_or_ground(spark):
    df = spark.createDataFrame(
        [(1, False, 1200.0), (2, False, 1200.1), (3, True, None), (4, False, None)],
        "n int, is_on_ground boolean, barometric_altitude_m double",
    )
    assert sorted(r["n"] for r in marts.low_positions(df).collect()) == [1, 3]
    assert marts.low_positions(df, 1000.0).count() == 1


def test_airport_activity_equals_plain_distinct_counts(warehouse):
    near = warehouse["int_positions_near_airports"]

    def distinct(condition):
        return F.count_distinct(F.when(condition, F.col("aircraft_icao24")))

    plain = near.groupBy(
        "airport_id", "airport_icao_code", "airport_iata_code", "airport_label", "airport_iso_country",
        "airport_municipality", F.date_trunc("hour", "snapshot_at"), "ingest_date",
    ).agg(
        F.count_distinct("aircraft_icao24"),
        F.count(F.lit(1)),
        distinct(F.col("flight_phase") == "montee"),
        distinct(F.col("flight_phase") == "descente"),
        distinct(F.col("is_on_ground")),
        F.round(F.avg("distance_km"), 2),
        F.round(F.avg("barometric_altitude_m"), 0),
        F.max("ground_speed_kt"),
    )
    close(warehouse.plan("fct_airport_activity"), plain)


def test_unknown_airlines_keep_a_null_name(warehouse):
    activity = warehouse["fct_airline_airport_activity"]
    assert activity.where("airline_name is null").count() > 0
    assert activity.where("airline_name is not null").count() > 0
    total = activity.agg(F.sum("observation_count")).first()[0]
    flown = warehouse["int_positions_near_airports"].where("length(trim(callsign)) >= 3").count()
    assert total == flown


def test_aircraft_without_registry_or_callsign_are_kept(spark, warehouse):
    facts = warehouse["fct_aircraft_positions"].withColumn("callsign", F.lit(None).cast("string"))
    none = warehouse["stg_registry"].where("false")
    dim = marts.dim_aircraft(marts.aircraft_usage(facts), none, warehouse["dim_airline"])
    assert dim.count() == facts.select("aircraft_icao24").distinct().count()
    row = dim.first()
    assert row["manufacturer_group"] == "Inconnu" and row["most_frequent_callsign"] is None
    assert row["distinct_callsign_count"] == 0 and 0 <= row["on_ground_ratio"] <= 1


def test_latest_slice_reads_the_newest_snapshot(warehouse):
    facts = warehouse["fct_aircraft_positions"]
    newest = facts.agg(F.max("snapshot_at")).first()[0]
    latest = analytics.latest_slice(facts)
    assert {r["snapshot_at"] for r in latest.collect()} == {newest}
    assert latest.count() == facts.where(F.col("snapshot_at") == F.lit(newest)).count()


def test_status_thresholds(spark):
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "snapshot_at timestamp")
    base = facts.select(F.unix_seconds("snapshot_at").alias("s")).first()["s"]
    for minutes, status in ((20, "ok"), (21, "warn"), (45, "warn"), (46, "err")):
        now = F.timestamp_seconds(F.lit(base + minutes * 60))
        assert analytics.signal_status(facts, now).first()["status"] == status


def test_market_share_binds_the_airport_as_a_value(warehouse):
    activity = warehouse["fct_airline_airport_activity"]
    assert analytics.airline_market_share(activity, "' or '1'='1").count() == 0
    assert analytics.airline_market_share(activity, "EAC").count() > 0


# Warehouse ----------------------------------------------------------------------------


def test_registered_models_answer_sql(spark, warehouse):
    warehouse.register()
    counted = spark.sql("select count(*) as n from marts.fct_aircraft_positions").first()["n"]
    assert counted == warehouse["fct_aircraft_positions"].count() > 0
    assert spark.sql("select count(*) as n from stg_airports").first()["n"] > 0
    assert spark.catalog.tableExists("intermediate.int_positions_near_airports")


def test_inventory_marks_unreadable_tables(spark, warehouse, tmp_path):
    for model in TABLES:
        warehouse[model]
    listed = {r["table_name"]: r["rows"] for r in warehouse.inventory().collect()}
    assert set(listed) == set(TABLES) and min(listed.values()) > 0
    empty = Warehouse(spark, warehouse.bronze, str(tmp_path / "nothing"))
    assert {r["rows"] for r in empty.inventory().collect()} == {-1}


def test_rebuilding_a_table_replaces_it(warehouse):
    before = warehouse["dim_airline"].count()
    warehouse.build("dim_airline")
    assert warehouse["dim_airline"].count() == before


def test_scan_of_the_fact_is_pruned_and_narrow(spark, warehouse):
    facts = warehouse["fct_aircraft_positions"]
    plan = facts.where("ingest_hour = 3").groupBy("flight_phase").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_hour" in text
    assert "ReadSchema: struct<flight_phase:string>" in text


def test_positions_are_one_row_per_aircraft_and_instant(warehouse):
    facts = warehouse["fct_aircraft_positions"]
    assert facts.groupBy(*positions.GRAIN).count().where("count > 1").count() == 0
