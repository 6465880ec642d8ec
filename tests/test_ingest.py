"""Landed files through to the marts."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from airlake.plans import analytics, ingest
from airlake.plans.contracts import latest_snapshot_rows
from airlake.operators.quality import QualityError
from airlake.plans.warehouse import Warehouse
from airlake.sources import lake
from tests.test_landing import AIRLINES_DAT, REGISTRY_CSV, VECTOR, hourly

AIRPORTS = (
    "id,ident,type,name,latitude_deg,longitude_deg,elevation_ft,continent,iso_country,iso_region,"
    "municipality,scheduled_service,icao_code,iata_code,gps_code,local_code,home_link,wikipedia_link,keywords\n"
    "1382,LFPG,large_airport,Charles de Gaulle,49.0128,2.55,392,EU,FR,FR-IDF,Paris,yes,LFPG,CDG,LFPG,,,,\n"
    "1381,LFPO,large_airport,Paris-Orly,48.7233,2.3794,291,EU,FR,FR-IDF,Paris,yes,LFPO,ORY,LFPO,,,,\n"
    "9,H,heliport,Helipad,48.72,2.37,1,EU,FR,FR-IDF,Paris,no,,,,,,,\n"
)
T = 1787126400  # 2026-08-19 08:00 UTC


def vector(address, callsign, latitude, longitude, altitude, ground=False, rate=0.0, time=T):
    changed = list(VECTOR)
    changed[0], changed[1], changed[3], changed[5], changed[6] = address, callsign, time, longitude, latitude
    changed[7], changed[8], changed[11] = altitude, ground, rate
    return changed


def land(spark, folder, root):
    files = {
        "states/a.json": {"time": T, "states": [
            vector("5c0001", "VLA1    ", 49.01, 2.55, 300.0, rate=-3.0),
            vector("5c0003", "HLW2    ", 48.72, 2.38, 100.0, ground=True),
            vector("fff000", None, 45.0, 5.0, 10000.0),
            vector(None, "X", 45.0, 5.0, 10000.0),
        ]},
        "states/b.json": {"time": T + 900, "states": [
            vector("5C0001", "VLA1    ", 49.02, 2.56, 500.0, rate=4.0, time=T + 890),
        ]},
        "states/c.json": {"time": T + 1800, "states": None},
    }
    for name in ("states", "air_quality"):
        (folder / name).mkdir(parents=True, exist_ok=True)
    for name, payload in files.items():
        (folder / name).write_text(json.dumps(payload))
    (folder / "air_quality" / "LFPG.json").write_text(hourly())
    (folder / "air_quality" / "ZZZZ.json").write_text(hourly())
    (folder / "airports.csv").write_text(AIRPORTS)
    (folder / "registry.csv").write_text(REGISTRY_CSV)
    (folder / "airlines.dat").write_text(AIRLINES_DAT)
    ingest.land_snapshots(spark, str(folder / "states"), root, "france")
    ingest.land_airports(spark, str(folder / "airports.csv"), root)
    ingest.land_registry(spark, str(folder / "registry.csv"), root)
    ingest.land_airlines(spark, str(folder / "airlines.dat"), root)
    ingest.land_air_quality(spark, str(folder / "air_quality"), root)


def test_landed_files_become_marts(spark, tmp_path, rows):
    folder, root = tmp_path / "landing", str(tmp_path / "lake")
    land(spark, folder, root)
    land(spark, folder, root)  # landing everything again changes nothing
    bronze = ingest.bronze_from_lake(spark, root)
    assert rows(bronze.states.groupBy("snapshot_ts").count()) == [(T, 3), (T + 900, 1)]
    assert bronze.air_quality.count() == 24

    warehouse = Warehouse(spark, bronze, str(tmp_path / "warehouse"))
    report = warehouse.run()
    assert len(report) == 78 and sum(r["violations"] for r in report) == 0

    activity = warehouse["fct_airport_activity"].select(
        "airport_label", "distinct_aircraft", "position_count", "climbing_aircraft",
        "descending_aircraft", "ground_aircraft",
    )
    assert rows(activity) == [
        ("Charles de Gaulle (CDG)", 1, 2, 1, 1, 0),
        ("Paris-Orly (ORY)", 1, 1, 0, 0, 1),
    ]
    panel = warehouse["fct_airport_hourly_air_quality"].select(
        "airport_iata_code", "hour_of_day", "day_of_week", "no2_ugm3"
    )
    assert rows(panel) == [("CDG", 8, 3, 18.0)]
    aircraft = warehouse["dim_aircraft"].select(
        "aircraft_icao24", "airline_name", "manufacturer_group", "built_year", "observed_span_seconds"
    )
    assert rows(aircraft) == [
        ("5c0001", "Vale Air", "Embraer", 2011, 900),
        ("5c0003", "Hill Wings", "ATR", 2017, 0),
        ("fff000", None, "Inconnu", None, 0),
    ]
    ages = warehouse["fct_aircraft_positions"].where("aircraft_icao24 = '5c0001'")
    assert sorted(r["position_age_seconds"] for r in ages.collect()) == [0.0, 10.0]
    assert analytics.overview(warehouse["fct_aircraft_positions"]).first()["positions"] == 4

    audit = lake.read_audit(spark, root).groupBy("snapshot_ts").agg(F.max("rows").alias("rows"))
    assert rows(audit) == [(T, 3), (T + 900, 1), (T + 1800, 0)]
    rejected = lake.read_audit(spark, root, "rejected").select("source_name", "file_name", "reason").distinct()
    assert rows(rejected) == [("air_quality", "ZZZZ", "airport is not followed")]
    landed = lake.read_audit(spark, root, "references").where("source_name = 'registry'").first()
    assert landed["rows"] == 2 and landed["size_bytes"] == len(REGISTRY_CSV)


def test_snapshot_delivered_again_as_empty_loses_its_rows(spark, tmp_path):
    root, payloads = str(tmp_path / "lake"), tmp_path / "states"
    payloads.mkdir()
    full = {"time": T, "states": [vector("5c0001", "VLA1", 49.01, 2.55, 300.0)]}
    for payload in (full, {"time": T, "states": None}):
        (payloads / "a.json").write_text(json.dumps(payload))
        ingest.land_snapshots(spark, str(payloads), root, "france")
    states = lake.scan_states(spark, root)
    assert states.count() == 0
    newest = latest_snapshot_rows(states, lake.read_audit(spark, root)).first()
    assert (newest["snapshot_ts"], newest["rows"], newest["passed"]) == (T, 0, False)


def test_unreadable_payloads_are_kept_and_fail_the_gate(spark, tmp_path):
    """One good payload and several that cannot be read: the good one is landed, the others are rows of the quarantine
    until their files are delivered again."""
    root, payloads = str(tmp_path / "lake"), tmp_path / "states"
    payloads.mkdir()
    good = {"time": T, "states": [vector("5c0001", "VLA1", 49.01, 2.55, 300.0)]}
    broken = {
        "cut.json": '{"time": 17', "late.json": json.dumps({"time": 99999999999999, "states": None}),
        "none.json": json.dumps({"states": []}), "text.json": json.dumps({"time": T, "states": "x"}),
    }
    (payloads / "good.json").write_text(json.dumps(good))
    for name, text in broken.items():
        (payloads / name).write_text(text)
    ingest.land_snapshots(spark, str(payloads), root, "france")
    assert lake.scan_states(spark, root).count() == 1
    assert [r["rows"] for r in lake.read_audit(spark, root).collect()] == [1]
    held = {r["path"].rpartition("/")[2]: r for r in lake.open_quarantine(spark, root).collect()}
    assert {n: r["reason"] for n, r in held.items()} == {
        "cut.json": "not JSON", "late.json": "time out of range", "none.json": "no time", "text.json": "states are no list",
    }
    assert all(r["payload"] == broken[n] and r["payload_bytes"] == len(broken[n]) for n, r in held.items())
    land(spark, tmp_path / "landing", root)
    with pytest.raises(QualityError, match="payload_quarantine.payload readable: 4"):
        Warehouse(spark, ingest.bronze_from_lake(spark, root), str(tmp_path / "w")).run()
    for name in broken:
        (payloads / name).write_text(json.dumps(good))
    ingest.land_snapshots(spark, str(payloads), root, "france")
    assert lake.open_quarantine(spark, root).count() == 0
    Warehouse(spark, ingest.bronze_from_lake(spark, root), str(tmp_path / "w")).run()


def test_reading_written_tables_keeps_facts_of_pruned_raw_data(spark, tmp_path):
    root, out = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    land(spark, tmp_path / "landing", root)
    facts = Warehouse(spark, ingest.bronze_from_lake(spark, root), out)["fct_aircraft_positions"].count()
    assert facts > 0
    lake.prune_states(spark, root, dt.date(2026, 12, 1), 1)
    again = Warehouse(spark, ingest.bronze_from_lake(spark, root), out)
    assert again["fct_aircraft_positions"].count() == facts
    assert again.build("fct_aircraft_positions").count() == facts
    assert again.build("fct_aircraft_positions", full_refresh=True).count() == 0


def test_inventory_marks_an_unreadable_table(spark, tmp_path):
    out = tmp_path / "warehouse"
    broken = out / "marts" / "dim_airline"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("no parquet")
    counted = {r["table_name"]: r["rows"] for r in Warehouse(spark, None, str(out)).inventory().collect()}
    assert set(counted.values()) == {-1}
