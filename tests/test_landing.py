from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from airlake.sources import landing
from airlake.sources.schemas import AIRLINES, REGISTRY, STATES
from airlake.sources.tracked import tracked_airports



def now():
    return F.expr("timestamp '2024-01-01 00:00:00'")


VECTOR = [
    "5c0d3e", "VLA52   ", "Ruritania", 1763112000, 1763112004, 7.4391, 46.9511, 9144.0, False,
    204.75, 118.5, 0.0, None, 9290.5, "4512", False, 0, 2,
]


def changed(**values):
    names = [field.name for field in STATES.fields]
    vector = list(VECTOR)
    for name, value in values.items():
        vector[names.index(name)] = value
    return vector


def decode(spark, *payloads):
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string")
    return landing.decode_states(df, "france", now())


def single(spark, vector):
    return decode(spark, {"time": 1763112000, "states": [vector]}).first()


def test_positions_of_the_vector_are_named_and_typed(spark):
    row = single(spark, VECTOR)
    assert row["icao24"] == "5c0d3e" and row["callsign"] == "VLA52   "
    assert (row["latitude"], row["longitude"], row["baro_altitude"]) == (46.9511, 7.4391, 9144.0)
    assert row["on_ground"] is False and row["category"] == 2 and row["time_position"] == 1763112000
    assert row["snapshot_ts"] == 1763112000 and row["region"] == "france" and row["sensors"] is None


def test_schema_is_the_declared_one(spark):
    df = decode(spark, {"time": 1, "states": [VECTOR]})
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STATES]
    empty = decode(spark, {"time": 1, "states": []})
    assert empty.count() == 0 and empty.columns == STATES.names


def test_short_vectors_are_completed(spark):
    row = single(spark, VECTOR[:17])
    assert row["category"] is None and row["position_source"] == 0


def test_malformed_numbers_become_null(spark):
    row = single(spark, ["5c0001", "PROBE", "Ruritania", "soon", None, "east", None])
    assert row["icao24"] == "5c0001"
    assert row["time_position"] is None and row["longitude"] is None and row["latitude"] is None


def test_numbers_may_be_text_or_carry_a_fraction(spark):
    row = single(spark, changed(time_position=1763112000.9, last_contact="12", latitude="48.5"))
    assert (row["time_position"], row["last_contact"], row["latitude"]) == (1763112000, 12, 48.5)


@pytest.mark.parametrize(
    ("value", "number", "whole"),
    [
        ("12d", None, None), ("12F", None, None), ("12.5", 12.5, None), (" 12 ", 12.0, 12), ("+7", 7.0, 7),
        ("1e2", 100.0, None), (True, 1.0, 1), (False, 0.0, 0), (12.9, 12.9, 12), (-12.9, -12.9, -12),
        (1.5e3, 1500.0, 1500), ("", None, None), ([1], None, None), (None, None, None),
    ],
)
def test_text_numbers_and_json_numbers_differ(spark, value, number, whole):
    row = single(spark, changed(latitude=value, time_position=value, position_source=value))
    assert (row["latitude"], row["time_position"], row["position_source"]) == (number, whole, whole)


def test_sensors_are_kept_without_nulls(spark):
    assert single(spark, changed(sensors=[101, None, 202]))["sensors"] == [101, 202]
    assert single(spark, changed(sensors=[]))["sensors"] == []


def test_booleans(spark):
    assert single(spark, changed(on_ground=True, spi=None))["on_ground"] is True
    assert single(spark, changed(spi=None))["spi"] is None
    assert single(spark, changed(on_ground=1))["on_ground"] is True
    assert single(spark, changed(on_ground=0))["on_ground"] is False


def test_rows_without_an_id_are_dropped(spark):
    assert decode(spark, {"time": 1, "states": [changed(icao24=None), VECTOR]}).count() == 1


def test_null_states_and_unreadable_payloads_give_no_rows(spark):
    assert decode(spark, {"time": 1, "states": None}).count() == 0
    broken = spark.createDataFrame([("{nope",)], "value string")
    assert landing.decode_states(broken, "france", now()).count() == 0


def test_unfolded_vectors_do_not_carry_their_payload(spark):
    """Else the rows of one snapshot hold it as often as it has vectors: memory by the square of its size."""
    df = decode(spark, {"time": 1, "states": [changed(icao24=f"{i:06x}") for i in range(300)]})
    unfolded = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Generate explode" in line]
    assert len(unfolded) == 1
    carried = unfolded[0].split("), [", 1)[1].split("]")[0]
    assert carried.startswith("snapshot_ts") and "," not in carried
    assert [tuple(r) for r in df.groupBy("snapshot_ts").count().collect()] == [(1, 300)]


def test_made_payloads_are_parsed_once(spark):
    """Else a filter inferred from the unfolding repeats their making, in as many variants as they have aliases."""
    vector = json.dumps([[*VECTOR[:17], "{}"]])
    made = spark.range(6).selectExpr("id as e", "id % 3 as n").selectExpr(
        "e as a", f"case n when 0 then 'null' when 1 then '[]' else replace('{vector}', '\"{{}}\"', string(e)) end as states"
    )
    df = landing.decode_states(made.selectExpr("concat('{\"time\":', a, ',\"states\":', states, '}') as value"), "france", now())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == 1 and "size(" not in plan
    assert sorted((r["snapshot_ts"], r["icao24"], r["category"]) for r in df.collect()) == [(2, "5c0d3e", 2), (5, "5c0d3e", 5)]


def test_audit_counts_empty_snapshots(spark):
    payloads = [
        {"time": 1, "states": [VECTOR, changed(icao24=None)]},
        {"time": 2, "states": None},
        {"time": 3, "states": []},
    ]
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string")
    audit = {r["snapshot_ts"]: r for r in landing.audit_snapshots(df, "france", now()).collect()}
    assert {ts: (r["received"], r["rows"]) for ts, r in audit.items()} == {1: (2, 1), 2: (0, 0), 3: (0, 0)}
    text = json.dumps(payloads[1])
    assert audit[2]["sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert audit[2]["payload_bytes"] == len(text)


def test_payload_files_are_read_whole(spark, tmp_path):
    for ts in (10, 20):
        (tmp_path / f"states_{ts}.json").write_text(json.dumps({"time": ts, "states": [VECTOR]}, indent=1))
    payloads = landing.read_payloads(spark, str(tmp_path))
    decoded = landing.decode_states(payloads, "france", now())
    assert sorted(r["snapshot_ts"] for r in decoded.collect()) == [10, 20]


# Air quality --------------------------------------------------------------------------


def hourly(n=24, **series):
    body = {
        "time": [f"2026-08-19T{h:02d}:00" for h in range(n)],
        "nitrogen_dioxide": [10.0 + h for h in range(n)],
        "pm2_5": [5.0 + h * 0.5 for h in range(n)],
        "pm10": [8.0] * n,
        "ozone": [40.0] * n,
    }
    return json.dumps({"hourly": {**body, **series}})


def flatten(spark, value, airports=2):
    places = tracked_airports(spark).orderBy("airport_icao").limit(airports)
    return landing.flatten_hourly(places.withColumn("value", F.lit(value)), now())


def test_one_row_per_airport_and_hour(spark):
    df = flatten(spark, hourly())
    assert df.count() == 48 and df.select("airport_icao").distinct().count() == 2
    first = df.orderBy("airport_icao", "measured_at").first()
    assert first["nitrogen_dioxide"] == 10.0 and first["source"] == "air-quality"


def test_naive_times_are_utc(spark):
    seconds = flatten(spark, hourly(3), 1).selectExpr("unix_seconds(measured_at) as s").orderBy("s").first()["s"]
    assert seconds == 1787097600


def test_missing_and_short_series_become_null(spark):
    df = flatten(spark, hourly(3, nitrogen_dioxide=[1.0, None, 3.0], pm2_5=[1.0], pm10=None), 1)
    got = df.orderBy("measured_at").select("nitrogen_dioxide", "pm2_5", "pm10", "ozone").collect()
    assert [tuple(r) for r in got] == [(1.0, 1.0, None, 40.0), (None, None, None, 40.0), (3.0, None, None, 40.0)]
    assert flatten(spark, '{"hourly": null}', 1).count() == 0
    assert flatten(spark, '{"hourly": {"time": null}}', 1).count() == 0


def test_tracked_airports(spark):
    df = tracked_airports(spark)
    assert df.count() == 14 and df.where("airport_iata = 'CDG'").first()["airport_icao"] == "LFPG"


# Reference files ----------------------------------------------------------------------


AIRPORTS_CSV = (
    '"id","ident","type","name","latitude_deg","iata_code","keywords"\n'
    '"7001","XQAA","large_airport","Upper Vale, ""The Meadow""","46.512345","QAA",""\n'
    '"7002","XQAB","medium_airport","Lower Vale","46.25","QAB",\n'
)
REGISTRY_CSV = (
    '"icao24","registration","typecode","manufacturername","model","operator","operatoricao","owner",'
    '"built","categoryDescription","serialnumber"\n'
    '"5c0001","X-AAAA","E190","Embraer","ERJ 190-100","Vale Air","VLA","Vale Leasing","2011","Medium","1"\n'
    '"5c0002","","","","","","","","","","2"\n'
    '"5c0003","X-AAAB","AT76","ATR","ATR 72-600","Hill Wings","HLW","Hill Wings","2017","Medium","3"\n'
    '"","X-NONE","P28A","Piper","","","","","","","4"\n'
)
AIRLINES_DAT = (
    '41,"Vale Air",\\N,"VV","VLA","VALE","Ruritania","Y"\n'
    '-1,"Nobody",\\N,"-","N/A",\\N,\\N,"Y"\n'
    '42,"Hill Wings",\\N,"HW","HLW","HILLTOP","Ruritania",""\n'
)


@pytest.fixture
def written(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_text(content)
        return str(path)

    return write


def test_csv_columns_are_all_text(spark, written):
    df = landing.read_text_csv(spark, written("airports.csv", AIRPORTS_CSV))
    assert {kind for _, kind in df.dtypes} == {"string"}
    first = df.where("ident = 'XQAA'").first()
    assert first["latitude_deg"] == "46.512345" and first["name"] == 'Upper Vale, "The Meadow"'
    assert df.count() == 2 and df.where("ident = 'XQAB'").first()["keywords"] is None


def test_registry_keeps_useful_rows_and_columns(spark, written):
    df = landing.read_registry(spark, written("registry.csv", REGISTRY_CSV))
    assert df.columns == REGISTRY.names
    assert sorted(r["icao24"] for r in df.collect()) == ["5c0001", "5c0003"]


def test_airlines_file(spark, written):
    df = landing.read_airlines(spark, written("airlines.dat", AIRLINES_DAT))
    assert df.columns == AIRLINES.names and df.count() == 3
    assert all(r["alias"] is None for r in df.collect())
    nobody = df.where("name = 'Nobody'").first()
    assert (nobody["iata"], nobody["icao"], nobody["country"]) == ("-", "N/A", None)
    assert df.where("icao = 'HLW'").first()["active"] is None


def test_file_audit(spark, written):
    path = written("airports.csv", AIRPORTS_CSV)
    row = landing.audit_files(spark, path).first()
    assert row["sha256"] == hashlib.sha256(AIRPORTS_CSV.encode()).hexdigest()
    assert row["size_bytes"] == len(AIRPORTS_CSV)
    table = landing.read_text_csv(spark, path)
    audit = landing.audit_reference(spark, path, table).first()
    assert audit["rows"] == 2 and audit["columns"] == table.columns and len(audit["sha256"]) == 64
