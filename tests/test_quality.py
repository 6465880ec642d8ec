from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airlake.operators import quality as Q
from airlake.plans import contracts
from airlake.plans.warehouse import VIEWS, Warehouse
from airlake.sources.adapter import Bronze, bronze_from_tables
from tests.conftest import SMALL


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, 5.0, "a"), (1, -1.0, "b"), (2, None, "z"), (None, 11.0, None), (None, 10.0, "a")],
        "id int, x double, kind string",
    )


def counts(report):
    return {(r["column_name"], r["check_name"]): r["violations"] for r in report.collect()}


def test_row_checks_of_a_table(table):
    contract = Q.Contract(
        not_null=("id", "x"), ranges=(Q.Range("x", 0, 10),), values={"kind": ("a", "b")}
    )
    assert counts(Q.table_report("t", table, contract)) == {
        ("id", "not_null"): 2, ("x", "not_null"): 1, ("x", "accepted_range"): 2, ("kind", "accepted_values"): 1,
    }


def test_unique_shares_the_pass(table):
    contract = Q.Contract(not_null=("x",), unique=("id",))
    assert counts(Q.table_report("t", table, contract)) == {("x", "not_null"): 1, ("id", "unique"): 1}
    assert counts(Q.table_report("t", table.where("false"), contract)) == {
        ("x", "not_null"): 0, ("id", "unique"): 0,
    }
    assert counts(Q.unique_report("t", table, "id")) == {("id", "unique"): 1}


@pytest.mark.parametrize(
    ("bounds", "bad"),
    [({"low": 10}, 2), ({"high": 5}, 2), ({"low": -1, "high": 11}, 0),
     ({"low": -1, "high": 11, "inclusive": False}, 2), ({}, 0)],
)
def test_ranges(table, bounds, bad):
    assert table.where(Q.Range("x", **bounds).outside()).count() == bad


def test_references_ignore_nulls_and_count_rows(spark, table):
    parent = spark.createDataFrame([(2,)], "key int")
    assert [tuple(r) for r in Q.orphans(table, "id", parent, "key").collect()] == [(1, 2)]
    report = Q.reference_report("t", table, "id", parent, "key").first()
    assert report["violations"] == 2
    whole = Q.reference_report("t", table, "id", spark.createDataFrame([(1,), (2,)], "key int"), "key")
    assert whole.first()["violations"] == 0


def test_gate_lets_warnings_pass_and_stops_errors(table):
    warn = Q.Contract(ranges=(Q.Range("x", 0, 10, Q.WARN),))
    assert len(Q.gate(Q.table_report("t", table, warn))) == 1
    with pytest.raises(Q.QualityError, match="t.x not_null: 1"):
        Q.gate(Q.table_report("t", table, Q.Contract(not_null=("x",))))


def test_declared_checks_are_complete():
    declared = contracts.CONTRACTS.values()
    assert sum(len(c.not_null) for c in declared) == 42
    assert sum(len(c.ranges) for c in declared) == 23
    assert sum(len(c.unique) for c in declared) == 6
    assert sum(len(c.values) for c in declared) == 2
    assert sum(len(c.references) for c in declared) == 4
    assert sum(r.severity == Q.WARN for c in declared for r in c.ranges) == 6


def test_grain_and_consistency(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "aircraft_icao24 string, snapshot_at int")
    assert [tuple(r) for r in contracts.repeated_grain(facts).collect()] == [("a", 1, 2)]
    hours = spark.createDataFrame(
        [(1, "x", 2, 2, 2, 2), (2, "x", 3, 2, 0, 0), (3, "x", 1, 2, 2, 0), (4, "x", 1, 2, 0, 2)],
        "traffic_hour int, origin_country string, distinct_aircraft int, position_count int, "
        "aircraft_on_ground int, aircraft_cruising int",
    )
    assert sorted(r[0] for r in contracts.inconsistent_hours(hours).collect()) == [2, 3, 4]


def test_future_snapshots_allow_five_minutes(spark):
    facts = spark.createDataFrame([("a", 299), ("b", 301)], "aircraft_icao24 string, s bigint").select(
        "aircraft_icao24",
        F.timestamp_seconds("s").alias("snapshot_at"),
        F.timestamp_seconds("s").alias("ingested_at"),
    )
    late = contracts.future_snapshots(facts, F.timestamp_seconds(F.lit(0)))
    assert [r["aircraft_icao24"] for r in late.collect()] == ["b"]


@pytest.mark.parametrize(("hours", "status"), [(2, "pass"), (3, "warn"), (12, "warn"), (13, "error")])
def test_freshness(spark, hours, status):
    source = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("ingested_at"))
    now = F.timestamp_seconds(F.lit(hours * 3600))
    assert contracts.source_freshness("states", source, now).first()["status"] == status
    assert contracts.source_freshness("states", source.where("false"), now).first()["status"] == "error"


def test_build_runs_all_checks(spark, tmp_path):
    warehouse = Warehouse(spark, bronze_from_tables(spark, SMALL), str(tmp_path / "w"))
    report = warehouse.run()
    assert len(report) == 77
    assert all(r["violations"] == 0 for r in report if r["severity"] == "error")


def test_a_failed_check_stops_the_tables_after_it(spark, tmp_path):
    good = bronze_from_tables(spark, SMALL)
    bad = good.states.withColumn("true_track", F.lit(999.0))
    bronze = Bronze(bad, good.airports, good.air_quality, good.registry, good.airlines)
    warehouse = Warehouse(spark, bronze, str(tmp_path / "w"))
    with pytest.raises(Q.QualityError, match="stg_states.heading_deg accepted_range"):
        warehouse.run()
    assert {r["rows"] for r in warehouse.inventory().collect()} == {-1}
    built = warehouse.run(only=["dim_airport"])
    assert {r["table_name"] for r in built} == {"dim_airport"} and "stg_states" in VIEWS
