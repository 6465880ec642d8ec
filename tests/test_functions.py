from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from airlake.functions import flight, geo, moments, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("AFR23   ", "AFR23"),
        ("\u00a0 AFR\u3000", "AFR"),
        ("   ", None),
        ("\u00a0\u2009", None),
        ("", None),
        (None, None),
        ("\tX", "\tX"),
        ("a b", "a b"),
        ("\u00e9\u00a0", "\u00e9"),
    ],
)
def test_blank_to_null(spark, raw, expected):
    assert one(spark, text.blank_to_null(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("12", 12), ("1.5", 2), ("2.5", 3), ("-2.5", -3), (" 7 ", 7), ("n/a", None), ("", None),
     (None, None), ("12d", None), ("99999999999", None), ("NaN", None)],
)
def test_parse_int(spark, raw, expected):
    assert one(spark, text.parse_int(F.lit(raw).cast("string"))) == expected


def test_parse_double_keeps_bad_values_out(spark):
    assert one(spark, text.parse_double(F.lit("48.5"))) == 48.5
    assert one(spark, text.parse_double(F.lit("12d"))) is None
    assert one(spark, text.parse_double(F.lit("x"))) is None


def test_airline_prefix_and_label(spark):
    assert one(spark, text.airline_prefix(F.lit("afr23"))) == "AFR"
    assert one(spark, text.display_label(F.lit("Orly"), F.lit("ORY"))) == "Orly (ORY)"
    assert one(spark, text.display_label(F.lit("Orly"), F.lit(None).cast("string"))) == "Orly"


@pytest.mark.parametrize(
    ("ground", "rate", "phase"),
    [(True, 9.0, "sol"), (True, None, "sol"), (False, None, "inconnu"), (False, 1.6, "montee"),
     (False, 1.5, "croisiere"), (False, -1.5, "croisiere"), (False, -1.6, "descente"),
     (False, 0.0, "croisiere")],
)
def test_flight_phase(spark, ground, rate, phase):
    rate_column = F.lit(rate).cast("double")
    assert one(spark, flight.flight_phase(F.lit(ground), rate_column)) == phase


@pytest.mark.parametrize(
    ("maker", "group"),
    [("AIRBUS SAS", "Airbus"), ("the boeing company", "Boeing"), ("Embraer", "Embraer"),
     ("Canadair", "Bombardier"), ("Bombardier Inc", "Bombardier"), ("ATR", "ATR"),
     ("Airbus-Boeing", "Airbus"), ("Cessna", "Autre"), (None, "Inconnu")],
)
def test_manufacturer_group(spark, maker, group):
    assert one(spark, flight.manufacturer_group(F.lit(maker).cast("string"))) == group


def test_haversine(spark):
    paris_london = geo.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(51.5074), F.lit(-0.1278))
    assert one(spark, paris_london) == pytest.approx(343.556, abs=0.01)
    quarter = geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0))
    assert one(spark, quarter) == pytest.approx(10007.557, abs=0.01)
    same = geo.haversine_km(F.lit(1.0), F.lit(2.0), F.lit(1.0), F.lit(2.0))
    assert one(spark, same) == 0.0


def test_grid_cell_floors_negative_angles(spark):
    assert one(spark, geo.grid_cell(F.lit(48.9), F.lit(2.1))) == "48_2"
    assert one(spark, geo.grid_cell(F.lit(-0.1), F.lit(-5.5))) == "-1_-6"


def test_regions_are_inclusive(spark):
    france = geo.region("  France ")
    assert one(spark, france.contains(F.lit(48.8566), F.lit(2.3522)))
    assert not one(spark, france.contains(F.lit(51.5074), F.lit(-0.1278)))
    assert one(spark, france.contains(F.lit(41.0), F.lit(9.8)))
    with pytest.raises(ValueError, match="unknown region"):
        geo.region("atlantis")


def test_time_buckets_use_utc(spark):
    moment = F.timestamp_seconds(F.lit(1786968000))
    assert one(spark, moments.hour_of_day(moment)) == 12
    sunday = F.expr("timestamp '2024-01-07 23:30:00'")
    assert one(spark, moments.day_of_week(sunday)) == 0
    assert one(spark, F.unix_seconds(moments.hour_bucket(moment + F.expr("interval 59 minutes")))) == 1786968000


def test_second_boundaries_and_ratio(spark):
    early, late = F.expr("timestamp '2024-01-01 00:00:00.9'"), F.expr("timestamp '2024-01-01 00:00:01.1'")
    assert one(spark, moments.second_boundaries(early, late)) == 1
    assert one(spark, moments.seconds_between(early, late)) == pytest.approx(0.2)
    assert one(spark, moments.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, moments.ratio(F.lit(1), F.lit(4))) == 0.25
