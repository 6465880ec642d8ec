"""Committed tables: versions, partial changes, schema evolution, upkeep, and what a build publishes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F, types as T

from airlake.operators.quality import QualityError
from airlake.plans.warehouse import HIDDEN, PARTITIONS, TABLES, WAVES, Warehouse
from airlake.sources import lake
from airlake.sources.adapter import Bronze, bronze_from_tables
from airlake.sources.tables import CommittedTable, SchemaChange, folder_name, merged
from airlake.streaming import incremental
from tests.conftest import SMALL


@pytest.fixture
def table(spark, tmp_path):
    return CommittedTable(spark, str(tmp_path / "t"))


def numbers(spark, *rows):
    return spark.createDataFrame(rows, "day int, hour int, x string")


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_replace_each_other_whole(spark, table):
    assert not table.exists() and table.manifest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(numbers(spark, (1, 1, "a")))
    held = table.read()
    table.write(numbers(spark, (2, 2, "b"), (2, 3, "c")))
    assert content(table.read()) == [(2, 2, "b"), (2, 3, "c")]
    # A reader that opened the former version keeps it, and it can be opened by its number.
    assert content(held) == [(1, 1, "a")] == content(table.read(1))
    table.write(numbers(spark).where("false"))
    assert table.read().count() == 0 and table.read().columns == ["day", "hour", "x"]


def test_staged_rows_are_not_the_table(spark, table):
    table.write(numbers(spark, (1, 1, "a")))
    staged = table.stage(numbers(spark, (9, 9, "z")))
    assert content(table.read()) == [(1, 1, "a")] and content(table.read_staged(staged)) == [(9, 9, "z")]
    table.discard(staged)
    assert len(os.listdir(f"{table.path}/data")) == 1
    assert table.vacuum() == 0


def test_partial_changes_replace_and_remove_partitions(spark, table):
    table.write(numbers(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "n")), ["day", "hour"])
    table.write(numbers(spark, (1, 2, "B")), ["day", "hour"], keep_rest=True, replace=[folder_name(day=2, hour=1)])
    assert content(table.read()) == [(1, 1, "a"), (1, 2, "B"), (None, 1, "n")]
    assert table.folders() == ["day=1/hour=1", "day=1/hour=2", "day=__HIVE_DEFAULT_PARTITION__/hour=1"]
    assert content(table.read(folders=["day=1/hour=2", "day=7/hour=7"])) == [(1, 2, "B")]
    table.write(numbers(spark, (1, 10, "x"), (1, 9, "y")), ["day", "hour"], keep_rest=True)
    assert content(table.newest()) == [(1, 10, "x")]  # by value, not by name
    with pytest.raises(SchemaChange):
        table.write(numbers(spark, (1, 1, "a")), ["day"], keep_rest=True)


def test_writers_do_not_overwrite_each_other(spark, table):
    """A writer whose number was taken in between applies its change to what the other left."""
    table.write(numbers(spark, (1, 1, "a"), (2, 1, "b")), ["day", "hour"])
    other, seen = CommittedTable(spark, table.path), []
    put = table.folder.put

    def slow(name, text):
        if not seen:
            seen.append(name)
            other.write(numbers(spark, (2, 1, "theirs")), ["day", "hour"], keep_rest=True)
        return put(name, text)

    table.folder.put = slow
    table.write(numbers(spark, (1, 1, "mine")), ["day", "hour"], keep_rest=True)
    assert content(table.read()) == [(1, 1, "mine"), (2, 1, "theirs")] and table.versions() == [1, 2, 3]
    assert not [n for n in os.listdir(f"{table.path}/manifests") if n.endswith(".json") is False and "crc" not in n]


def test_columns_may_be_added_but_not_retyped(spark, table):
    table.write(numbers(spark, (1, 1, "a")).drop("x"), ["day"])
    table.write(numbers(spark, (2, 1, "b")), ["day"], keep_rest=True)
    assert content(table.read().select("day", "hour", "x")) == [(1, 1, None), (2, 1, "b")]
    with pytest.raises(SchemaChange, match="hour"):
        table.write(numbers(spark, (3, 1, "b")).withColumn("hour", F.lit("late")), ["day"], keep_rest=True)
    assert table.read().count() == 2
    # A table that lost a column in a later load keeps it; a full refresh may change everything.
    table.write(numbers(spark, (3, 1, "b")).drop("hour"), ["day"], keep_rest=True)
    assert [r["hour"] for r in table.read().where("day = 3").collect()] == [None]
    table.write(numbers(spark, (3, 1, "b")).withColumn("hour", F.lit("late")), ["day"])
    assert dict(table.read().dtypes)["hour"] == "string"
    spark.sql(f"create or replace temp view v as {table.view_sql()}")
    assert spark.table("v").count() == 1
    same = T.StructType([T.StructField("a", T.IntegerType())])
    assert merged(same, same) == same


def test_view_follows_partly_replaced_commits(spark, table):
    more = numbers(spark, (1, 2, "B")).withColumn("y", F.lit(7))
    table.write(numbers(spark, (1, 1, "a"), (1, 2, "b"), (None, 3, "n")), ["day", "hour"])
    table.write(more, ["day", "hour"], keep_rest=True)
    spark.sql(f"create or replace temp view v as {table.view_sql()}")
    expected = [(1, 1, "a", None), (1, 2, "B", 7), (None, 3, "n", None)]
    assert content(spark.table("v").select("day", "hour", "x", "y")) == expected
    assert content(table.read().select("day", "hour", "x", "y")) == expected


def test_vacuum_and_compaction(spark, table):
    table.write(numbers(spark, *[(d, 1, "a") for d in range(4)]), ["day", "hour"])
    for d in range(3):
        table.write(numbers(spark, (d, 1, "b")), ["day", "hour"], keep_rest=True)
    before = content(table.read())
    assert table.vacuum(keep=1) == 3 and table.versions() == [4]
    assert content(table.read()) == before and len(os.listdir(f"{table.path}/data")) == 4
    table.compact()
    assert content(table.read()) == before and len(table.manifest().commits) == 1
    assert table.vacuum(keep=1) == 4 and content(table.read()) == before


# Warehouse ----------------------------------------------------------------------------


def test_opening_a_table_neither_writes_nor_plans_others(spark, tmp_path):
    root = str(tmp_path / "w")
    first = Warehouse(spark, bronze_from_tables(spark, SMALL), root)
    activity = first["fct_airport_activity"].count()
    lone = str(tmp_path / "alone")
    path = first.path("fct_airport_activity")
    staged = Warehouse(spark, None, lone)
    # The store holds this table alone; without raw tables nothing could be planned.
    staged.table("fct_airport_activity").write(CommittedTable(spark, path).read(), PARTITIONS["fct_airport_activity"])
    listed = sorted(os.listdir(lone))
    again = Warehouse(spark, None, lone)["fct_airport_activity"]
    assert again.count() == activity > 0 and again.columns == first["fct_airport_activity"].columns
    assert sorted(os.listdir(lone)) == listed == ["marts"] and os.listdir(f"{lone}/marts") == ["fct_airport_activity"]


def test_waves_hold_every_table_after_what_it_reads():
    order = [m for wave in WAVES for m in wave]
    assert sorted(order) == sorted(TABLES) and set(HIDDEN) <= set(PARTITIONS)


def test_a_refused_build_publishes_nothing_of_its_step(spark, tmp_path):
    good = bronze_from_tables(spark, SMALL)
    root, only = str(tmp_path / "w"), ["dim_airport", "dim_airline"]
    w = Warehouse(spark, good, root)
    w.run(only=only)
    faulty = Bronze(**{**vars(good), "airports": good.airports.withColumn("name", F.lit(None).cast("string"))})
    with pytest.raises(QualityError, match="dim_airport.airport_label"):
        Warehouse(spark, faulty, root).run(only=only)
    for model in only:
        table = w.table(model)
        assert table.versions() == [1] and len(os.listdir(f"{table.path}/data")) == 1


def test_newest_partition_is_opened_alone(spark, tmp_path):
    """No scan of the history to find the newest rows: one folder is listed, chosen by its name."""
    w = Warehouse(spark, bronze_from_tables(spark, SMALL), str(tmp_path / "w"))
    facts, newest = w["fct_aircraft_positions"], w.newest("fct_aircraft_positions")
    hours = newest.select("ingest_date", "ingest_hour").distinct().collect()
    top = facts.agg(F.max(F.struct("ingest_date", "ingest_hour"))).first()[0]
    assert [tuple(h) for h in hours] == [tuple(top)]
    assert len(newest.inputFiles()) < len(facts.inputFiles())
    assert all(f"ingest_date={top[0]}/ingest_hour={top[1]}/" in f for f in newest.inputFiles())


def test_loads_open_only_the_hours_they_need(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "facts")
    states = bronze_from_tables(spark, SMALL).states
    mark = 1704196800
    lake.write_states(states.where(F.col("snapshot_ts") <= mark), root)
    incremental.append_new(spark, root, path)
    lake.write_states(states.where(F.col("snapshot_ts") > mark), root)
    reached = incremental.high_water_mark(spark, path)
    assert reached <= mark
    hours = lake.hours_since(spark, root, reached)
    read = lake.scan_hours(spark, root, hours).inputFiles()
    everything = lake.scan_states(spark, root).inputFiles()
    assert 0 < len(read) < len(everything)
    incremental.append_new(spark, root, path)
    assert incremental.read_facts(spark, path).count() == Warehouse(
        spark, bronze_from_tables(spark, SMALL), str(tmp_path / "w")
    )["fct_aircraft_positions"].count()
    newest = lake.newest_states(spark, root)
    assert newest.select("ingest_date", "ingest_hour").distinct().count() == 1
    assert newest.agg(F.max("snapshot_ts")).first() == states.agg(F.max("snapshot_ts")).first()
    assert lake.newest_states(spark, str(tmp_path / "none")).count() == 0


def test_hours_that_lose_their_rows_lose_them_in_every_mart(spark, tmp_path):
    bronze = bronze_from_tables(spark, SMALL)
    w = Warehouse(spark, bronze, str(tmp_path / "w"))
    w.run(checks=False)
    near = w["int_positions_near_airports"]
    hour = near.select("ingest_date", "ingest_hour").first()
    kept = {m: w.table(m).folders() for m in PARTITIONS}
    w.refresh_hours([tuple(hour)], states=bronze.states.where("false"))
    gone = folder_name(ingest_date=hour[0], ingest_hour=hour[1])
    for model, columns in PARTITIONS.items():
        if len(columns) == 2:
            assert w.table(model).folders() == [f for f in kept[model] if f != gone], model
    w.refresh_hours([tuple(hour)])
    assert {m: w.table(m).folders() for m in PARTITIONS} == kept
    with pytest.raises(ValueError):
        Warehouse(spark, bronze, str(tmp_path / "none")).refresh_hours([tuple(hour)])


def test_sketches_estimate_within_their_bound(spark):
    """40,000 aircraft at one airport, each in some of 30 hours: within 3 standard deviations of the count."""
    from airlake.plans import marts

    near = spark.range(120_000).select(
        F.format_string("%06x", F.col("id") % 40_000).alias("aircraft_icao24"),
        F.lit(1).alias("airport_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 30) * 3600).alias("snapshot_at"),
        F.to_date(F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 30) * 3600)).alias("ingest_date"),
    )
    sketches = marts.fct_airport_aircraft_sketches(near)
    assert sketches.count() == 30
    estimate = marts.aircraft_over(sketches, "airport_id").first()["distinct_aircraft"]
    bound = 3 * 1.04 / (2 ** marts.SKETCH_BITS) ** 0.5
    assert abs(estimate / 40_000 - 1) < bound < 0.03
    few = marts.aircraft_over(marts.fct_airport_aircraft_sketches(near.where("id < 300")), "airport_id")
    assert few.first()["distinct_aircraft"] == 300
