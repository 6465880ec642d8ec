from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from airlake.plans.positions import GRAIN, positions_from_states
from airlake.plans.staging import stg_states
from airlake.plans.warehouse import READS, TABLES, Warehouse, behind, hours_predicate
from airlake.sources import lake
from airlake.sources.adapter import Bronze, bronze_from_tables
from airlake.sources.schemas import LAKE_STATES
from airlake.sources.tables import CommittedTable
from airlake.streaming import incremental, stream
from tests.conftest import SMALL
from tests.test_lake import T, snapshot


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "lake"), str(tmp_path / "facts"), str(tmp_path / "checkpoint")


def land(spark, root, *snapshots):
    for ts, count, callsign in snapshots:
        lake.write_states(snapshot(spark, ts, count, callsign=callsign), root)


def summary(spark, path):
    facts = incremental.read_facts(spark, path)
    counted = facts.groupBy(F.unix_seconds("snapshot_at").alias("ts"), "callsign").count()
    return sorted((r["ts"] - T, r["callsign"], r["count"]) for r in counted.collect())


def test_high_water_loads_only_newer_snapshots(spark, place):
    root, path, _ = place
    land(spark, root, (T, 3, "A"), (T + 900, 2, "A"))
    incremental.append_new(spark, root, path)
    assert incremental.high_water_mark(spark, path) == T + 900
    land(spark, root, (T + 450, 5, "LATE"), (T, 1, "REPLAYED"), (T + 1800, 4, "B"))
    incremental.append_new(spark, root, path)
    # Late and replayed snapshots at or below the mark are ignored by this strategy.
    assert summary(spark, path) == [(0, "A", 3), (900, "A", 2), (1800, "B", 4)]
    incremental.append_new(spark, root, path)
    assert summary(spark, path) == [(0, "A", 3), (900, "A", 2), (1800, "B", 4)]


def test_rebuild_handles_replays_and_late_snapshots_and_can_be_repeated(spark, place):
    root, path, _ = place
    land(spark, root, (T, 3, "A"), (T + 900, 2, "A"), (T + 7200, 1, "A"))
    incremental.full_refresh(spark, root, path)
    land(spark, root, (T + 450, 5, "LATE"), (T, 1, "REPLAYED"))
    touched = lake.scan_states(spark, root).where(F.col("snapshot_ts") < T + 900)
    for _ in range(2):
        incremental.rebuild_partitions(spark, root, path, touched)
        assert summary(spark, path) == [
            (0, "REPLAYED", 1), (450, "LATE", 5), (900, "A", 2), (7200, "A", 1),
        ]
    incremental.rebuild_partitions(spark, root, path, touched.where("false"))
    assert len(summary(spark, path)) == 4


def test_an_hour_that_loses_its_rows_loses_its_facts(spark, place):
    root, path, _ = place
    land(spark, root, (T, 3, "A"), (T + 7200, 1, "A"), (T + 14400, 2, "A"))
    incremental.full_refresh(spark, root, path)
    hours = lake.scan_states(spark, root).where(F.col("snapshot_ts") < T + 14400).select(*incremental.HOUR).distinct()
    hours = spark.createDataFrame(hours.collect(), hours.schema)
    # One hour is delivered again without a usable position, the other without any row.
    lake.write_states(snapshot(spark, T, 2, callsign="A").withColumn("latitude", F.lit(None).cast("double")), root)
    lake.clear_snapshots(spark, root, [(T + 7200, "france")])
    for _ in range(2):
        incremental.rebuild_partitions(spark, root, path, hours)
        assert summary(spark, path) == [(14400, "A", 2)]


def test_rebuilding_every_hour_equals_a_full_refresh(spark, place, rows, tmp_path):
    root, path, _ = place
    land(spark, root, (T, 3, "A"), (T + 90000, 2, "B"))
    incremental.rebuild_partitions(spark, root, path, lake.scan_states(spark, root))
    other = str(tmp_path / "other")
    incremental.full_refresh(spark, root, other)
    read = incremental.read_facts
    assert rows(read(spark, path)) == rows(read(spark, other)) and read(spark, path).count() == 5


def test_full_refresh_drops_partitions_without_raw_data(spark, place, tmp_path):
    root, path, _ = place
    land(spark, root, (T, 3, "A"), (T + 86400, 2, "B"))
    incremental.full_refresh(spark, root, path)
    smaller = str(tmp_path / "smaller")
    land(spark, smaller, (T, 3, "A"))
    incremental.full_refresh(spark, smaller, path)
    assert summary(spark, path) == [(0, "A", 3)]


def test_touched_hours_come_from_file_times(spark, place, rows):
    root, _, _ = place
    land(spark, root, (T, 3, "A"))
    assert incremental.touched_since(spark, root, "2000-01-01T00:00:00").count() == 1
    assert incremental.touched_since(spark, root, "2100-01-01T00:00:00").count() == 0


def test_hours_predicate_is_exact(spark):
    import datetime as dt

    first, second = dt.date(2026, 8, 17), dt.date(2026, 8, 18)
    hours = [(first, 1), (first, 2), (second, 2)]
    grid = spark.createDataFrame(
        [(d, h) for d in (first, second) for h in range(4)], "ingest_date date, ingest_hour int"
    )
    kept = grid.where(hours_predicate(hours)).collect()
    assert sorted(tuple(r) for r in kept) == hours


def test_facts_keep_the_last_ingested_version(spark):
    old = snapshot(spark, T, 2, callsign="OLD")
    new = snapshot(spark, T, 1, callsign="NEW").withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("interval 1 minute")
    )
    facts = positions_from_states(lake.with_partitions(new.unionByName(old)))
    assert sorted((r["aircraft_icao24"], r["callsign"]) for r in facts.collect()) == [
        ("000000", "NEW"), ("000001", "OLD"),
    ]


def test_stream_upsert_equals_batch(spark, place, rows, tmp_path):
    root, path, checkpoint = place
    land(spark, root, (T, 3, "A"), (T + 900, 2, "A"))
    stream.start_upsert(spark, root, path, checkpoint, max_files=1).awaitTermination()
    land(spark, root, (T + 450, 5, "LATE"), (T, 1, "REPLAYED"))
    stream.start_upsert(spark, root, path, checkpoint, max_files=1).awaitTermination()
    batch = str(tmp_path / "batch")
    incremental.full_refresh(spark, root, batch)
    read = incremental.read_facts
    assert rows(read(spark, path)) == rows(read(spark, batch))
    assert summary(spark, path) == [(0, "REPLAYED", 1), (450, "LATE", 5), (900, "A", 2)]


def test_stream_refreshes_the_marts_behind_the_facts(spark, place, rows, tmp_path):
    """Late and replayed snapshots too: hourly tables equal those of a full build."""
    root, _, checkpoint = place
    bronze = bronze_from_tables(spark, SMALL)
    states = bronze.states.where("ingest_date <= '2024-01-02'")
    late = F.col("snapshot_ts") % 1800 == 0

    def present(out):
        return Warehouse(spark, Bronze(**{**vars(bronze), "states": lake.scan_states(spark, root)}), str(tmp_path / out))

    lake.write_states(states.where(~late), root)
    w = present("stream")
    w.run(checks=False)
    stream.start_refresh(w, root, checkpoint, max_files=40).awaitTermination()
    lake.write_states(states.where(late), root)
    lake.write_states(states.where("snapshot_ts % 7 = 0").withColumn("callsign", F.lit("REPLAY1")), root)
    stream.start_refresh(w, root, checkpoint, max_files=40, rollups=True).awaitTermination()
    full = present("full")
    full.run(checks=False)
    for model in TABLES:
        if model != "fct_airport_aircraft_sketches":
            got, expected = (
                df.select([F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes]) for df in (w[model], full[model])
            )
            assert rows(got) == rows(expected), model


def test_refresh_can_be_limited_to_what_a_model_reads(spark, tmp_path, monkeypatch):
    written = []
    for model, made in TABLES.items():
        assert {name for name in made.__code__.co_consts if name in TABLES} == set(READS.get(model, ()))
    for model in TABLES:
        monkeypatch.setitem(TABLES, model, lambda w: None)
    monkeypatch.setattr(CommittedTable, "exists", lambda self: True)
    monkeypatch.setattr(Warehouse, "_replace", lambda self, model, df, hours: written.append(model))
    monkeypatch.setattr(Warehouse, "build_all", lambda self, models: written.extend(models))
    w = Warehouse(spark, None, str(tmp_path))
    hours, states = [(dt.date(2024, 1, 1), 0)], spark.createDataFrame([], LAKE_STATES)
    w.refresh_hours(hours, states, only=behind("dim_aircraft"))
    assert written == ["fct_aircraft_positions", "int_aircraft_usage", "dim_aircraft"]
    written.clear()
    w.refresh_hours(hours, states)
    assert set(written) == set(TABLES) - {"dim_airport", "dim_airline"}


def test_late_rows_are_recorded(spark, place):
    root, path, checkpoint = place
    late = stream.LateRows(spark, path + "-late", 3600)
    land(spark, root, (T, 3, "A"), (T + 7200, 2, "A"))
    stream.start_upsert(spark, root, path, checkpoint, late=late).awaitTermination()
    assert late.rows().count() == 0
    land(spark, root, (T + 600, 5, "LATE"), (T + 4000, 1, "INTIME"))
    stream.start_upsert(spark, root, path, checkpoint, late=late).awaitTermination()
    land(spark, root, (T + 900, 2, "LATE"), (T + 9000, 1, "NEW"))
    stream.start_upsert(spark, root, path, checkpoint, late=late).awaitTermination()
    got = late.rows().select(F.unix_seconds("traffic_hour").alias("ts"), "ingestion_region", "rows").collect()
    assert [(r["ts"] - T, r["ingestion_region"], r["rows"]) for r in got] == [(0, "france", 7)]
    # They are in the facts, which a watermark would have kept them out of.
    assert (600, "LATE", 5) in summary(spark, path)
    # A batch that is run again counts against the same mark and replaces itself.
    again = lake.scan_hours(spark, root, lake.hours_since(spark, root, T)).where(F.col("snapshot_ts") == T + 900)
    late.record(again, 2)
    assert late.rows().agg(F.sum("rows")).first()[0] == 7


def test_stream_counts_leave_no_folder_per_batch(spark, place, monkeypatch):
    root, path, checkpoint = place
    monkeypatch.setattr(stream, "KEEP_VERSIONS", 2)
    for k in range(5):
        land(spark, root, (T + 900 * k, 1 + k, "A"))
        counts = stream.hourly_counts(stream.stream_deduplicated(stg_states(stream.stream_states(spark, root)), "1 day"))
        stream.start_hourly_counts(counts, path, checkpoint).awaitTermination()
    assert len(os.listdir(f"{path}/data")) <= 3 and stream.current_counts(spark, path).agg(F.sum("position_count")).first()[0] == 15


def test_stream_counts_each_position_once(spark, place, tmp_path):
    root, path, checkpoint = place
    land(spark, root, (T, 3, "A"), (T + 900, 2, "A"), (T + 3600, 4, "A"))
    # A second copy of one snapshot beside the first, as two overlapping workers leave it.
    copy = lake.with_partitions(snapshot(spark, T, 3, callsign="A")).withColumn("snapshot", F.lit(T + 1))
    copy.write.mode("append").partitionBy("ingest_date", "ingest_hour", "snapshot").parquet(
        lake.states_path(root)
    )
    staged = stg_states(stream.stream_states(spark, root))
    counts = stream.hourly_counts(stream.stream_deduplicated(staged, "1 day"))
    assert counts.isStreaming
    stream.start_hourly_counts(counts, path, checkpoint).awaitTermination()
    land(spark, root, (T + 1800, 6, "A"))
    stream.start_hourly_counts(counts, path, checkpoint).awaitTermination()
    got = stream.current_counts(spark, path).select(
        F.unix_seconds("traffic_hour").alias("ts"), "position_count"
    )
    assert sorted((r["ts"] - T, r["position_count"]) for r in got.collect()) == [(0, 11), (3600, 4)]


def test_batch_dedup_and_stream_dedup_share_the_grain():
    assert GRAIN == ["aircraft_icao24", "snapshot_at"]
