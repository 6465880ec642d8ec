"""Incremental loads of the position facts.

A fact partition (date, hour) depends on exactly one raw partition, because both columns
follow from the snapshot time and that time is part of the grain. Rebuilding the touched
partitions is therefore a correct upsert: it needs no merge, does not read the target, can
be repeated, and handles replays and late snapshots.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlake.plans.positions import positions_from_states
from airlake.plans.warehouse import FACT, HOUR, Warehouse, touched_folders
from airlake.sources.lake import hours_since, scan_hours, scan_states, since, states_path
from airlake.sources.schemas import LAKE_STATES
from airlake.sources.tables import CommittedTable


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The fact table in the schema of its manifest; columns added later are null in older files."""
    return CommittedTable(spark, path).read()


# High-water mark ----------------------------------------------------------------------


def high_water_mark(spark: SparkSession, path: str) -> int:
    """Newest loaded snapshot in epoch seconds, 0 for an empty or missing table.

    Only the newest partition is opened; it is found by its name.
    """
    table = CommittedTable(spark, path)
    if not table.exists():
        return 0
    return table.newest().agg(F.unix_seconds(F.max("snapshot_at")).alias("seconds")).first()["seconds"] or 0


def incremental_slice(states: DataFrame, high_water: int) -> DataFrame:
    """Facts newer than the mark. Replayed or late snapshots at or below it are ignored."""
    return positions_from_states(states.where(since(high_water)))


def append_new(spark: SparkSession, lake_root: str, path: str) -> None:
    """Load what is newer than the newest loaded snapshot.

    Only the raw hours from the mark on are listed and read. The mark's own hour keeps its facts beside the new ones.
    """
    table, mark = CommittedTable(spark, path), high_water_mark(spark, path)
    states = scan_hours(spark, lake_root, hours_since(spark, lake_root, mark))
    fresh = incremental_slice(states, mark)
    if table.exists():
        bound = dt.datetime.fromtimestamp(mark, dt.timezone.utc)
        held = table.read(folders=touched_folders(FACT, [(bound.date(), bound.hour)]))
        fresh = held.unionByName(fresh, allowMissingColumns=True)
    table.write(fresh, HOUR, keep_rest=True)


# Partition rebuild --------------------------------------------------------------------


def touched_since(spark: SparkSession, lake_root: str, modified_after: str) -> DataFrame:
    """Hours holding raw files written after an instant (``YYYY-MM-DDTHH:mm:ss``, UTC)."""
    return (
        spark.read.schema(LAKE_STATES)
        .option("modifiedAfter", modified_after)
        .option("timeZone", "UTC")
        .parquet(states_path(lake_root))
        .select(*HOUR)
        .distinct()
    )


def rebuild_partitions(spark: SparkSession, lake_root: str, path: str, touched: DataFrame) -> list[tuple[dt.date, int]]:
    """Recompute the touched hours from raw data and replace them in the fact table; returns the hours.

    The hours (at most 24 per day of data) are collected, and only their raw folders are listed and read,
    once. Hours that have no usable position any more lose their old facts: the files written say which
    hours have any. The table changes in one step.
    """
    hours = sorted(tuple(row) for row in touched.select(*HOUR).distinct().collect())
    if hours:
        facts = positions_from_states(scan_hours(spark, lake_root, hours))
        CommittedTable(spark, path).write(facts, HOUR, replace=touched_folders(FACT, hours), keep_rest=True)
    return hours


def refresh_touched(
    warehouse: Warehouse, lake_root: str, touched: DataFrame, rollups: bool = True, only: Iterable[str] | None = None
) -> None:
    """The same for every table behind the facts: see ``Warehouse.refresh_hours``."""
    hours = sorted(tuple(row) for row in touched.select(*HOUR).distinct().collect())
    warehouse.refresh_hours(hours, scan_hours(warehouse.spark, lake_root, hours), rollups, only)


def full_refresh(spark: SparkSession, lake_root: str, path: str) -> None:
    """Rebuild the whole fact table; partitions without raw data disappear."""
    CommittedTable(spark, path).write(positions_from_states(scan_states(spark, lake_root)), HOUR)
