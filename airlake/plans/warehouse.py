"""Models by name: views are lazy plans, tables are committed versions that their consumers read.

A build writes a new version beside the present one, checks it, and only then publishes it: readers see
the former table or the new one. Opening a table reads its manifest, never the models behind it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airlake.operators.quality import (
    QualityError,
    failures,
    reference_report,
    table_report,
    union_all,
)
from airlake.plans import marts, positions, staging
from airlake.plans.contracts import CONTRACTS, quarantine_report
from airlake.session import prepare
from airlake.sources.adapter import Bronze
from airlake.sources.tables import CommittedTable, Staged, folder_name, is_readable

# Model -> how it is made from the models before it. The order is a valid build order.
VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_states": lambda w: staging.stg_states(w.bronze.states),
    "stg_airports": lambda w: staging.stg_airports(w.bronze.airports),
    "stg_air_quality": lambda w: staging.stg_air_quality(w.bronze.air_quality),
    "stg_registry": lambda w: staging.stg_registry(w.bronze.registry),
    "stg_airlines": lambda w: staging.stg_airlines(w.bronze.airlines),
    "int_positions_deduplicated": lambda w: positions.int_positions_deduplicated(w["stg_states"]),
}
TABLES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "fct_aircraft_positions": lambda w: positions.fct_aircraft_positions(
        w["int_positions_deduplicated"]
    ),
    "dim_airport": lambda w: marts.dim_airport(w["stg_airports"]),
    "dim_airline": lambda w: marts.dim_airline(w["stg_airlines"]),
    # What the aircraft dimension needs of the facts, per day; additive, so a day is refreshed alone.
    "int_aircraft_usage": lambda w: marts.aircraft_usage(w["fct_aircraft_positions"]),
    "dim_aircraft": lambda w: marts.dim_aircraft(
        w["int_aircraft_usage"], w["stg_registry"], w["dim_airline"]
    ),
    # A view in a single-node engine; written here because two facts read it.
    "int_positions_near_airports": lambda w: marts.int_positions_near_airports(
        w["fct_aircraft_positions"], w["dim_airport"]
    ),
    "fct_traffic_hourly": lambda w: marts.fct_traffic_hourly(w["fct_aircraft_positions"]),
    "fct_airport_activity": lambda w: marts.fct_airport_activity(
        w["int_positions_near_airports"], w["dim_airport"]
    ),
    "fct_airline_airport_activity": lambda w: marts.fct_airline_airport_activity(
        w["int_positions_near_airports"], w["dim_airport"], w["dim_airline"]
    ),
    "fct_airport_hourly_air_quality": lambda w: marts.fct_airport_hourly_air_quality(
        w["fct_airport_activity"], w["stg_air_quality"]
    ),
    "fct_airport_aircraft_sketches": lambda w: marts.fct_airport_aircraft_sketches(
        w["int_positions_near_airports"]
    ),
}
# Tables that do not read each other, built at the same time: the tail of one job leaves
# executors idle that another can use.
WAVES = [
    ["fct_aircraft_positions", "dim_airport", "dim_airline"],
    ["int_aircraft_usage", "int_positions_near_airports", "fct_traffic_hourly"],
    ["dim_aircraft", "fct_airport_activity", "fct_airline_airport_activity", "fct_airport_aircraft_sketches"],
    ["fct_airport_hourly_air_quality"],
]
# Table -> the tables it reads.
READS: dict[str, list[str]] = {
    "int_aircraft_usage": ["fct_aircraft_positions"],
    "dim_aircraft": ["int_aircraft_usage", "dim_airline"],
    "int_positions_near_airports": ["fct_aircraft_positions", "dim_airport"],
    "fct_traffic_hourly": ["fct_aircraft_positions"],
    "fct_airport_activity": ["int_positions_near_airports", "dim_airport"],
    "fct_airline_airport_activity": ["int_positions_near_airports", "dim_airport", "dim_airline"],
    "fct_airport_hourly_air_quality": ["fct_airport_activity"],
    "fct_airport_aircraft_sketches": ["int_positions_near_airports"],
}
FACT = "fct_aircraft_positions"
HOUR = ["ingest_date", "ingest_hour"]
DAY = ["ingest_date"]
# Every partition of these follows from the same partition of the tables it reads, because the snapshot's date and
# hour are part of every grain between. So hours that change in the facts are the hours that change here.
PARTITIONS = {
    FACT: HOUR,
    "int_aircraft_usage": DAY,
    "int_positions_near_airports": HOUR,
    "fct_traffic_hourly": HOUR,
    "fct_airport_activity": HOUR,
    "fct_airport_hourly_air_quality": HOUR,
    "fct_airport_aircraft_sketches": HOUR,
}
# Partition columns that only the files have.
HIDDEN: dict[str, dict[str, Callable[[], Column]]] = {
    "fct_traffic_hourly": {"ingest_hour": lambda: F.hour("traffic_hour")},
    "fct_airport_activity": {"ingest_hour": lambda: F.hour("activity_hour")},
    "fct_airport_hourly_air_quality": {
        "ingest_date": lambda: F.to_date("activity_hour"),
        "ingest_hour": lambda: F.hour("activity_hour"),
    },
    "fct_airport_aircraft_sketches": {"ingest_hour": lambda: F.hour("activity_hour")},
}
# Built from raw data that retention removes.
OUTLIVES_RAW = {FACT}
# Views whose rows a table keeps one for one: their checks read the table, after it is
# written, instead of repeating the work behind the view.
READ_FROM = {"int_positions_deduplicated": "fct_aircraft_positions"}
SCHEMAS = {"stg": "staging", "int": "intermediate", "dim": "marts", "fct": "marts"}


def schema_of(model: str) -> str:
    return SCHEMAS[model[:3]]


Hours = Iterable[tuple[dt.date, int]]


def behind(model: str) -> set[str]:
    """A table and every table that it is made from."""
    return {model}.union(*(behind(read) for read in READS.get(model, ())))


def touched_folders(model: str, hours: Hours) -> list[str]:
    """The partition folders of a table that the given hours are in."""
    columns = PARTITIONS[model]
    return sorted({folder_name(**dict(zip(columns, hour))) for hour in hours})


class _Touched:
    """The models as seen from given hours, or from all hours of their days: partitioned tables are only those
    partitions."""

    def __init__(self, warehouse: Warehouse, hours: list[tuple[dt.date, int]], whole_days: bool):
        self.warehouse, self.hours, self.whole_days = warehouse, hours, whole_days

    def __getitem__(self, model: str) -> DataFrame:
        if model not in PARTITIONS:
            return self.warehouse[model]
        table = self.warehouse.table(model)
        folders = touched_folders(model, self.hours)
        if self.whole_days:
            days = {folder.split("/")[0] for folder in folders}
            folders = [folder for folder in table.folders() if folder.split("/")[0] in days]
        return table.read(folders=folders)


class Warehouse:
    """The models over one set of raw tables, kept under one folder all executors can reach."""

    def __init__(self, spark: SparkSession, bronze: Bronze, root: str):
        self.spark = prepare(spark)
        self.bronze = bronze
        self.root = root.rstrip("/")
        self._views: dict[str, DataFrame] = {}
        self._opened: dict[str, DataFrame] = {}

    def path(self, model: str) -> str:
        return f"{self.root}/{schema_of(model)}/{model}"

    def table(self, model: str) -> CommittedTable:
        return CommittedTable(self.spark, self.path(model))

    def plan(self, model: str) -> DataFrame:
        """The model as a plan over its inputs, not written."""
        return {**VIEWS, **TABLES}[model](self)

    def __getitem__(self, model: str) -> DataFrame:
        """The model as its consumers see it.

        A table that is published is opened from its manifest, whoever wrote it: reading never
        replaces rows nor plans what the table was made from. Only one that does not exist yet is built.
        """
        if model in VIEWS:
            if model not in self._views:
                self._views[model] = self.plan(model)
            return self._views[model]
        if model not in self._opened:
            if self.table(model).exists():
                self._opened[model] = self._visible(model, self.table(model).read())
            else:
                self.build(model)
        return self._opened[model]

    def newest(self, model: str) -> DataFrame:
        """The rows of a table's newest partition, found by its name."""
        self[model]
        return self._visible(model, self.table(model).newest())

    @staticmethod
    def _visible(model: str, df: DataFrame) -> DataFrame:
        return df.drop(*HIDDEN.get(model, ()))

    # Building -------------------------------------------------------------------------

    def _stage(self, model: str, df: DataFrame) -> Staged:
        hidden = {name: column() for name, column in HIDDEN.get(model, {}).items()}
        return self.table(model).stage(df.withColumns(hidden) if hidden else df, PARTITIONS.get(model))

    def _publish(self, model: str, staged: Staged, **how) -> DataFrame:
        self.table(model).publish(staged, **how)
        self._opened[model] = self._visible(model, self.table(model).read())
        return self._opened[model]

    def build(self, model: str, full_refresh: bool = False) -> DataFrame:
        """Refresh one table from its inputs.

        Facts outlive their raw data: partitions that the raw data no longer has stay, unless a
        full refresh is asked for.
        """
        keep = model in OUTLIVES_RAW and not full_refresh
        return self._publish(model, self._stage(model, self.plan(model)), keep_rest=keep)

    def build_all(self, tables: list[str]) -> None:
        """Fully refresh tables that do not depend on each other, side by side."""
        with ThreadPoolExecutor(max(1, len(tables))) as pool:
            list(pool.map(self.build, tables))

    def report(self, models: list[str] | None = None, known: set[str] | None = None, staged: dict | None = None) -> DataFrame:
        """One row per check of the given models (all by default).

        References are included when both ends are in ``known`` (by default, always). ``staged`` has
        rows that are checked in place of what is published.
        """
        chosen = models or list(CONTRACTS)
        staged = staged or {}

        def rows(model: str) -> DataFrame:
            return staged[model] if model in staged else self[model]

        parts = []
        for model in chosen:
            parts.append(table_report(model, rows(READ_FROM.get(model, model)), CONTRACTS[model]))
        for child, contract in CONTRACTS.items():
            for column, (parent, parent_column) in contract.references.items():
                due = child in chosen if known is None else (
                    {child, parent} <= known and (child in chosen or parent in chosen)
                )
                if due:
                    parts.append(reference_report(child, rows(child), column, rows(parent), parent_column))
        return union_all(parts)

    def run(self, only: list[str] | None = None, checks: bool = True) -> list:
        """Write, check and publish everything in order.

        The tables of a step are written beside their present versions and checked there. Returns the
        report rows; an error-level violation raises and stops the build: nothing of its step is published, so
        readers keep the former versions, and nothing after it is built. ``only`` restricts the models refreshed and
        checked. Payloads that could not be read (see the quarantine) fail before anything is written.
        """
        rows, known = [], set()
        if checks and only is None and self.bronze.quarantine is not None:
            rows += self._gate(quarantine_report(self.bronze.quarantine), {})
        for step in [[view] for view in VIEWS] + WAVES:
            chosen = [m for m in step if m not in READ_FROM and (only is None or m in only)]
            tables = [model for model in chosen if model in TABLES]
            with ThreadPoolExecutor(max(1, len(tables))) as pool:
                staged = dict(zip(tables, pool.map(lambda m: self._stage(m, self.plan(m)), tables)))
            chosen += [view for view, table in READ_FROM.items() if table in chosen]
            known.update(chosen)
            declared = [model for model in chosen if model in CONTRACTS]
            if checks and declared:
                fresh = {m: self._visible(m, self.table(m).read_staged(s)) for m, s in staged.items()}
                rows += self._gate(self.report(declared, known, fresh), staged)
            for model, files in staged.items():
                self._publish(model, files, keep_rest=model in OUTLIVES_RAW)
        return rows

    def _gate(self, report: DataFrame, staged: dict[str, Staged]) -> list:
        rows = report.collect()
        failed = failures(rows)
        if failed:
            for model, files in staged.items():
                self.table(model).discard(files)
            raise QualityError(failed)
        return rows

    # Upkeep after incremental loads -----------------------------------------------------

    def refresh_hours(
        self, hours: Hours, states: DataFrame | None = None, rollups: bool = True, only: Iterable[str] | None = None
    ) -> None:
        """Bring every table up to date after the raw data of some hours changed.

        The touched hours of the facts are the touched hours of every hourly table behind them, so each is
        recomputed from those partitions alone and replaces just them; hours that have no rows any more disappear. Each
        table changes in one step. ``states`` are the raw rows of these hours (by default those of the raw
        table). ``rollups`` also refreshes the tables over the whole history. ``only`` restricts the tables behind
        the facts that are refreshed; it should hold all that they read (see ``behind``).
        """
        hours, chosen = sorted(set(hours)), set(TABLES if only is None else only)
        if not hours:
            return
        if not self.table(FACT).exists():
            raise ValueError("refresh_hours needs a first build")
        states = self.bronze.states.where(hours_predicate(hours)) if states is None else states
        self._replace(FACT, positions.positions_from_states(states), hours)

        def replace(model: str) -> None:
            touched = _Touched(self, hours, whole_days=PARTITIONS[model] == DAY)
            self._replace(model, TABLES[model](touched), hours)

        for wave in WAVES[1:]:
            hourly = [m for m in wave if m in PARTITIONS and m in chosen]
            with ThreadPoolExecutor(max(1, len(hourly))) as pool:
                list(pool.map(replace, hourly))
            if rollups:
                self.build_all([m for m in wave if m not in PARTITIONS and m in chosen])

    def _replace(self, model: str, df: DataFrame, hours: Hours) -> None:
        self._publish(model, self._stage(model, df), replace=touched_folders(model, hours), keep_rest=True)

    def vacuum(self, keep: int = 2) -> int:
        """Delete files that only versions before the newest ``keep`` name."""
        return sum(self.table(model).vacuum(keep) for model in TABLES)

    # Catalogue --------------------------------------------------------------------------

    def register(self) -> None:
        """Publish the models for SQL: staging views as temporary views, tables as views of their schema.

        A view is replaced in one step and names the files of one version; register again after a build.
        """
        for model in VIEWS:
            self[model].createOrReplaceTempView(model)
        for schema in sorted({schema_of(model) for model in TABLES}):
            self.spark.sql(f"create database if not exists {schema}")
        for model in TABLES:
            columns = ", ".join(f"`{name}`" for name in self[model].columns)  # built on first use
            body = f"select {columns} from ({self.table(model).view_sql()})"
            self.spark.sql(f"create or replace view {schema_of(model)}.{model} as {body}")

    def inventory(self) -> DataFrame:
        """Schema, table and row count of every table; -1 when a table cannot be read.

        Each count is taken here, so that one unreadable table does not fail the others.
        """
        counted = [(schema_of(model), model, is_readable(self.table(model))) for model in sorted(TABLES)]
        return self.spark.createDataFrame(counted, "table_schema string, table_name string, rows bigint")


def hours_predicate(hours: Hours) -> Column:
    """Literal filter for exactly these partitions; dates sharing their hours share a clause."""
    by_date: dict[dt.date, set[int]] = {}
    for date, hour in hours:
        by_date.setdefault(date, set()).add(hour)
    dates: dict[frozenset[int], list[dt.date]] = {}
    for date, day_hours in sorted(by_date.items()):
        dates.setdefault(frozenset(day_hours), []).append(date)
    found = F.lit(False)
    for day_hours, days in dates.items():
        found = found | (F.col("ingest_date").isin(*days) & F.col("ingest_hour").isin(*sorted(day_hours)))
    return found
