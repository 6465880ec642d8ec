"""Landed files to raw tables: one function per source, each leaving an audit row behind."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from airlake.sources import lake, landing
from airlake.sources.adapter import Bronze
from airlake.sources.tracked import tracked_airports


def _moment(given: Column | None) -> Column:
    """The same instant for everything one delivery writes."""
    return F.lit(dt.datetime.now(dt.timezone.utc)) if given is None else given


def land_snapshots(
    spark: SparkSession, path: str, root: str, region: str, ingested_at: Column | None = None
) -> None:
    """State payloads, one JSON file per snapshot. Landing a snapshot again replaces it,
    also with nothing. Rows and audit carry one moment.

    Payloads that cannot be read go to the audit ``quarantine`` with their text and the reason, and the rest
    of the delivery is landed.
    """
    moment, delivery = _moment(ingested_at), uuid.uuid4().hex
    payloads = landing.read_payloads(spark, path)
    lake.append_audit(landing.quarantined(payloads, region, moment), root, "quarantine")
    good = landing.readable(payloads)
    lake.write_states(landing.decode_states(good, region, moment), root)
    audit = landing.audit_snapshots(good, region, moment)
    lake.append_audit(audit.withColumn("delivery", F.lit(delivery)), root)
    # From the audit that was just written; one time per empty snapshot of this delivery.
    delivered = lake.read_audit(spark, root).where(F.col("delivery") == delivery)
    empty = delivered.groupBy("snapshot_ts").agg(F.sum("rows").alias("rows")).where("rows = 0").collect()
    lake.clear_snapshots(spark, root, [(r["snapshot_ts"], region) for r in empty])


def _land_reference(
    spark: SparkSession, path: str, root: str, name: str, table: DataFrame
) -> None:
    lake.write_reference(table, root, name)
    audit = landing.audit_reference(spark, path, table).withColumn("source_name", F.lit(name))
    lake.append_audit(audit, root, "references")


def land_airports(spark: SparkSession, path: str, root: str) -> None:
    _land_reference(spark, path, root, "airports", landing.read_text_csv(spark, path))


def land_registry(spark: SparkSession, path: str, root: str) -> None:
    _land_reference(spark, path, root, "registry", landing.read_registry(spark, path))


def land_airlines(spark: SparkSession, path: str, root: str) -> None:
    _land_reference(spark, path, root, "airlines", landing.read_airlines(spark, path))


def land_air_quality(
    spark: SparkSession,
    path: str,
    root: str,
    airports: DataFrame | None = None,
    ingested_at: Column | None = None,
) -> None:
    """Hourly series, one JSON file per airport, named by the airport's code.

    Files of airports that are not in ``airports`` are recorded in the audit ``rejected``.
    """
    moment = _moment(ingested_at)
    places = tracked_airports(spark) if airports is None else airports
    payloads = landing.read_payloads(spark, path).select(
        "value", F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("airport_icao")
    )
    rows = landing.flatten_hourly(payloads.join(places, "airport_icao"), moment)
    _land_reference(spark, path, root, "air_quality", rows)
    rejected = payloads.join(places, "airport_icao", "left_anti").select(
        F.lit("air_quality").alias("source_name"),
        F.col("airport_icao").alias("file_name"),
        F.lit("airport is not followed").alias("reason"),
        F.octet_length("value").cast("bigint").alias("size_bytes"),
        F.sha2("value", 256).alias("sha256"),
        moment.cast("timestamp").alias("ingested_at"),
    )
    lake.append_audit(rejected, root, "rejected")


def bronze_from_lake(spark: SparkSession, root: str) -> Bronze:
    """The raw tables as they are in the lake now; make a new one after landing files."""
    return Bronze(
        states=lake.scan_states(spark, root),
        **{name: lake.scan_reference(spark, root, name) for name in lake.REFERENCES},
        quarantine=lake.open_quarantine(spark, root),
    )
