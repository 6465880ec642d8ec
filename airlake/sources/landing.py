"""Decoding of landed payloads and reference files into raw (bronze) tables.

Landed files are assumed present; nothing here uses the network. Everything stays text
or typed by a declared schema, so a malformed value becomes null and never stops a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from airlake.functions.text import parse_double, strip
from airlake.sources.schemas import AIR_QUALITY, AIRLINES, REGISTRY, STATE_VECTOR, STATES

# A vector mixes types: its items keep what they were in JSON and are typed by position.
SNAPSHOT = "time bigint, states array<array<variant>>"
RECEIVED = "time bigint, states array<array<string>>"
HOURLY = (
    "hourly struct<time: array<string>, nitrogen_dioxide: array<double>, pm2_5: array<double>, "
    "pm10: array<double>, ozone: array<double>>"
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed JSON file: ``value`` text and ``path``."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))


# State snapshots ----------------------------------------------------------------------

# Fixed value: the last second that a date of four-digit years has.
LAST_SECOND = 253402300799


def unreadable(payload: str = "value") -> Column:
    """Why a state payload cannot be taken, null if it can."""
    document = F.try_parse_json(payload)
    known = F.from_json(payload, RECEIVED)
    states = F.try_variant_get(document, "$.states", "string")
    kind = F.schema_of_variant(F.try_variant_get(document, "$.states", "variant"))
    return (
        F.when(document.isNull(), "not JSON")
        .when(known["time"].isNull(), "no time")
        .when(~known["time"].between(0, LAST_SECOND), "time out of range")
        .when(states.isNotNull() & ~kind.startswith("ARRAY"), "states are no list")
    )


def quarantined(payloads: DataFrame, region: str, ingested_at: Column) -> DataFrame:
    """(path, reason, payload, payload_bytes, sha256, region, ingested_at) of the payloads that cannot be taken.

    The text is kept as it came, so that it can be looked at and delivered again.
    """
    path = F.col("path") if "path" in payloads.columns else F.lit(None).cast("string")
    return payloads.withColumn("reason", unreadable()).where("reason is not null").select(
        path.alias("path"),
        "reason",
        F.col("value").alias("payload"),
        F.octet_length("value").cast("bigint").alias("payload_bytes"),
        F.sha2("value", 256).alias("sha256"),
        F.lit(region).alias("region"),
        ingested_at.cast("timestamp").alias("ingested_at"),
    )


def readable(payloads: DataFrame) -> DataFrame:
    """The payloads that can be taken."""
    return payloads.where(unreadable().isNull())


def _item(position: int, kind: T.DataType) -> Column:
    """One item as ``kind``, null where it cannot be read as such.

    Text must be a number by itself (whole for integers); JSON numbers lose a fraction in an
    integer column, and JSON booleans count as 0 and 1.
    """
    token = F.get(F.col("vector"), F.lit(position))
    item, written_as = token.try_cast("string"), F.schema_of_variant(token)
    truth = F.when(written_as == "BOOLEAN", (item == "true").cast("int"))
    if isinstance(kind, T.StringType):
        return item
    if isinstance(kind, T.DoubleType):
        return F.coalesce(truth.cast("double"), parse_double(item))
    if isinstance(kind, T.BooleanType):
        return F.when(item.isNotNull(), ~F.lower(item).isin("false", "0", "0.0", ""))
    if isinstance(kind, T.ArrayType):
        listed = F.from_json(item, "array<int>")
        return F.filter(listed, lambda sensor: sensor.isNotNull())
    whole = F.when(item.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(item).try_cast("bigint"))
    cut = F.when(written_as != "STRING", item.try_cast("double").try_cast("bigint"))
    return F.coalesce(truth.cast("bigint"), whole, cut).try_cast(kind)


def decode_states(
    payloads: DataFrame, region: str, ingested_at: Column, source: str = "states/all"
) -> DataFrame:
    """Snapshot payloads ``{"time": …, "states": [[…], …] or null}`` to named, typed rows.

    Vectors shorter than the schema are completed with nulls, rows without an aircraft id
    are dropped, and an empty snapshot yields no row (see ``audit_snapshots``).
    """
    # The time leaves the payload before the list is unfolded: a row for each vector holds that vector alone, not
    # the whole payload again.
    listed = payloads.select(F.from_json("value", SNAPSHOT).alias("payload")).select(
        F.col("payload.time").alias("snapshot_ts"), F.col("payload.states").alias("vectors")
    )
    # Outer, since the rows it adds have no aircraft id and go with the others: an inner explode of a column lets the
    # optimizer infer a filter on its size, which repeats the whole making of the payload below every projection and
    # join, and whose variants by alias can take the driver's memory.
    vectors = listed.select("snapshot_ts", F.explode_outer("vectors").alias("vector"))
    rows = vectors.where(F.get("vector", F.lit(0)).try_cast("string").isNotNull()).select(
        *[_item(i, kind).alias(name) for i, (name, kind) in enumerate(STATE_VECTOR)],
        "snapshot_ts",
        ingested_at.cast("timestamp").alias("ingested_at"),
        F.lit(region).alias("region"),
        F.lit(source).alias("source"),
    )
    return rows.select(*[F.col(field.name) for field in STATES.fields])


def audit_snapshots(payloads: DataFrame, region: str, ingested_at: Column) -> DataFrame:
    """One audit row per payload, including the empty ones that leave no rows behind."""
    payload = F.from_json("value", RECEIVED)
    states = F.coalesce(payload["states"], F.array().cast("array<array<string>>"))
    path = F.col("path") if "path" in payloads.columns else F.lit(None).cast("string")
    return payloads.select(
        payload["time"].alias("snapshot_ts"),
        F.lit(region).alias("region"),
        F.size(states).cast("bigint").alias("received"),
        F.size(F.filter(states, lambda v: F.get(v, F.lit(0)).isNotNull()))
        .cast("bigint")
        .alias("rows"),
        F.octet_length("value").cast("bigint").alias("payload_bytes"),
        F.sha2("value", 256).alias("sha256"),
        ingested_at.cast("timestamp").alias("ingested_at"),
        path.alias("path"),
    )


# Hourly air quality -------------------------------------------------------------------


def flatten_hourly(
    payloads: DataFrame, ingested_at: Column, source: str = "air-quality"
) -> DataFrame:
    """Parallel hourly arrays to one row per airport and hour.

    ``payloads`` carries ``value`` and the airport's ``airport_icao, airport_iata, latitude,
    longitude``. Series shorter than the time axis, or missing, give nulls; times carry no
    zone and are UTC.
    """
    series = ["nitrogen_dioxide", "pm2_5", "pm10", "ozone"]
    hourly = F.from_json("value", HOURLY)["hourly"]
    parsed = payloads.select(
        "airport_icao", "airport_iata", "latitude", "longitude", hourly.alias("hourly")
    )
    rows = parsed.select(
        "airport_icao",
        "airport_iata",
        "latitude",
        "longitude",
        F.col("hourly"),
        F.posexplode("hourly.time").alias("position", "time"),
    ).select(
        "airport_icao",
        "airport_iata",
        "latitude",
        "longitude",
        F.try_to_timestamp("time").alias("measured_at"),
        *[F.get(F.col(f"hourly.{name}"), F.col("position")).alias(name) for name in series],
        ingested_at.cast("timestamp").alias("ingested_at"),
        F.lit(source).alias("source"),
    )
    return rows.select(*[F.col(field.name) for field in AIR_QUALITY.fields])


# Reference files ----------------------------------------------------------------------


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text. Empty fields are null, quotes follow RFC 4180."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Aircraft registry: the useful columns, without entries that say nothing."""
    return useful_registry(read_text_csv(spark, path))


def useful_registry(entries: DataFrame) -> DataFrame:
    """Entries with an address and at least a type, a manufacturer or an operator."""
    said = F.concat(
        *[F.coalesce(name, F.lit("")) for name in ("typecode", "manufacturername", "operator")]
    )
    return entries.select(*REGISTRY.names).where(
        (strip(F.coalesce("icao24", F.lit(""))) != "") & (said != "")
    )


def read_airlines(spark: SparkSession, path: str) -> DataFrame:
    r"""Airline file without a header; ``\N`` and empty fields, quoted or not, are null."""
    raw = spark.read.schema(AIRLINES).option("escape", '"').option("nullValue", "\\N").csv(path)
    return raw.select(*[F.nullif(F.col(name), F.lit("")).alias(name) for name in AIRLINES.names])


def audit_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of landed reference files."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            "path",
            F.col("length").alias("size_bytes"),
            F.sha2("content", 256).alias("sha256"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def audit_reference(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    """Audit row of one landed reference file: what was read from it, and its checksum."""
    rows = table.select(F.count(F.lit(1))).scalar()
    return audit_files(spark, path).withColumns(
        {"rows": rows, "columns": F.array(*[F.lit(name) for name in table.columns])}
    )
