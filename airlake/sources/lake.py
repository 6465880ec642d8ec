"""The raw lake: partitioned scans, replayable writes, retention and inventory.

Layout: ``states/ingest_date=YYYY-MM-DD/ingest_hour=H/snapshot=<ts>-<region>/part-*``. The leaf holds
one snapshot of one region, so writing it again replaces exactly its own files and needs
neither a read nor a merge of the others in that hour.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from airlake.sources.schemas import AIR_QUALITY, AIRLINES, AIRPORTS, LAKE_STATES, REGISTRY
from airlake.sources.tables import Folder, folder_name

REFERENCES = {
    "airports": AIRPORTS,
    "air_quality": AIR_QUALITY,
    "registry": REGISTRY,
    "airlines": AIRLINES,
}
DEFAULT_RETENTION_DAYS = 180
# Hours after which a landed reference should be fetched again.
REFRESH_HOURS = {"airports": 24, "air_quality": 6, "registry": 25 * 24, "airlines": 25 * 24}


def states_path(root: str) -> str:
    return f"{root.rstrip('/')}/states"


def scan_states(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots under the lake root, with their partition columns.

    The declared schema fills columns that older files lack with nulls. A lake with its files
    directly in the hour folders reads too; ``write_states`` of that scan into a new root
    moves it to one folder per snapshot (the two layouts cannot share a root).
    """
    return spark.read.schema(LAKE_STATES).parquet(states_path(root)).select(*LAKE_STATES.names)


def scan_hours(spark: SparkSession, root: str, hours: list[tuple[dt.date, int]]) -> DataFrame:
    """The raw rows of some hours: only their folders are listed and opened."""
    base = states_path(root)
    folder = Folder(spark, base)
    names = [folder_name(ingest_date=day, ingest_hour=hour) for day, hour in sorted(set(hours))]
    paths = [f"{base}/{name}" for name in names if folder.names(name)]
    if not paths:
        return spark.createDataFrame([], LAKE_STATES)
    return spark.read.schema(LAKE_STATES).option("basePath", base).parquet(*paths).select(*LAKE_STATES.names)


def hours_since(spark: SparkSession, root: str, seconds: int = 0) -> list[tuple[dt.date, int]]:
    """Hours of the lake that can hold snapshots after an instant, by folder names, the newest first.

    Older dates are not listed.
    """
    bound = dt.datetime.fromtimestamp(seconds, dt.timezone.utc)
    return [h for h in _newest_hours(spark, root, bound.date()) if h >= (bound.date(), bound.hour)]


def _newest_hours(spark: SparkSession, root: str, since_date: dt.date = dt.date.min):
    folder = Folder(spark, states_path(root))
    days = [n.split("=", 1)[1] for n in folder.names(folders=True) if n.startswith("ingest_date=")]
    for day in sorted((dt.date.fromisoformat(d) for d in days if d[:1].isdigit()), reverse=True):
        if day < since_date:
            return
        hours = [n.split("=", 1)[1] for n in folder.names(folder_name(ingest_date=day), True)]
        for hour in sorted((int(h) for h in hours if h.isdigit()), reverse=True):
            yield day, hour


def newest_states(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest hour that has files; the rest of the history is neither listed nor read."""
    folder = Folder(spark, states_path(root))
    for day, hour in _newest_hours(spark, root):
        if folder.names(folder_name(ingest_date=day, ingest_hour=hour)):
            return scan_hours(spark, root, [(day, hour)])
    return spark.createDataFrame([], LAKE_STATES)


def scan_reference(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(REFERENCES[name]).parquet(f"{root.rstrip('/')}/{name}")


def with_partitions(states: DataFrame) -> DataFrame:
    """Partition columns are a pure function of the snapshot time, in UTC."""
    moment = F.timestamp_seconds("snapshot_ts")
    return states.withColumn("ingest_date", moment.cast("date")).withColumn(
        "ingest_hour", F.hour(moment)
    )


def snapshot_name(seconds: int, region: str) -> str:
    """The leaf of one snapshot; the region by a hash, since its name may hold any character."""
    return f"{seconds}-{hashlib.md5(region.encode()).hexdigest()[:8]}"


def write_states(states: DataFrame, root: str) -> None:
    """Land snapshots; each one replaces an earlier version of itself, and no other region's.

    The rebalance puts a snapshot into few files and splits one that outgrows a task.
    """
    leaves = ["ingest_date", "ingest_hour", "snapshot"]
    region = F.substring(F.md5(F.coalesce("region", F.lit("")).cast("binary")), 1, 8)
    (
        with_partitions(states)
        .withColumn("snapshot", F.concat(F.col("snapshot_ts").cast("string"), F.lit("-"), region))
        .hint("rebalance", *leaves)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*leaves)
        .parquet(states_path(root))
    )


def write_reference(df: DataFrame, root: str, name: str) -> None:
    """Full refresh of a slowly changing reference."""
    (
        df.select(*REFERENCES[name].names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .parquet(f"{root.rstrip('/')}/{name}")
    )


def append_audit(audit: DataFrame, root: str, kind: str = "snapshots") -> None:
    audit.write.mode("append").parquet(f"{root.rstrip('/')}/_audit/{kind}")


def read_audit(spark: SparkSession, root: str, kind: str = "snapshots") -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/_audit/{kind}")


def open_quarantine(spark: SparkSession, root: str) -> DataFrame | None:
    """Payloads that could not be read and whose file was not delivered readably since; None before any delivery."""
    if not exists(spark, f"{root.rstrip('/')}/_audit/quarantine"):
        return None
    held = read_audit(spark, root, "quarantine")
    good = read_audit(spark, root).groupBy(F.col("path").alias("good_path")).agg(F.max("ingested_at").alias("good_at"))
    since = (F.col("path") == F.col("good_path")) & (F.col("good_at") > F.col("ingested_at"))
    return held.join(good, since, "left_anti")


def stale_references(spark: SparkSession, root: str, now: Column) -> DataFrame:
    """Age of every reference in the lake and whether it is due; a missing one is due."""
    parts = []
    for name, hours in REFRESH_HOURS.items():
        path = f"{root.rstrip('/')}/{name}"
        written = F.lit(None).cast("timestamp")
        if exists(spark, path):
            files = spark.read.schema(REFERENCES[name]).parquet(path)
            written = files.select(F.max("_metadata.file_modification_time")).scalar()
        age = (F.unix_micros(now) - F.unix_micros(written)) / F.lit(3.6e9)
        parts.append(
            spark.range(1).select(
                F.lit(name).alias("source_name"),
                age.alias("age_hours"),
                F.coalesce(age > hours, F.lit(True)).alias("is_due"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# Pruning ------------------------------------------------------------------------------


def since(seconds: int) -> Column:
    """Predicate for snapshots after an instant (epoch seconds) that also prunes partitions.

    The optimizer does not know that the partition date follows from the snapshot time, so
    the implied bounds on the date and, on the boundary day, the hour are spelled out.
    """
    bound = dt.datetime.fromtimestamp(seconds, dt.timezone.utc)
    day = F.lit(bound.date())
    return (
        (F.col("ingest_date") >= day)
        & ((F.col("ingest_date") > day) | (F.col("ingest_hour") >= bound.hour))
        & (F.col("snapshot_ts") > F.lit(seconds))
    )


# Retention ----------------------------------------------------------------------------


def retention_cutoff(today: dt.date, keep_days: int) -> dt.date | None:
    """First date that is kept; None when retention is off."""
    return today - dt.timedelta(days=keep_days) if keep_days > 0 else None


def retained(states: DataFrame, today: dt.date, keep_days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """The snapshots retention would leave in place."""
    cutoff = retention_cutoff(today, keep_days)
    return states if cutoff is None else states.where(F.col("ingest_date") >= F.lit(cutoff))


def prune_states(
    spark: SparkSession, root: str, today: dt.date, keep_days: int = DEFAULT_RETENTION_DAYS
) -> list[str]:
    """Delete whole date partitions older than the retention period; returns the dates.

    Only directory names are listed. Undated folders are left alone.
    """
    cutoff = retention_cutoff(today, keep_days)
    if cutoff is None:
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(states_path(root))
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    if files.exists(base):
        for status in files.listStatus(base):
            name = status.getPath().getName()
            if not name.startswith("ingest_date="):
                continue
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if day < cutoff and files.delete(status.getPath(), True):
                dropped.append(day.isoformat())
    return sorted(dropped)


def clear_snapshots(spark: SparkSession, root: str, snapshots: list[tuple[int, str]]) -> None:
    """Remove the rows of snapshots (time, region) that were delivered again without any."""
    leaves = []
    for seconds, region in snapshots:
        moment = dt.datetime.fromtimestamp(seconds, dt.timezone.utc)
        hour = folder_name(ingest_date=moment.date(), ingest_hour=moment.hour)
        leaves.append(f"{hour}/snapshot={snapshot_name(seconds, region)}")
    delete_folders(spark, states_path(root), leaves)


def delete_folders(spark: SparkSession, table: str, leaves: list[str]) -> None:
    """Delete partition folders of a table; missing ones are passed over."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for leaf in leaves:
        files.delete(hadoop.Path(f"{table}/{leaf}"), True)


# Inventory ----------------------------------------------------------------------------


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """(ingest_date, ingest_hour, snapshot_ts, files, total_bytes) of every snapshot, from a list of files.

    Spark lists the folders and the contents are not opened: one row per file, none per position.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(states_path(root))
    seconds = F.split(F.col("snapshot").cast("string"), "-")[0].cast("bigint")
    return files.groupBy("ingest_date", "ingest_hour", seconds.alias("snapshot_ts")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes")
    )


def lake_inventory(states: DataFrame) -> DataFrame:
    """Rows, number of snapshots, oldest and newest one."""
    per_snapshot = states.groupBy("snapshot_ts").agg(F.count(F.lit(1)).alias("rows"))
    return per_snapshot.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("snapshots"),
        F.timestamp_seconds(F.min("snapshot_ts")).alias("oldest"),
        F.timestamp_seconds(F.max("snapshot_ts")).alias("newest"),
    )


def partition_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("ingest_date", "ingest_hour").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("snapshot_ts").alias("snapshots")
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet dataset can be read there."""
    try:
        spark.read.schema(T.StructType([])).parquet(path)
    except AnalysisException:
        return False
    return True
