"""The lake as a stream of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from airlake.plans.positions import GRAIN
from airlake.plans.warehouse import HOUR, Warehouse
from airlake.sources.lake import states_path
from airlake.sources.schemas import LAKE_STATES
from airlake.sources.tables import CommittedTable, folder_name
from airlake.streaming.incremental import rebuild_partitions, refresh_touched

CADENCE = "15 minutes"
# Versions of a table that a stream leaves behind; readers of older ones have had many batches to finish.
KEEP_VERSIONS = 20


def stream_states(
    spark: SparkSession, lake_root: str, max_files: int | None = None
) -> DataFrame:
    """New files of the lake, optionally at most ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(LAKE_STATES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(states_path(lake_root))


def stream_deduplicated(staged: DataFrame, delay: str) -> DataFrame:
    """Drop repeats of (aircraft, instant) arriving within ``delay``.

    State is bounded by the watermark. The first version is kept; where the latest must win,
    use ``start_upsert``.
    """
    return staged.withWatermark("snapshot_at", delay).dropDuplicatesWithinWatermark(GRAIN)


def hourly_counts(deduplicated: DataFrame) -> DataFrame:
    """Positions per hour and region; exact, because repeats are gone."""
    return (
        deduplicated.groupBy(F.window("snapshot_at", "1 hour"), "ingestion_region")
        .agg(F.count(F.lit(1)).alias("position_count"))
        .select(F.col("window.start").alias("traffic_hour"), "ingestion_region", "position_count")
    )


def _trigger(writer, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=CADENCE)


def start_upsert(
    spark: SparkSession,
    lake_root: str,
    facts_path: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    available_now: bool = True,
    late: LateRows | None = None,
) -> StreamingQuery:
    """Keep the facts current: each micro-batch rebuilds the hours its files belong to.

    A retried batch rebuilds the same hours again, with the same result. Rows that come late are in them; ``late``
    also records them.
    """

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        if late is not None:
            late.record(batch, batch_id)
        rebuild_partitions(batch.sparkSession, lake_root, facts_path, batch.select(*HOUR))
        table = CommittedTable(batch.sparkSession, facts_path)
        table.vacuum(KEEP_VERSIONS)

    writer = stream_states(spark, lake_root, max_files).writeStream.foreachBatch(rebuild)
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()


def start_refresh(
    warehouse: Warehouse,
    lake_root: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    available_now: bool = True,
    rollups: bool = False,
) -> StreamingQuery:
    """Keep the facts and every hourly table behind them current, hour by hour.

    Tables over the whole history are left to the next build unless ``rollups`` is set.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        refresh_touched(warehouse, lake_root, batch.select(*HOUR), rollups)
        warehouse.vacuum(KEEP_VERSIONS)

    writer = stream_states(warehouse.spark, lake_root, max_files).writeStream.foreachBatch(refresh)
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()


class LateRows:
    """What came later than a watermark allows: a stream with one would drop these rows silently.

    The mark of a batch is the newest snapshot of the batches before it, less the delay, as a watermark's
    is. Counts of earlier batches are folded into one row per hour and region, so the table does not grow with the
    batches; the last batch's stay apart, so that a retry counts against the same mark and replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, delay_seconds: int):
        self.table = CommittedTable(spark, path)
        self.delay = delay_seconds

    def record(self, batch: DataFrame, batch_id: int) -> None:
        spark, earlier, seen = batch.sparkSession, None, None
        if self.table.exists():
            earlier = self.table.read().where(F.col("batch") < batch_id)
            seen = earlier.agg(F.max("newest")).first()[0]
        # One number per batch reaches the driver.
        newest = batch.agg(F.max("snapshot_ts")).first()[0]
        is_late = F.lit(False) if seen is None else F.col("snapshot_ts") < seen - self.delay
        hour = F.timestamp_seconds(F.floor(F.col("snapshot_ts") / 3600) * 3600)
        late = batch.where(is_late).groupBy(hour.alias("traffic_hour"), F.col("region").alias("ingestion_region"))
        # A row without an hour holds the mark of a batch that had nothing late.
        mark = spark.range(1).select(
            F.lit(None).cast("timestamp").alias("traffic_hour"), F.lit(None).cast("string").alias("ingestion_region"),
            F.lit(0).cast("long").alias("rows"),
        )
        reached = max((t for t in (seen, newest) if t is not None), default=None)
        rows = late.agg(F.count(F.lit(1)).alias("rows")).union(mark).withColumns(
            {"newest": F.lit(reached).cast("long"), "batch": F.lit(batch_id).cast("long")}
        )
        if earlier is not None:
            folded = earlier.groupBy("traffic_hour", "ingestion_region").agg(
                F.sum("rows").alias("rows"), F.max("newest").alias("newest"), F.lit(-1).cast("long").alias("batch")
            )
            rows = rows.unionByName(folded)
        self.table.write(rows)
        self.table.vacuum(KEEP_VERSIONS)

    def rows(self) -> DataFrame:
        """(traffic_hour, ingestion_region, rows) of what came late."""
        late = self.table.read().where(F.col("traffic_hour").isNotNull())
        return late.groupBy("traffic_hour", "ingestion_region").agg(F.sum("rows").alias("rows"))


def start_hourly_counts(
    counts: DataFrame, path: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Keep hourly counts: each micro-batch replaces the days that it changes.

    A day's present counts are overlaid with the batch's, so a retry gives the same. Replaced files are deleted
    two versions later: the number of folders follows the days, not the batches.
    """
    spark = counts.sparkSession
    keys = ["traffic_hour", "ingestion_region"]

    def keep(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(spark, path)
        fresh = batch.withColumn("day", F.to_date("traffic_hour"))
        if table.exists():
            days = [r["day"] for r in fresh.select("day").distinct().collect()]  # one per day of the batch
            held = table.read(folders=[folder_name(day=day) for day in days])
            same = [held[k].eqNullSafe(fresh[k]) for k in keys]
            fresh = fresh.unionByName(held.join(fresh, same[0] & same[1], "left_anti"))
        table.write(fresh, ["day"], keep_rest=True)
        table.vacuum(KEEP_VERSIONS)

    writer = counts.writeStream.outputMode("update").foreachBatch(keep)
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now).start()


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each hour and region."""
    return CommittedTable(spark, path).read().drop("day")
