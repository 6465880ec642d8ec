"""Session settings the engine relies on.

Hour buckets, partition dates and day-of-week values are computed in the session
time zone, so UTC is part of the data model and not a display choice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A replayed partition replaces itself and leaves its neighbours alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # Stream state (a week of keys) on disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM never compiles methods above 8000 bytes of bytecode; wide cleaning projections
    # are faster as several compiled operators than as one interpreted stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Only settable when the session is created.
STATIC_SETTINGS = {
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Recording a Python stack trace per column expression slows plan building noticeably.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "airlake", master: str | None = None, **settings) -> SparkSession:
    """Create (or fetch) a session carrying the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **STATIC_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one in the warehouse folder.

    The warehouse folder is always set and is where the session keeps its tables.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/airlake-shared"
    return folder.rstrip("/")
