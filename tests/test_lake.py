from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airlake.plans.contracts import latest_snapshot_rows
from airlake.sources import lake, landing
from airlake.sources.schemas import LAKE_STATES, STATES

T = 1786968000  # 2026-08-17 12:00 UTC


def snapshot(spark, ts, count=1, **values):
    """A raw snapshot of ``count`` aircraft."""
    df = spark.range(count).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("icao24"),
        F.lit(ts).cast("bigint").alias("snapshot_ts"),
        F.lit(48.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        F.lit(dt.datetime(2026, 8, 17)).alias("ingested_at"),
        F.lit("france").alias("region"),
        F.lit("test").alias("source"),
        *[F.lit(value).alias(name) for name, value in values.items()],
    )
    kinds = {f.name: f.dataType for f in STATES.fields}
    return df.select(
        *[
            (F.col(n) if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n)
            for n in STATES.names
        ]
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def files(root):
    return sorted(glob.glob(f"{root}/states/**/*.parquet", recursive=True))


def test_layout_follows_the_snapshot_time_in_utc(spark, root):
    lake.write_states(snapshot(spark, T), root)
    (path,) = files(root)
    assert "/ingest_date=2026-08-17/ingest_hour=12/" in path
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"
    df = lake.scan_states(spark, root)
    assert df.columns == LAKE_STATES.names
    assert dict(df.dtypes)["ingest_date"] == "date" and dict(df.dtypes)["ingest_hour"] == "int"


def test_replaying_a_snapshot_replaces_only_itself(spark, root, rows):
    lake.write_states(snapshot(spark, T, 5), root)
    lake.write_states(snapshot(spark, T + 900, 3), root)
    lake.write_states(snapshot(spark, T, 2, callsign="NEW"), root)
    counted = lake.scan_states(spark, root).groupBy("snapshot_ts").count()
    assert rows(counted) == [(T, 2), (T + 900, 3)]
    assert len(files(root)) == 2


def test_all_null_columns_keep_their_type(spark, root):
    lake.write_states(snapshot(spark, T), root)
    lake.write_states(snapshot(spark, T + 900, squawk="7700"), root)
    df = lake.scan_states(spark, root)
    assert dict(df.dtypes)["squawk"] == "string"
    assert sorted(str(r["squawk"]) for r in df.collect()) == ["7700", "None"]


def test_older_files_may_lack_columns(spark, root):
    narrow = lake.with_partitions(snapshot(spark, T)).drop("category", "sensors")
    leaves = ["ingest_date", "ingest_hour", "snapshot"]
    narrow.withColumn("snapshot", F.lit(T)).write.partitionBy(*leaves).parquet(lake.states_path(root))
    lake.write_states(snapshot(spark, T + 3600, category=3), root)
    got = lake.scan_states(spark, root).select("category").collect()
    assert sorted(str(r["category"]) for r in got) == ["3", "None"]


def test_flat_hour_folders_can_be_scanned_and_moved_to_snapshot_folders(spark, root, rows):
    flat = lake.with_partitions(snapshot(spark, T, 4))
    flat.write.partitionBy("ingest_date", "ingest_hour").parquet(lake.states_path(root))
    assert lake.scan_states(spark, root).count() == 4
    lake.write_states(lake.scan_states(spark, root), root + "-moved")
    assert rows(lake.scan_states(spark, root + "-moved")) == rows(lake.scan_states(spark, root))


def test_retention_drops_whole_dates(spark, root):
    for day in range(4):
        lake.write_states(snapshot(spark, T + day * 86400), root)
    today = dt.date(2026, 8, 20)
    assert lake.retained(lake.scan_states(spark, root), today, 1).count() == 2
    assert lake.prune_states(spark, root, today, 0) == []
    assert lake.prune_states(spark, root, today) == []
    assert lake.prune_states(spark, root, today, 1) == ["2026-08-17", "2026-08-18"]
    left = spark.read.parquet(lake.states_path(root)).select("ingest_date").distinct().collect()
    assert sorted(str(r[0]) for r in left) == ["2026-08-19", "2026-08-20"]
    assert lake.prune_states(spark, root + "-none", today, 1) == []


def test_bound_prunes_partitions(spark, root):
    for hour in range(-2, 3):
        lake.write_states(snapshot(spark, T + hour * 3600), root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    newer = lake.scan_states(spark, root).where(lake.since(T))
    assert sorted(r["snapshot_ts"] - T for r in newer.collect()) == [3600, 7200]
    plan = newer._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "ingest_date" in filters and "ingest_hour" in filters
    assert "GreaterThan(snapshot_ts" in plan


def test_inventory(spark, root):
    lake.write_states(snapshot(spark, T, 2), root)
    lake.write_states(snapshot(spark, T + 900, 3), root)
    states = lake.scan_states(spark, root)
    row = lake.lake_inventory(states.withColumn("seconds", F.lit(0))).selectExpr(
        "rows", "snapshots", "unix_seconds(oldest) as oldest", "unix_seconds(newest) as newest"
    )
    assert tuple(row.first()) == (5, 2, T, T + 900)
    listed = lake.lake_files(spark, root).collect()
    assert sorted((r["snapshot_ts"], r["files"]) for r in listed) == [(T, 1), (T + 900, 1)]
    assert sum(r["total_bytes"] for r in listed) == sum(os.path.getsize(f) for f in files(root))


def test_regions_at_one_instant_do_not_replace_each_other(spark, root, rows):
    for region, count in (("france", 4), ("Île d'Yeu/=é", 2), ("france", 3), ("Île d'Yeu/=é", 1)):
        lake.write_states(snapshot(spark, T, count).withColumn("region", F.lit(region)), root)
    states = lake.scan_states(spark, root)
    assert rows(states.groupBy("region").count()) == [("Île d'Yeu/=é", 1), ("france", 3)]
    lake.clear_snapshots(spark, root, [(T, "Île d'Yeu/=é")])
    assert rows(lake.scan_states(spark, root).groupBy("region").count()) == [("france", 3)]


def test_empty_snapshot_is_known_to_the_audit(spark, root):
    lake.write_states(snapshot(spark, T, 2), root)
    payloads = spark.createDataFrame([(f'{{"time": {T + 900}, "states": null}}',)], "value string")
    lake.append_audit(landing.audit_snapshots(payloads, "france", F.current_timestamp()), root)
    lake.write_states(landing.decode_states(payloads, "france", F.current_timestamp()), root)
    states = lake.scan_states(spark, root)
    assert latest_snapshot_rows(states).first().asDict() == {
        "snapshot_ts": T, "rows": 2, "snapshots": 1, "passed": True,
    }
    checked = latest_snapshot_rows(states, lake.read_audit(spark, root)).first()
    assert checked["snapshot_ts"] == T + 900 and checked["rows"] == 0 and not checked["passed"]


def test_references_are_fully_refreshed(spark, root):
    airlines = spark.createDataFrame([("1", "A", None, None, "AAA", None, None, "Y")], lake.AIRLINES)
    lake.write_reference(airlines, root, "airlines")
    lake.write_reference(airlines.withColumn("name", F.lit("B")), root, "airlines")
    got = lake.scan_reference(spark, root, "airlines").collect()
    assert [r["name"] for r in got] == ["B"]


def test_missing_and_old_references_are_due(spark, root):
    airlines = spark.createDataFrame([("1", "A", None, None, "AAA", None, None, "Y")], lake.AIRLINES)
    lake.write_reference(airlines, root, "airlines")
    soon = F.current_timestamp() + F.expr("interval 1 hour")
    due = {r["source_name"]: r["is_due"] for r in lake.stale_references(spark, root, soon).collect()}
    assert due == {"airports": True, "air_quality": True, "registry": True, "airlines": False}
    later = F.current_timestamp() + F.expr("interval 26 days")
    old = lake.stale_references(spark, root, later).where("source_name = 'airlines'").first()
    assert old["is_due"] and old["age_hours"] > 25 * 24
