"""Wall time of the engine's queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads.
The JVM is warmed on the smallest tables first. ``build_all`` is a full refresh of every
table from the raw ones; queries over written tables then read that build.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airlake.plans.warehouse import WAVES  # noqa: E402
from airlake.session import build_session  # noqa: E402
from checks import registry  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Queries that land or rebuild a whole lake or warehouse of their own first: their time is that of the set-up,
# which build_all, land_lake, append_new and upsert_replay measure.
SET_UP = {
    "landed_states", "empty_snapshots", "latest_nonempty", "regions_landed", "facts_after_prune", "gate_blocks",
    "evolved_facts", "stream_late", "near_after_upsert", "traffic_after_upsert", "activity_after_upsert",
    "panel_after_upsert", "aircraft_after_upsert",
}
WARM_FOLDER = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def build_all(spark, folder: str) -> None:
    w = registry.warehouse(spark, folder)
    for wave in WAVES:
        w.build_all(wave)
    w.vacuum(keep=1)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            # Throughput collector, and room for the code of some hundred generated stages.
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC -XX:ReservedCodeCacheSize=512m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: query for name, query in registry.QUERIES.items() if name not in SET_UP}
    if os.path.isdir(WARM_FOLDER):
        build_all(spark, WARM_FOLDER)
        run(registry.entry(spark, WARM_FOLDER))
        for query in queries.values():
            run(query(spark, WARM_FOLDER))
    times = {"build_all": timed(lambda: build_all(spark, FOLDER))}
    times["land_lake"] = timed(lambda: registry.lake_root(spark, FOLDER))
    times["hourly_from_raw"] = timed(lambda: run(registry.entry(spark, FOLDER)))
    for name, query in queries.items():
        times[name] = timed(lambda: run(query(spark, FOLDER)))
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
