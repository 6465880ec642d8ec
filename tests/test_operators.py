from __future__ import annotations

import math
import random
import statistics

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from airlake.functions.geo import EARTH_RADIUS_KM
from airlake.operators.correlate import correlation_by, correlation_levels, demean
from airlake.operators.keys import join_on, top_k
from airlake.operators.median import grouped_median
from airlake.operators.pick import keep_first, keep_latest, most_frequent
from airlake.operators.proximity import cells_per_degree, nearest_within


# Picks --------------------------------------------------------------------------------


def test_keep_latest_takes_the_newest_version_whatever_the_row_order(spark, rows):
    data = [("a", 1, 10, "old"), ("a", 1, 30, "new"), ("a", 1, 20, None), ("b", 1, 5, None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, t int, seen int, note string")
        assert rows(keep_latest(df, ["k", "t"], "seen")) == [("a", 1, 30, "new"), ("b", 1, 5, None)]


def test_keep_latest_is_repeatable_on_ties_and_reduces_a_hot_key(spark, rows):
    df = spark.range(20000).select(
        F.lit("hot").alias("k"), F.lit(7).alias("seen"), (F.col("id") % 13).alias("v")
    )
    assert rows(keep_latest(df.repartition(8), ["k"], "seen")) == [("hot", 7, 12)]
    plan = keep_latest(df, ["k"], "seen")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_keep_latest_treats_null_keys_as_a_key(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 1)], "k string, seen int")
    assert rows(keep_latest(df, ["k"], "seen")) == [("x", 1), (None, 2)]


def test_keep_first_prefers_filled_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", None, "z"), ("a", "R2", "y"), ("a", "R1", "x"), ("b", None, "w")],
        "k string, reg string, v string",
    )
    picked = keep_first(df, ["k"], F.col("reg").isNull(), F.col("reg"))
    assert rows(picked) == [("a", "R1", "x"), ("b", None, "w")]


def test_most_frequent_breaks_ties_by_value_and_skips_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", "B"), ("a", "A"), ("a", None), ("a", None), ("a", None), ("b", None), ("c", "Z"), ("c", "Z")],
        "k string, v string",
    )
    assert rows(most_frequent(df, ["k"], "v")) == [("a", "A", 1), ("c", "Z", 2)]
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    assert rows(most_frequent(counted, ["k"], "v", weight="n")) == [("a", "A", 1), ("c", "Z", 2)]


# Median -------------------------------------------------------------------------------


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=40))
def test_median_matches_the_definition(spark, data):
    df = spark.createDataFrame([(k, None if v is None else v / 2) for k, v in data], "k string, v double")
    expected = {}
    for key in {k for k, _ in data}:
        values = [v / 2 for k, v in data if k == key and v is not None]
        if values:
            expected[key] = statistics.median(values)
    got = {r["k"]: r["median"] for r in grouped_median(df, ["k"], "v").collect()}
    assert got == expected


def test_median_without_keys_and_on_a_heavily_repeated_value(spark):
    df = spark.range(30001).select(F.when(F.col("id") < 20000, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    assert grouped_median(df, [], "v").first()["median"] == 5.0
    assert grouped_median(df.where("v > 100000"), [], "v").collect() in ([], [(None,)])


# Proximity ----------------------------------------------------------------------------


def km(lat_a, lon_a, lat_b, lon_b):
    half = (
        math.sin(math.radians(lat_b - lat_a) / 2) ** 2
        + math.cos(math.radians(lat_a)) * math.cos(math.radians(lat_b))
        * math.sin(math.radians(lon_b - lon_a) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(half)))


def brute_force(positions, places, radius, wrap=False):
    """Every pair, limited to neighbouring one-degree cells unless wrapping."""
    found = {}
    for key, lat, lon in positions:
        best = None
        for place, p_lat, p_lon in places:
            near = abs(math.floor(lat) - math.floor(p_lat)) <= 1 and abs(
                math.floor(lon) - math.floor(p_lon)) <= 1
            distance = km(lat, lon, p_lat, p_lon)
            if distance <= radius and (wrap or near) and (best is None or (distance, place) < best):
                best = (distance, place)
        if best:
            found[key] = best
    return found


def frames(spark, positions, places):
    return (
        spark.createDataFrame(positions, "pos int, latitude double, longitude double"),
        spark.createDataFrame(places, "place int, latitude double, longitude double"),
    )


@pytest.mark.parametrize("radius", [3.0, 8.0, 60.0, 150.0])
@pytest.mark.parametrize(
    ("south", "north", "west", "east"),
    [(40, 42.5, -2, 2), (-1.2, 1.2, -1.2, 1.2), (78, 80, 10, 14), (88.5, 90, -180, 180), (-60, -58, 178, 180)],
)
@pytest.mark.parametrize("wrap", [False, True])
def test_nearest_equals_brute_force(spark, radius, south, north, west, east, wrap):
    rng = random.Random(f"{radius}{south}{wrap}")
    point = lambda: (rng.uniform(south, north), rng.uniform(west, east))
    positions = [(i, *point()) for i in range(150)]
    places = [(i, *point()) for i in range(40)]
    # Places on cell borders, and positions right beside them on either side.
    places += [(100, math.floor(south) + 1.0, math.floor(west) + 1.0)]
    positions += [(500 + i, places[-1][1] + d, places[-1][2] - d) for i, d in enumerate((-0.01, 0.0, 0.01))]
    df = nearest_within(*frames(spark, positions, places), radius, place_id="place", wrap=wrap)
    got = {r["pos"]: (r["distance_km"], r["place"]) for r in df.collect()}
    expected = brute_force(positions, places, radius, wrap)
    assert got.keys() == expected.keys()
    for key, (distance, place) in expected.items():
        assert got[key][1] == place and got[key][0] == pytest.approx(distance, abs=1e-6)


def test_wrap_matches_across_the_180th_meridian(spark):
    positions, places = [(1, 0.0, -179.99)], [(7, 0.0, 179.99)]
    clipped = nearest_within(*frames(spark, positions, places), 8.0, place_id="place", wrap=False)
    assert clipped.count() == 0
    wrapped = nearest_within(*frames(spark, positions, places), 8.0, place_id="place")
    assert wrapped.first()["place"] == 7


def test_places_at_one_spot_give_the_smallest_id(spark):
    positions, places = [(1, 48.0, 2.0)], [(9, 48.01, 2.0), (4, 48.01, 2.0), (5, 48.03, 2.0)]
    assert nearest_within(*frames(spark, positions, places), 8.0, place_id="place").first()["place"] == 4


@pytest.fixture
def hot_cell(spark, tmp_path):
    """A third of all positions beside one place, and a written table of places."""
    positions = spark.range(30000).selectExpr(
        "id",
        "if(id % 3 = 0, 45.0D, 41 + (id * 7919) % 10000 / 1000.0D) as latitude",
        "if(id % 3 = 0, 2.0D, -5 + (id * 104729) % 15000 / 1000.0D) as longitude",
    )
    places = spark.range(2000).selectExpr(
        "cast(id as int) as place",
        "41 + (id * 617) % 10000 / 1000.0D as latitude",
        "-5 + (id * 911) % 15000 / 1000.0D as longitude",
    )
    places = places.union(spark.createDataFrame([(5000, 45.01, 2.0)], places.schema))
    positions.write.parquet(str(tmp_path / "positions"))
    places.write.parquet(str(tmp_path / "places"))
    return spark.read.parquet(str(tmp_path / "positions")), spark.read.parquet(str(tmp_path / "places"))


def test_a_hot_cell_gives_the_same_rows_broadcast_or_shuffled(spark, hot_cell, rows):
    positions, places = hot_cell

    def matched():
        return nearest_within(positions, places, 8.0, place_id="place").select("id", "place")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    broadcast = matched()
    text = plan(broadcast)
    side = text[: text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in side and "Exchange hashpartitioning" not in side
    expected = rows(broadcast)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        shuffled = matched()
        assert "SortMergeJoin" in plan(shuffled) and "Broadcast" not in plan(shuffled)
        assert rows(shuffled) == expected and len(expected) > 10000
    finally:
        for key in changed:
            spark.conf.unset(key)


def test_cells_are_about_as_wide_as_the_radius():
    assert cells_per_degree(8.0) == 13 and cells_per_degree(500.0) == 1


# Correlation --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def panel():
    rng = random.Random(3)
    return [
        (rng.choice(["A", "B", "C", None]), h % 4, rng.randrange(30), None if rng.random() < 0.1 else rng.uniform(0, 60))
        for h in range(400)
    ]


def test_correlation_levels_match_demeaned_residuals(spark, panel):
    df = spark.createDataFrame(panel, "k string, h int, x int, y double")
    got = correlation_levels(df, "x", "y", {"plain": [], "within": ["k"], "resid": ["k", "h"]}).first()
    def within(*by):
        """Pooled sums of squares around group means; rows with a null key are in no group."""
        groups = {}
        for k, h, x, y in panel:
            key = tuple({"k": k, "h": h}[name] for name in by)
            if y is not None and None not in key:
                groups.setdefault(key, []).append((x, y))
        xy = xx = yy = 0.0
        for points in groups.values():
            x_mean = math.fsum(x for x, _ in points) / len(points)
            y_mean = math.fsum(y for _, y in points) / len(points)
            for x, y in points:
                xy += (x - x_mean) * (y - y_mean)
                xx += (x - x_mean) ** 2
                yy += (y - y_mean) ** 2
        return xy / math.sqrt(xx * yy)

    assert got["n"] == sum(y is not None for *_, y in panel)
    assert got["plain"] == pytest.approx(within(), abs=1e-9)
    assert got["within"] == pytest.approx(within("k"), abs=1e-9)
    assert got["resid"] == pytest.approx(within("k", "h"), abs=1e-9)


def test_correlation_of_a_constant_series_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (1, 4.0)], "x int, y double")
    assert correlation_levels(df, "x", "y", {"r": []}).first().asDict() == {"n": 3, "r": None}
    empty = correlation_levels(df.where("false"), "x", "y", {"r": []}).first()
    assert empty.asDict() == {"n": 0, "r": None}


def test_correlation_by_needs_enough_rows(spark, panel):
    df = spark.createDataFrame(panel, "k string, h int, x int, y double")
    small = spark.createDataFrame([("D", 0, 1, 1.0), ("D", 0, 2, 2.0)], df.schema)
    got = {r["k"]: r["r"] for r in correlation_by(df.union(small), "x", "y", ["k"], 10).collect()}
    assert set(got) == {"A", "B", "C", None}
    sub = pd.DataFrame(panel, columns=["k", "h", "x", "y"])
    sub = sub[(sub.k == "A") & sub.y.notna()]
    assert got["A"] == pytest.approx(sub.x.corr(sub.y), abs=1e-9)


def test_demeaned_groups_sum_to_zero_and_null_is_a_group(spark, panel):
    df = spark.createDataFrame(panel, "k string, h int, x int, y double")
    sums = demean(df, "x", ["k"], "d").groupBy("k").agg(F.sum("d").alias("s"), F.count("d").alias("n"))
    collected = sums.collect()
    assert len(collected) == 4
    assert all(abs(r["s"]) < 1e-9 and r["n"] > 0 for r in collected)


# Keys ---------------------------------------------------------------------------------


def test_join_on_matches_null_with_null_even_on_a_derived_side(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 4)], "k string, v int")
    means = df.groupBy("k").agg(F.avg("v").alias("m"))
    assert rows(join_on(df, means, ["k"])) == [("a", 1, 1.0), (None, 2, 3.0), (None, 4, 3.0)]


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", None)], "k string, n int")
    assert [r["k"] for r in top_k(df, 3, "n", "k").collect()] == ["c", "a", "b"]
