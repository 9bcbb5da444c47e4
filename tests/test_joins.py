from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.views import telemetry
from perigee.fixed_values import REGIONS
from perigee.operators import joins
from perigee.session import fresh_folder
from tests.conftest import SF_SMALL, at, final_plan, plan, rows

T0, T1 = at("2024-01-01 00:00:00"), at("2024-01-01 00:05:00")


def two_sides(spark, left, right):
    return (
        spark.createDataFrame(left, "region_id string, timestamp timestamp, coverage_percentage double"),
        spark.createDataFrame(right, "region string, timestamp timestamp, latency_ms double"),
    )


def test_full_outer(spark):
    c, p = two_sides(
        spark,
        [("EU", T0, 1.0), ("EU", T1, 2.0), (None, T0, 3.0), ("NA", None, 4.0)],
        [("EU", T0, 10.0), ("NA", T0, 20.0), (None, T0, 30.0), (None, None, 40.0)],
    )
    joined = joins.join_coverage_performance(c, p)
    assert joined.columns == ["region", "timestamp", "coverage_percentage", "latency_ms"]
    assert rows(joined) == sorted(
        [
            ("EU", T0, 1.0, 10.0), ("EU", T1, 2.0, None), (None, T0, 3.0, None), ("NA", None, 4.0, None),
            ("NA", T0, None, 20.0), (None, T0, None, 30.0), (None, None, None, 40.0),
        ],
        key=repr,
    )


def test_full_outer_repeated_keys_equal_spark_full_outer(spark):
    left = [(f"R{i % 3}", T0 if i % 2 else T1, float(i)) for i in range(12)] + [(None, None, 1.0)] * 3
    right = [(f"R{i % 4}", T0 if i % 5 else T1, float(-i)) for i in range(12)] + [(None, T0, 1.0)] * 2
    c, p = two_sides(spark, left, right)
    plain = joins.align_region(c).join(p, ["region", "timestamp"], "full_outer")
    assert rows(joins.join_coverage_performance(c, p)) == rows(plain)


@pytest.mark.parametrize("empty", ["left", "right", "both"])
def test_full_outer_with_an_empty_side(spark, empty):
    c, p = two_sides(spark, [("EU", T0, 1.0)], [("NA", T0, 2.0)])
    c = c.limit(0) if empty in ("left", "both") else c
    p = p.limit(0) if empty in ("right", "both") else p
    assert joins.join_coverage_performance(c, p).count() == (0 if empty == "both" else 1)


def test_full_outer_refuses_ambiguous_columns(spark):
    c, p = two_sides(spark, [("EU", T0, 1.0)], [("EU", T0, 2.0)])
    with pytest.raises(ValueError, match="event_id"):
        joins.join_coverage_performance(c.withColumn("event_id", F.lit(1)), p.withColumn("event_id", F.lit(1)))


def stored_sides(spark, hot_side):
    """Two stored inputs, one of which has a third of its rows under one key."""
    ids = spark.range(0, 30_000, 1, 6)
    spread = F.lit(T0) + F.make_dt_interval(secs=F.col("id"))

    def side(region, name, hot):
        key = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit(T0)).otherwise(spread)
        return ids.select(F.lit("EU").alias(region), key.alias("timestamp"), F.rand(1).alias(name))

    folder = fresh_folder(spark, "sides")
    side("region_id", "coverage_percentage", hot_side == "left").write.parquet(f"{folder}/c")
    side("region", "latency_ms", hot_side == "right").where("id % 2 = 0 OR id % 3 = 0").write.parquet(f"{folder}/p")
    return spark.read.parquet(f"{folder}/c"), spark.read.parquet(f"{folder}/p")


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_key_is_split(spark, settings, hot_side):
    settings(
        autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="30k",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="20k",
    )
    c, p = stored_sides(spark, hot_side)
    joined = joins.join_coverage_performance(c, p)
    got = final_plan(joined)
    kinds = re.findall(r"SortMergeJoin(\(skew=true\))? .*?, (Inner|LeftOuter|FullOuter)", got)
    assert [kind for _, kind in kinds] == ["Inner", "LeftOuter", "LeftOuter"]
    split = [bool(mark) for mark, _ in kinds]
    assert split == ([True, True, False] if hot_side == "left" else [True, False, True])
    assert "BroadcastNestedLoop" not in got and "CartesianProduct" not in got
    plain = joins.align_region(c).join(p, ["region", "timestamp"], "full_outer")
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain).count() == 0


def test_building_the_join_runs_nothing(spark, settings):
    c, p = stored_sides(spark, "left")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    joins.join_coverage_performance(c, p)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("", "")


def test_many_null_keys_stay_out_of_the_joins(spark, settings):
    settings(autoBroadcastJoinThreshold=-1)
    c, p = stored_sides(spark, "left")
    c = c.withColumn("timestamp", F.expr("CASE WHEN timestamp != TIMESTAMP'2024-01-01' THEN timestamp END"))
    joined = joins.join_coverage_performance(c, p)
    plain = joins.align_region(c).join(p, ["region", "timestamp"], "full_outer")
    assert joined.count() == plain.count() and joined.exceptAll(plain).count() == 0
    filters = re.findall(r"Filter \(?isnotnull\(region#\d+\) AND isnotnull\(", plan(joined)) + re.findall(r"isnotnull\(timestamp", plan(joined))
    assert filters


def test_dashboard_view_reuses_the_partitioning_of_the_rollups(spark, settings):
    from checks.catalog import typed_stats
    from perigee.model import COVERAGE_STATS, PERFORMANCE_STATS

    settings(autoBroadcastJoinThreshold=-1)
    view = joins.dashboard_view(
        typed_stats(spark, SF_SMALL, COVERAGE_STATS)[0], typed_stats(spark, SF_SMALL, PERFORMANCE_STATS)[0]
    )
    got = plan(view)
    shuffles = re.findall(r"Exchange hashpartitioning\(region\w*#\d+, time_window_start", got)
    assert len(shuffles) == 2  # the two rollups; none for the join itself


def brute_force_coverage(positions, regions):
    result = {}
    for tick in {p[0] for p in positions}:
        for region_id, name, lat0, lon0 in regions:
            n = sum(
                1 for t, lat, lon in positions
                if t == tick and lat is not None and lon is not None
                and math.sqrt((lat - lat0) ** 2 + (lon - lon0) ** 2) * 111 < 2000
            )
            pct = round(min(100, n / 10 * 100), 2)
            result[region_id, tick] = (name, pct, n)
    return result


def test_region_coverage_against_brute_force(spark):
    positions = [(t, float(lat), float(lon)) for t in (T0, T1) for lat in range(-90, 91, 6) for lon in range(-180, 181, 9)]
    positions += [(at("2024-01-01 09:00:00"), -80.0, 0.0), (T0, None, 10.0), (T0, float("nan"), 10.0)]
    df = spark.createDataFrame(positions, "timestamp timestamp, latitude double, longitude double")
    got = {
        (r.region_id, r.timestamp): (r.region_name, r.coverage_percentage, r.satellite_count)
        for r in joins.region_coverage_from_positions(df).collect()
    }
    assert got == brute_force_coverage(positions, REGIONS)
    assert got["EU", at("2024-01-01 09:00:00")] == ("Europe", 0.0, 0)


def test_region_coverage_of_a_table_of_many_regions(spark):
    regions = [(f"r{i}", f"Region {i}", (i * 37) % 181 - 90.0, (i * 101) % 361 - 180.0) for i in range(2000)]
    positions = [(T0, float((i * 53) % 181 - 90), float((i * 29) % 361 - 180)) for i in range(40)] + [(T1, None, 1.0)]
    df = spark.createDataFrame(positions, "timestamp timestamp, latitude double, longitude double")
    table = spark.createDataFrame(regions, "region_id string, region_name string, latitude double, longitude double")
    got = joins.region_coverage_from_positions(df, table)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    found = {(r.region_id, r.timestamp): (r.region_name, r.coverage_percentage, r.satellite_count) for r in got.collect()}
    assert found == brute_force_coverage(positions, regions)


def crowded(number, seed=5):
    """Regions in one area, thousands of them in one place, and some elsewhere; positions near the edge of their range too."""
    r = np.random.default_rng(seed)
    lat, lon = 40 + r.random(number), 5 + r.random(number)
    lat[: number // 20], lon[: number // 20] = 40.25, 5.75
    lat[-50:], lon[-50:] = r.uniform(-90, 90, 50), r.uniform(-180, 180, 50)
    angle, reach = r.uniform(0, 2 * np.pi, 60), r.choice([3.0, 17.0, 17.9, 18.02, 18.4, 25.0], 60)
    at_lat, at_lon = 40.5 + reach * np.sin(angle), 5.5 + reach * np.cos(angle)
    exact = 2000.0 / 111.0
    at_lat, at_lon = np.append(at_lat, [40.25, 40.25, 40.25]), np.append(at_lon, [5.75 + exact, np.nextafter(5.75 + exact, 0), 5.75])
    return lat, lon, at_lat, at_lon


def test_regions_crowded_in_one_area_are_not_all_compared(spark):
    number = 100_000
    lat, lon, at_lat, at_lon = crowded(number)
    regions = spark.createDataFrame(pd.DataFrame({"region_id": [f"r{k}" for k in range(number)], "region_name": "r", "latitude": lat, "longitude": lon}))
    positions = spark.createDataFrame(pd.DataFrame({"latitude": at_lat, "longitude": at_lon})).withColumn("timestamp", F.lit(T0))
    got = {r.region_id: r.satellite_count for r in joins.region_coverage_from_positions(positions, regions).collect()}
    dlat, dlon = at_lat[:, None] - lat, at_lon[:, None] - lon
    wanted = (np.sqrt(dlat * dlat + dlon * dlon) * 111.0 < 2000.0).sum(axis=0)
    assert len(got) == number and all(got[f"r{k}"] == n for k, n in enumerate(wanted.tolist()))
    width = 2000.0 / 111.0
    cells = joins.region_cells(regions, width)
    seen = positions.select(F.monotonically_increasing_id().alias("p"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    reached = joins.positions_in_cells(seen, cells, width)
    single = reached.where("_state = 'some'").join(cells.members, "cell").groupBy("p").count()
    assert max([r["count"] for r in single.collect()]) < number // 10
    assert max(r["count"] for r in reached.groupBy("p").count().collect()) < 1_000
    assert max(r["count"] for r in cells.levels[-1].join(cells.members, "cell").groupBy("cell").count().collect()) <= number // 20 + joins.CELL_REGIONS


def test_crowded_regions_are_dealt_to_tasks_and_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 500)
    places = [(f"r{k % 2900}", f"n{k}", 40 + k / 3000, 5.0) for k in range(3000)] + [(None, "no id", 40.0, 5.0), ("no place", "n", None, 5.0), (None, "neither", 5.0, math.nan)]
    regions = spark.createDataFrame(places, "region_id string, region_name string, latitude double, longitude double")
    df = spark.createDataFrame([(t, 40.5, lon) for t in (T0, T1, None) for lon in (5.0, 5.0, 23.0)], "timestamp timestamp, latitude double, longitude double")
    got = joins.region_coverage_from_positions(df, regions)
    assert got.rdd.getNumPartitions() >= 3 * len(places) // 500 and "inline(scalar" not in plan(got) and "Subquery" not in plan(got)
    wanted = {}
    for name, _, lat0, lon0 in places:
        near = [math.sqrt((40.5 - lat0) ** 2 + (lon - lon0) ** 2) * 111 < 2000 for lon in (5.0, 5.0, 23.0)] if name and lat0 else []
        wanted[name] = wanted.get(name, 0) + sum(near)
    assert rows(got.select("region_id", "region_name", "timestamp", "satellite_count")) == sorted(
        ((name, label, t, wanted[name]) for name, label, _, _ in places for t in (T0, T1, None)), key=repr
    )


@pytest.mark.parametrize("most", [1, 3])
def test_cells_split_down_to_single_regions(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "CELL_REGIONS", most)
    monkeypatch.setattr(joins.region_cells, "__defaults__", (most,))
    lat, lon, at_lat, at_lon = crowded(300, seed=most)
    regions = [(f"r{k}", "r", float(a), float(b)) for k, (a, b) in enumerate(zip(lat, lon, strict=True))] + [("none", "n", None, 1.0)]
    positions = [(T0 if k % 2 else T1, float(a), float(b)) for k, (a, b) in enumerate(zip(at_lat, at_lon, strict=True))]
    df = spark.createDataFrame(positions, "timestamp timestamp, latitude double, longitude double")
    table = spark.createDataFrame(regions, "region_id string, region_name string, latitude double, longitude double")
    got = {(r.region_id, r.timestamp): r.satellite_count for r in joins.region_coverage_from_positions(df, table).collect()}
    wanted = brute_force_coverage(positions, regions[:-1])
    assert {k: n for k, n in got.items() if k[0] != "none"} == {k: v[2] for k, v in wanted.items()}
    assert got["none", T0] == 0


def test_first_per_key_does_not_depend_on_order(spark):
    data = [("a", 2, None), ("a", 1, "x"), ("a", 1, None), ("b", None, "z"), ("b", 0, "y")]
    for ordered in (data, data[::-1]):
        df = spark.createDataFrame(ordered, "k string, n int, s string")
        assert rows(joins.first_per_key(df, ["k"])) == sorted([("a", 1, None), ("b", None, "z")], key=repr)


def test_insert_absent_rows(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "k string, n int")
    existing = spark.createDataFrame([("a", 9), ("a", 8), ("d", 7)], "k string, n int")
    assert rows(joins.insert_absent_rows(batch, existing, ["k"])) == [("b", 2), ("c", 4)]
