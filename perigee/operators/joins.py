"""Joins between the datasets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import fixed_values as fixed
from perigee.functions.expressions import coverage_from_count, planar_distance_km
from perigee.functions.times import hour_start
from perigee.model import WINDOW_START
from perigee.operators.skew import grouped_lookup
from perigee.session import shared_folder


def align_region(coverage: DataFrame) -> DataFrame:
    """Give coverage the region column name performance uses."""
    return coverage.withColumnRenamed("region_id", "region")


def _unmatched(rows: DataFrame, others: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key ``others`` lacks. An outer join with a marker, since the optimizer moves an
    anti join below projections, and then its shuffle of ``rows`` no longer equals the one of the
    inner join and cannot be shared with it."""
    held = grouped_lookup(others, key, F.count(F.lit(1)).alias("_copies"))
    return rows.join(held, key, "left").where(F.col("_copies").isNull()).drop("_copies")


def full_outer_by_key(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """FULL OUTER equi-join with one copy of the key, built to survive hot and NULL keys.

    Spark cannot split an oversized partition of a full outer join. So the parts are joined apart, in
    forms that adaptive execution can split: matches, left rows without a partner and right rows
    without one, the latter two by looking up each key once. Rows with a NULL in their key match nothing
    and take no part in any join. A key with n rows on one side and m on the other gives n x m rows, as
    the join asks. Nothing runs until the result is used; both inputs are read three times, so they
    should be columnar.
    """
    key = list(key)
    shared = sorted((set(left.columns) & set(right.columns)) - set(key))
    if shared:
        raise ValueError(f"columns {shared} occur on both sides; rename them first")
    payload = [c for df in (left, right) for c in df.columns if c not in key]
    whole_key = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    left_keyed, right_keyed = left.where(whole_key), right.where(whole_key)
    pieces = [
        left_keyed.join(right_keyed, key, "inner"),
        _unmatched(left_keyed, right_keyed, key),
        _unmatched(right_keyed, left_keyed, key),
        left.where(~whole_key),
        right.where(~whole_key),
    ]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    return whole.select(*key, *payload)


def join_coverage_performance(
    coverage: DataFrame, performance: DataFrame, time_col: str = "timestamp"
) -> DataFrame:
    """Coverage and performance side by side per region and exact time; either may be missing."""
    return full_outer_by_key(align_region(coverage), performance, ("region", time_col))


def dashboard_view(coverage_stats: DataFrame, performance_stats: DataFrame) -> DataFrame:
    """Hourly coverage with the performance of the same region and hour, where there is any.

    Both tables hold one row per key, and rollups are already partitioned by it.
    """
    performance = performance_stats.select(
        F.col("region").alias("region_id"),
        WINDOW_START,
        "avg_latency_ms",
        "avg_throughput_mbps",
        "avg_availability_percentage",
    )
    coverage = coverage_stats.select(
        "region_id", WINDOW_START, "avg_coverage_percentage", "avg_satellite_count"
    )
    return coverage.join(performance, ["region_id", WINDOW_START], "left")


#: Regions that a cell may have before it is split, and how often cells are split at most.
CELL_REGIONS, SPLITS = 64, 40
#: Result rows and positions meant for one task.
TASK_ROWS, TASK_POSITIONS = 250_000, 100_000
#: Slices of leaves that all times are joined with.
SLICES = 16


@dataclass(frozen=True)
class RegionCells:
    """Regions in cells that are as fine as the regions are dense.

    ``levels`` has the cells of each level: ``cell``, the ``parent`` it is part of, bounds of its regions, and whether it
    is a ``leaf``; ``members`` has the regions of every cell. A cell is split in four until it has few regions or all its
    regions are in one place.
    """

    levels: list[DataFrame]
    members: DataFrame


def region_cells(regions: DataFrame, width: float, most: int = CELL_REGIONS) -> RegionCells:
    """Cells of the plane ``width`` degrees wide and their parts, for rows ``region_id, latitude, longitude``."""
    spark = regions.sparkSession
    shared_folder(spark)
    sound = F.col("latitude").between(-1e6, 1e6) & F.col("longitude").between(-1e6, 1e6)
    active = regions.where(sound).select("region_id", F.col("latitude").alias("_lat0"), F.col("longitude").alias("_lon0"))
    levels, members = [], []
    for level in range(SPLITS + 1):
        # scaling by powers of two is exact, so cells nest
        place = lambda c, k: F.floor(F.col(c) / width * 2.0**k).cast("string")
        name = lambda k: F.concat_ws(":", F.lit(k), place("_lat0", k), place("_lon0", k))
        named = active.withColumns({"cell": name(level), "parent": name(level - 1)})
        alone = (F.col("south") == F.col("north")) & (F.col("west") == F.col("east"))
        cells = named.groupBy("cell", "parent").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_lat0").alias("south"), F.max("_lat0").alias("north"), F.min("_lon0").alias("west"), F.max("_lon0").alias("east")
        )
        cells = cells.withColumn("leaf", (F.col("_n") <= most) | alone | F.lit(level == SPLITS)).drop("_n").checkpoint()
        levels.append(cells)
        members.append(named.select("cell", "region_id", "_lat0", "_lon0"))
        large = cells.where("NOT leaf").select("cell")
        if large.isEmpty():
            break
        active = named.join(large, "cell", "left_semi").drop("cell", "parent").checkpoint()
    return RegionCells(levels, reduce(DataFrame.union, members))


def _judged_cells(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_state`` of a position and a cell: all regions in range, none, some of a leaf, or to be split.

    The distance grows with both differences of coordinates, in floating point too, so no region of a cell is farther
    than its farthest corner or nearer than its nearest point.
    """
    clamp = lambda c, low, high: F.least(F.greatest(F.col(c), F.col(low)), F.col(high))
    far = lambda c, low, high: F.when(F.abs(F.col(c) - F.col(low)) > F.abs(F.col(c) - F.col(high)), F.col(low)).otherwise(F.col(high))
    to = lambda how: planar_distance_km(F.col("_lat"), F.col("_lon"), how("_lat", "south", "north"), how("_lon", "west", "east"))
    reach = fixed.VISIBLE_RANGE_KM
    state = F.when(to(far) < reach, "all").when(to(clamp) >= reach, "none").when(F.col("leaf"), "some").otherwise("split")
    return rows.withColumn("_state", state).where("_state <> 'none'")


_BOUNDS = ("south", "north", "west", "east", "leaf")


def positions_in_cells(seen: DataFrame, cells: RegionCells, width: float) -> DataFrame:
    """``seen`` (``_lat, _lon``, others) with ``cell`` and ``_state``: the cells of which a position reaches all regions, and the
    leaves of which it may reach some. A position goes down only where the edge of its range crosses a cell."""
    around = F.array(*(F.lit(k) for k in (-1, 0, 1)))
    place = lambda k: F.split("cell", ":")[k].cast("long")
    roots = cells.levels[0].withColumn("_by", F.explode(around)).withColumn("_row", place(1) + F.col("_by"))
    roots = roots.withColumn("_by", F.explode(around)).withColumn("_column", place(2) + F.col("_by")).drop("_by", "parent")
    at = lambda c: F.floor(F.col(c) / width)
    rows = seen.withColumns({"_row": at("_lat"), "_column": at("_lon")}).join(roots, ["_row", "_column"]).drop("_row", "_column")
    rows = _judged_cells(rows)
    for level in cells.levels[1:]:
        parts = level.select(F.col("cell").alias("_part"), "parent", *(F.col(c).alias(f"_{c}") for c in _BOUNDS))
        down = (F.col("_state") == "split") & (F.col("cell") == F.col("parent"))
        rows = rows.join(parts, down, "left")
        rows = rows.withColumns({c: F.coalesce(f"_{c}", c) for c in _BOUNDS} | {"cell": F.coalesce("_part", "cell")})
        rows = _judged_cells(rows.drop("_part", "parent", "_state", *(f"_{c}" for c in _BOUNDS)))
    return rows.drop(*_BOUNDS)


def _hits_of_leaves(hits: DataFrame, cells: RegionCells, time_col: str) -> DataFrame:
    """``hits`` with those of whole cells passed down to the leaves, level by level: a cell has few parts, so no key is hot."""
    whole, leaves = hits.where(F.col("_lat").isNull()).select(time_col, "cell", "_hits"), []
    above = None
    for level in cells.levels:
        rows = whole.join(level.select("cell", "leaf"), "cell").select(time_col, "cell", "leaf", "_hits")
        if above is not None:
            parts = level.select(F.col("cell").alias("_part"), F.col("parent").alias("cell"), "leaf")
            rows = rows.union(above.join(parts, "cell").select(time_col, F.col("_part").alias("cell"), "leaf", "_hits"))
        rows = rows.groupBy(time_col, "cell", "leaf").agg(F.sum("_hits").alias("_hits")).checkpoint()
        leaves.append(rows.where("leaf"))
        above = rows.where("NOT leaf").drop("leaf")
    whole = reduce(DataFrame.union, leaves).select(time_col, "cell", F.lit(None).cast("double").alias("_lat"), F.lit(None).cast("double").alias("_lon"), "_hits")
    return whole.union(hits.where(F.col("_lat").isNotNull()).select(whole.columns))


def region_coverage_from_positions(
    positions: DataFrame,
    regions: DataFrame | Sequence[tuple[str, str, float, float]] = fixed.REGIONS,
    time_col: str = "timestamp",
    hourly: bool = False,
) -> DataFrame:
    """Coverage of each region at each time, from the positions of the satellites then in range.

    ``regions`` has ``region_id, region_name, latitude, longitude``. Regions lie in cells as wide as the range, split where they
    are dense. A position is counted for a whole cell if it reaches all of its regions; it is measured against single
    regions only in leaves that the edge of its range crosses. Every time gets a row for each region, with 0 where
    nothing is in range: each leaf has a hit of 0 at each time, and regions without a place count as leaves.
    Tasks are as many as the rows of the result need.
    """
    spark = positions.sparkSession
    if not isinstance(regions, DataFrame):
        places = [(i, n, float(a), float(b)) for i, n, a, b in regions]
        regions = spark.createDataFrame(places, "region_id string, region_name string, latitude double, longitude double")
    width = fixed.VISIBLE_RANGE_KM / fixed.KM_PER_DEGREE
    tick = hour_start(F.col(time_col)) if hourly else F.col(time_col)
    seen = positions.select(tick.alias(time_col), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    sound = F.col("_lat").between(-1e6, 1e6) & F.col("_lon").between(-1e6, 1e6)
    cells = region_cells(regions, width)
    ticks = seen.groupBy(time_col).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    times, number = ticks.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = seen.where(sound).repartition(max(least, ceil(number / TASK_POSITIONS)))
    reached = positions_in_cells(spread, cells, width)
    single = lambda c: F.when(F.col("_state") == "some", F.col(c)).alias(c)
    hits = reached.groupBy(time_col, "cell", single("_lat"), single("_lon")).agg(F.count(F.lit(1)).alias("_hits")).checkpoint()

    no_place = lambda *names: (F.lit(None).cast("double").alias(c) for c in names)
    placed = F.coalesce(F.col("latitude").between(-1e6, 1e6) & F.col("longitude").between(-1e6, 1e6), F.lit(False))
    apart = regions.where(~placed).select(F.concat(F.lit("-:"), F.xxhash64("region_id").cast("string")).alias("cell"), "region_id")
    leaves = reduce(DataFrame.union, (c.where("leaf").select("cell") for c in cells.levels))
    members = cells.members.join(leaves, "cell", "left_semi").union(apart.select("*", *no_place("_lat0", "_lon0")))
    sliced = leaves.union(apart.select("cell").distinct()).withColumn("_slice", F.pmod(F.xxhash64("cell"), F.lit(SLICES)).cast("int"))
    by_slice = ticks.select(time_col, F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("_slice"))
    nothing = by_slice.join(sliced, "_slice").select(time_col, "cell", *no_place("_lat", "_lon"), F.lit(0).cast("bigint").alias("_hits"))

    tasks = max(least, ceil(regions.count() * times / TASK_ROWS))
    key = F.coalesce(F.concat(F.lit("="), F.col("region_id").cast("string")), F.lit("")).alias("_key")
    near = _hits_of_leaves(hits, cells, time_col).union(nothing).repartition(tasks, "cell").join(members.repartition(tasks, "cell"), "cell")
    distance = planar_distance_km(F.col("_lat"), F.col("_lon"), F.col("_lat0"), F.col("_lon0"))
    near = near.where(F.col("_lat").isNull() | (distance < fixed.VISIBLE_RANGE_KM))
    counted = F.when(F.col("region_id").isNotNull(), F.col("_hits")).otherwise(0).alias("_hits")
    counts = near.select(time_col, key, counted).repartition(tasks, "_key").groupBy(time_col, "_key").agg(F.sum("_hits").alias("satellite_count"))
    names = regions.select("region_id", "region_name", key).repartition(tasks, "_key")
    return (
        counts.join(names, "_key")
        .withColumn("coverage_percentage", coverage_from_count(F.col("satellite_count")))
        .select("region_id", "region_name", time_col, "coverage_percentage", "satellite_count")
    )


def first_per_key(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by its other columns, so that reruns pick the same one."""
    rest = [c for c in batch.columns if c not in key]
    if not rest:
        return batch.distinct()
    kept = batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*key, "kept.*").select(*batch.columns)


def insert_absent_rows(batch: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` does not hold yet, one per key.

    Rows held already go first, so only new ones are reduced to one per key.
    """
    known = existing.select(*key).distinct()
    return first_per_key(batch.join(known, list(key), "left_anti").select(*batch.columns), key)
