"""How the operators behave on many more rows: ``python -m checks.scale [factor] [name ...]``.

Multiplies ``events`` of sf0.1 (later hours, new ids), moves a third of all rows to one user, and so
to one region, and a tenth of those to one instant. Each operator is timed next to the plain way of
writing it.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import functions as F

from checks.views import coverage, performance, telemetry
from perigee.fixed_values import REGIONS
from perigee.functions.expressions import planar_distance_km
from perigee.functions.times import hour_start
from perigee.operators import cleaning, joins, rollups
from perigee.session import build_session, fresh_folder

SOURCE = "/root/testdata/sf0.1"


def multiply(spark, factor: int) -> str:
    root = fresh_folder(spark, f"scale-{factor}")
    events = spark.read.parquet(f"{SOURCE}/events.parquet")
    rows = events.count()
    copies = events.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("copy"))
    later = F.col("ts") + F.make_dt_interval(secs=(F.col("copy") * 977).cast("decimal(18,6)"))
    event_id = F.col("event_id") + F.col("copy") * rows
    hot = event_id % 3 == 0
    instant = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    copies.select(
        event_id.alias("event_id"),
        F.when(event_id % 31 == 0, instant).otherwise(later).alias("ts"),
        F.when(hot, 0).otherwise(F.col("user_id")).cast("bigint").alias("user_id"),
        "event_type",
        "value",
        "props",
    ).repartition(32).write.parquet(f"{root}/events.parquet")
    spark.read.parquet(f"{SOURCE}/region.parquet").write.parquet(f"{root}/region.parquet")
    return root


def stats_one_pass(spark, root):
    valid = cleaning.valid_positions(telemetry(spark, root))
    return rollups.stats_from_partials(rollups.velocity_partials(valid, "ts"))


def stats_fill_first(spark, root):
    return rollups.hourly_satellite_stats(cleaning.clean_satellite(telemetry(spark, root)), "ts")


def coverage_counters(spark, root):
    return joins.region_coverage_from_positions(telemetry(spark, root), time_col="ts", hourly=True)


def coverage_nested_loop(spark, root):
    places = spark.createDataFrame(list(REGIONS), "region_id string, n string, lat0 double, lon0 double")
    positions = telemetry(spark, root).select(hour_start(F.col("ts")).alias("ts"), "latitude", "longitude")
    dlat, dlon = F.col("latitude") - F.col("lat0"), F.col("longitude") - F.col("lon0")
    near = F.sqrt(dlat * dlat + dlon * dlon) * 111.0 < 2000.0
    return positions.join(F.broadcast(places), near).groupBy("region_id", "ts").count()



def _join_sides(spark, root):
    left = coverage(spark, root).drop("event_id").where("NOT ts = TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    right = performance(spark, root).drop("event_id")
    return left, right


def join_split(spark, root):
    return joins.join_coverage_performance(*_join_sides(spark, root), "ts")


def join_plain(spark, root):
    left, right = _join_sides(spark, root)
    return joins.align_region(left).join(right, ["region", "ts"], "full_outer")


def rollup_recent_pushed(spark, root):
    return rollups.hourly_coverage_stats(coverage(spark, root), "ts", "2024-01-30 00:00:00")


def rollup_recent_filtered_after(spark, root):
    stats = rollups.hourly_coverage_stats(coverage(spark, root), "ts")
    return stats.where("time_window_start >= TIMESTAMP_NTZ '2024-01-30 00:00:00'")


WAYS = (
    stats_one_pass,
    stats_fill_first,
    coverage_counters,
    coverage_nested_loop,
    join_split,
    join_plain,
    rollup_recent_pushed,
    rollup_recent_filtered_after,
)


def main(argv: list[str]) -> None:
    factor = int(argv[0]) if argv else 100
    conf = {
        "spark.master": "local[8]",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "32",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("perigee-scale", conf)
    spark.sparkContext.setLogLevel("OFF")
    root = multiply(spark, factor)
    rows = spark.read.parquet(f"{root}/events.parquet").count()
    print(f"{rows:,} events", flush=True)
    for way in WAYS:
        if argv[1:] and way.__name__ not in argv[1:]:
            continue
        took = []
        for _ in range(2):
            began = time.perf_counter()
            way(spark, root).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        print(f"{way.__name__:32} {min(took):7.2f}s {rows / min(took) / 1e6:8.2f} M rows/s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
