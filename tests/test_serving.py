from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perigee.functions.times import latest
from perigee.model import COVERAGE_STATS, PERFORMANCE_STATS, SATELLITE_STATS
from perigee.operators import serving
from tests.conftest import SF_SMALL, at, plan, rows

AS_OF = at("2024-02-01 00:00:00")


def hourly(spark, table, hours, entities=(None,)):
    """A statistics table with rows every hour up to ``AS_OF``; the measures count hours back."""
    columns = [F.col("entity").alias(e) for e in table.entity]
    start = F.lit(AS_OF) - F.make_dt_interval(hours=F.col("id").cast("int"))
    df = spark.range(hours).select("id", F.explode(F.array(*map(F.lit, entities))).alias("entity"))
    return df.select(
        *columns, start.alias("time_window_start"), (start + F.make_dt_interval(hours=F.lit(1))).alias("time_window_end"),
        *(F.col("id").cast(m.sql_type).alias(m.name) for m in table.measures),
    )


def test_recent_bound_is_inclusive_and_open_ended(spark):
    stats = hourly(spark, SATELLITE_STATS, 48)
    as_of = at("2024-01-31 12:00:00")
    got = [r.time_window_start for r in serving.filter_recent(stats, 24, as_of).collect()]
    assert min(got) == at("2024-01-30 12:00:00") and max(got) == AS_OF


def test_recent_defaults_to_now(spark):
    ages = spark.range(0, 48).select(
        (F.current_timestamp() - F.make_dt_interval(hours=F.col("id").cast("int"), mins=F.lit(30))).alias("time_window_start")
    )
    assert serving.filter_recent(ages).count() == 24
    ntz = ages.select(F.col("time_window_start").cast("timestamp_ntz"))
    assert serving.filter_recent(ntz, 12).count() == 12


@pytest.mark.parametrize("zone", ["timestamp", "timestamp_ntz"])
def test_as_of_forms_agree(spark, zone):
    stats = hourly(spark, SATELLITE_STATS, 48).withColumn("time_window_start", F.col("time_window_start").cast(zone))
    forms = [AS_OF, "2024-02-01 00:00:00", latest(stats, "time_window_start"), at("2024-02-01 05:30:00+05:30")]
    assert {serving.filter_recent(stats, 5, f).count() for f in forms} == {6}


def test_recent_satellites(spark):
    report = serving.recent_satellite_stats(hourly(spark, SATELLITE_STATS, 300), 200, AS_OF)
    got = [r.time_window_start for r in report.collect()]
    assert len(got) == 100 and got == sorted(got, reverse=True) and got[0] == AS_OF
    assert report.columns == SATELLITE_STATS.report_columns
    assert "time_window_end" not in report.columns
    assert "TakeOrderedAndProject" in plan(report)


def test_recent_coverage_and_performance(spark):
    for table, report, dropped in (
        (COVERAGE_STATS, serving.recent_coverage, {"max_satellite_count", "time_window_end"}),
        (PERFORMANCE_STATS, serving.recent_performance, {"time_window_end"}),
    ):
        stats = hourly(spark, table, 300, ("EU", "AS", "NA"))
        (entity,) = table.entity
        everything = report(stats, None, 720, AS_OF).collect()
        order = [(r[entity], -r.time_window_start.timestamp()) for r in everything]
        assert len(everything) == 500 and order == sorted(order)
        assert {r[entity] for r in everything} == {"AS", "EU"}  # the cut-off is alphabetical
        one = report(stats, "NA", 720, AS_OF)
        assert one.count() == 100 and {r[entity] for r in one.collect()} == {"NA"}
        assert set(table.columns) - set(one.columns) == dropped
        assert "TakeOrderedAndProject" in plan(one)


def test_region_filter_reaches_the_scan(spark):
    from perigee.session import fresh_folder

    path = fresh_folder(spark, "stats")
    hourly(spark, COVERAGE_STATS, 5, ("EU", "AS")).write.parquet(path)
    got = plan(serving.recent_coverage(spark.read.parquet(path), "EU", 24, AS_OF))
    assert "EqualTo(region_id,EU)" in got and "GreaterThanOrEqual(time_window_start" in got
    assert "max_satellite_count" not in got


def test_fleet_summary(spark):
    stats = hourly(spark, SATELLITE_STATS, 48)
    assert rows(serving.fleet_summary(stats, 2, AS_OF)) == [(3, 3, 1.0)]
    assert rows(serving.fleet_summary(stats, 2, "2025-01-01")) == [(0, 0, 0.0)]
    assert dict(serving.fleet_summary(stats).dtypes) == {"total": "bigint", "operational": "bigint", "avg_altitude": "double"}


def test_means_by_region_are_unweighted_and_without_null(spark):
    stats = hourly(spark, COVERAGE_STATS, 3, ("EU", "AS")).withColumn(
        "avg_satellite_count", F.lit(None).cast("decimal(10,2)")
    )
    assert rows(serving.coverage_by_region(stats, 24, AS_OF)) == [("AS", 1.0, 0.0), ("EU", 1.0, 0.0)]
    performance = hourly(spark, PERFORMANCE_STATS, 3, ("EU",))
    assert rows(serving.performance_by_region(performance, 1, AS_OF)) == [("EU", 0.5, 0.5, 0.5)]


def test_means_keep_more_digits_than_the_table(spark):
    stats = hourly(spark, PERFORMANCE_STATS, 3, ("EU",)).withColumn(
        "avg_latency_ms", (F.col("avg_latency_ms") / 3).cast("decimal(10,2)")
    )
    got = serving.performance_by_region(stats, 24, AS_OF).first().avg_latency
    assert got == float(Decimal("0.00") + Decimal("0.33") + Decimal("0.67")) / 3


def sections(spark, entities=("EU", "AS")):
    return serving.summary_sections(
        hourly(spark, SATELLITE_STATS, 3), hourly(spark, COVERAGE_STATS, 3, entities),
        hourly(spark, PERFORMANCE_STATS, 3, entities), 24, AS_OF,
    )


def test_nested_summary(spark):
    got = serving.dashboard_summary(sections(spark)).collect()
    assert len(got) == 1
    assert got[0].satellite.asDict() == {"total": 3, "operational": 3, "avg_altitude": 1.0}
    assert [r.asDict() for r in got[0].coverage] == [
        {"region": r, "avg_coverage": 1.0, "avg_satellites": 1.0} for r in ("AS", "EU")
    ]
    assert [r.region for r in got[0].performance] == ["AS", "EU"]


def test_nested_summary_of_nothing(spark):
    empty = {n: df if n == "satellite" else df.limit(0) for n, df in sections(spark).items()}
    row = serving.dashboard_summary(empty).first()
    assert row.coverage == [] and row.performance == [] and row.satellite.total == 3


def test_summaries_of_many_regions(spark):
    many = spark.range(10_500).select(
        F.concat(F.lit("r"), "id").alias("region_id"), F.lit(AS_OF).cast("timestamp").alias("time_window_start"),
        *(F.lit(1).cast(m.sql_type).alias(m.name) for m in COVERAGE_STATS.measures),
    )
    parts = sections(spark) | {"coverage": serving.coverage_by_region(many, 24, AS_OF)}
    assert len(serving.dashboard_summary(parts).first().coverage) == 10_500
    assert serving.dashboard_summary_rows(parts).count() == 3 + 2 * 10_500 + 2 * 3


def test_limits_of_reports_can_be_lifted(spark):
    stats = hourly(spark, COVERAGE_STATS, 3, tuple(f"R{i:03}" for i in range(200)))
    assert serving.recent_coverage(stats, None, 24, AS_OF).count() == 500
    assert serving.recent_coverage(stats, None, 24, AS_OF, limit=None).count() == 600
    assert serving.recent_coverage(stats, None, 24, AS_OF, limit=7).count() == 7


def test_coverage_series(spark):
    report = serving.recent_coverage(hourly(spark, COVERAGE_STATS, 3, ("EU", "AS")), None, 24, AS_OF)
    got = {r.region_id: r.points for r in serving.coverage_series(report).collect()}
    assert set(got) == {"AS", "EU"}
    assert [float(p.avg_coverage_percentage) for p in got["EU"]] == [2.0, 1.0, 0.0]
    assert [p.time_window_start for p in got["EU"]] == sorted(p.time_window_start for p in got["EU"])


def test_performance_trend(spark):
    report = serving.recent_performance(hourly(spark, PERFORMANCE_STATS, 3, ("EU", "AS")), None, 24, AS_OF)
    first = serving.performance_trend(report).collect()
    assert {r.region for r in first} == {"AS"} and [float(r.avg_latency_ms) for r in first] == [2.0, 1.0, 0.0]
    assert {r.region for r in serving.performance_trend(report, "EU").collect()} == {"EU"}


def test_regions(spark):
    assert rows(serving.distinct_regions(hourly(spark, COVERAGE_STATS, 3, ("EU", "AS")), "region_id")) == [("AS",), ("EU",)]


@pytest.mark.parametrize(
    "name",
    [
        "recent_satellite_stats", "recent_coverage_region", "recent_coverage_all", "recent_performance_region",
        "recent_performance_all", "coverage_series", "performance_trend", "fleet_summary", "coverage_by_region",
        "performance_by_region", "dashboard_summary",
    ],
)
def test_reports_read_stored_statistics_only(spark, name):
    from checks.catalog import QUERIES

    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    assert files and all("_statistics/" in f for f in files)
