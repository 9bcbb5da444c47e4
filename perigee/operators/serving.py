"""Reports over the hourly statistics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import fixed_values as fixed
from perigee.functions.expressions import null_to_zero, precise_mean
from perigee.functions.times import Moment, hours_before
from perigee.model import (
    COVERAGE_STATS,
    PERFORMANCE_STATS,
    SATELLITE_STATS,
    WINDOW_START,
    StatsTable,
)

HOURS = fixed.DEFAULT_RECENT_HOURS


def filter_recent(
    df: DataFrame, hours: int = HOURS, as_of: Moment = None, time_col: str = WINDOW_START
) -> DataFrame:
    """Rows from ``hours`` before ``as_of`` (default now) on. There is no upper bound: tables may
    hold hours still to come."""
    bound = hours_before(as_of, hours, df.schema[time_col].dataType)
    return df.where(F.col(time_col) >= bound)


def filter_region(df: DataFrame, region: str | None, column: str) -> DataFrame:
    return df.where(F.col(column) == region) if region else df


#: The row limit of a report unless another one, or ``None`` for all rows, is given.
DEFAULT_LIMIT = -1


def _recent(
    stats: DataFrame, table: StatsTable, region: str | None, hours: int, as_of: Moment, limit: int | None
) -> DataFrame:
    rows = filter_recent(stats, hours, as_of)
    order, default = [F.col(WINDOW_START).desc()], fixed.SINGLE_SERIES_LIMIT
    if table.entity:
        (entity,) = table.entity
        rows = filter_region(rows, region, entity)
        if not region:
            order, default = [F.col(entity).asc(), *order], fixed.ALL_REGIONS_LIMIT
    report = rows.select(*table.report_columns).orderBy(*order)
    return report if limit is None else report.limit(default if limit == DEFAULT_LIMIT else limit)


def recent_satellite_stats(
    stats: DataFrame, hours: int = HOURS, as_of: Moment = None, limit: int | None = DEFAULT_LIMIT
) -> DataFrame:
    """The latest 100 hours of fleet statistics, newest first; another ``limit``, or ``None`` for all."""
    return _recent(stats, SATELLITE_STATS, None, hours, as_of, limit)


def recent_coverage(
    stats: DataFrame,
    region: str | None = None,
    hours: int = HOURS,
    as_of: Moment = None,
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Newest first: 100 rows of one region, or 500 over all regions in region order. The latter
    cuts off whole regions late in the alphabet when there is more than that; ``limit=None`` does not."""
    return _recent(stats, COVERAGE_STATS, region, hours, as_of, limit)


def recent_performance(
    stats: DataFrame,
    region: str | None = None,
    hours: int = HOURS,
    as_of: Moment = None,
    limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """As ``recent_coverage``, for network performance."""
    return _recent(stats, PERFORMANCE_STATS, region, hours, as_of, limit)


def distinct_regions(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def coverage_series(report: DataFrame) -> DataFrame:
    """One time-ordered array of (window start, average coverage) per region of hourly rows.

    Give it ``recent_coverage(.., limit=None)`` for complete series, one point per hour of the span.
    """
    point = F.struct(WINDOW_START, "avg_coverage_percentage")
    return report.groupBy("region_id").agg(F.array_sort(F.collect_list(point)).alias("points"))


def performance_trend(report: DataFrame, region: str | None = None) -> DataFrame:
    """Time-ordered latency and throughput points of one region of hourly rows, complete for
    ``recent_performance(.., limit=None)``: the given region, or else the first in region order."""
    rows = filter_region(report, region, "region")
    if not region:
        rows = rows.where(F.col("region") == rows.agg(F.min("region")).scalar())
    return rows.select("region", WINDOW_START, "avg_latency_ms", "avg_throughput_mbps").orderBy(WINDOW_START)


def fleet_summary(stats: DataFrame, hours: int = HOURS, as_of: Moment = None) -> DataFrame:
    """One row: observation totals and the unweighted mean of the hourly mean altitudes."""
    return filter_recent(stats, hours, as_of).agg(
        F.coalesce(F.sum("total_satellites"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum("operational_count"), F.lit(0)).cast("bigint").alias("operational"),
        null_to_zero(precise_mean(F.col("avg_altitude"))).alias("avg_altitude"),
    )


def _means_by_region(
    stats: DataFrame, entity: str, means: dict[str, str], hours: int, as_of: Moment
) -> DataFrame:
    return (
        filter_recent(stats, hours, as_of)
        .groupBy(F.col(entity).alias("region"))
        .agg(*(null_to_zero(precise_mean(F.col(c))).alias(name) for name, c in means.items()))
    )


def coverage_by_region(stats: DataFrame, hours: int = HOURS, as_of: Moment = None) -> DataFrame:
    means = {"avg_coverage": "avg_coverage_percentage", "avg_satellites": "avg_satellite_count"}
    return _means_by_region(stats, "region_id", means, hours, as_of)


def performance_by_region(stats: DataFrame, hours: int = HOURS, as_of: Moment = None) -> DataFrame:
    means = {
        "avg_latency": "avg_latency_ms",
        "avg_throughput": "avg_throughput_mbps",
        "avg_availability": "avg_availability_percentage",
    }
    return _means_by_region(stats, "region", means, hours, as_of)


def summary_sections(
    satellite_stats: DataFrame,
    coverage_stats: DataFrame,
    performance_stats: DataFrame,
    hours: int = HOURS,
    as_of: Moment = None,
) -> dict[str, DataFrame]:
    return {
        "satellite": fleet_summary(satellite_stats, hours, as_of),
        "coverage": coverage_by_region(coverage_stats, hours, as_of),
        "performance": performance_by_region(performance_stats, hours, as_of),
    }


def dashboard_summary_rows(sections: dict[str, DataFrame]) -> DataFrame:
    """The summary in long form, (section, region, metric, value): distributed, whatever the
    number of regions."""
    parts = []
    for name, df in sections.items():
        metrics = [c for c in df.columns if c != "region"]
        region = F.col("region") if "region" in df.columns else F.lit(None).cast("string")
        pairs = F.array(
            *(
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                for m in metrics
            )
        )
        parts.append(df.select(F.lit(name).alias("section"), region.alias("region"), F.inline(pairs)))
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def dashboard_summary(sections: dict[str, DataFrame]) -> DataFrame:
    """The summary as one nested row, the shape a page consumes.

    That row holds every region of a section. For very many regions use the sections themselves, or
    ``dashboard_summary_rows``, which stay distributed.
    """

    def gathered(name: str) -> DataFrame:
        df = sections[name]
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name))

    satellite = sections["satellite"]
    return satellite.select(
        F.struct(*satellite.columns).alias("satellite"),
        gathered("coverage").scalar().alias("coverage"),
        gathered("performance").scalar().alias("performance"),
    )
