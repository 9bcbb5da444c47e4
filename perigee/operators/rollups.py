"""Hourly statistics.

Rows are keyed by the flat window start before they are grouped: the shuffle carries one
timestamp per key instead of two, and a later join on (region, window start) finds its input
already partitioned. Every aggregate has a map-side partial, so a region holding most of the
rows reaches the shuffle as one row per hour and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.expressions import exact_sum, mean_2, nan_to_null, round_half_up_2, rounded_quotient_2
from perigee.functions.times import Moment, hour_start, moment
from perigee.model import (
    COVERAGE_STATS,
    CREATED_AT,
    PERFORMANCE_STATS,
    SATELLITE_STATS,
    WINDOW_END,
    WINDOW_START,
    Measure,
    StatsTable,
)


def status_count(status: str, column: str = "status") -> Column:
    return F.count_if(F.col(column) == status)


def _aggregate(measure: Measure) -> Column:
    match measure.how:
        case "rows":
            value = F.count(F.lit(1))
        case "status":
            value = status_count(measure.source)
        case "avg":
            value = mean_2(F.col(measure.source))
        case "min":
            value = F.min(measure.source)
        case "max":
            value = F.max(measure.source)
    return value.alias(measure.name)


def _inputs(table: StatsTable) -> list[str]:
    sources = ["status" if m.how == "status" else m.source for m in table.measures if m.how != "rows"]
    return list(dict.fromkeys([*table.entity, *sources]))


def window_end(start: Column) -> Column:
    return start + F.make_dt_interval(hours=F.lit(1))


def flatten_window(df: DataFrame, window_col: str = "time_window") -> DataFrame:
    """Replace a window struct with its two bounds."""
    kept = [F.col(c) for c in df.columns if c != window_col]
    bounds = F.col(window_col)
    return df.select(
        bounds.getField("start").alias(WINDOW_START),
        bounds.getField("end").alias(WINDOW_END),
        *kept,
    )


def hourly_rollup(
    df: DataFrame, table: StatsTable, time_col: str = "timestamp", since: Moment = None
) -> DataFrame:
    """One row per entity and UTC hour, with the measures of ``table``.

    ``since`` keeps windows starting at or after it. A window start never exceeds the times in
    it, so the same bound also holds for the rows; stated on the time column it reaches the scan,
    which a filter on the computed start cannot.
    """
    if since is not None:
        since = moment(since, df.schema[time_col].dataType)
        df = df.where(F.col(time_col) >= since)
    keyed = df.select(*_inputs(table), hour_start(F.col(time_col)).alias(WINDOW_START))
    if since is not None:
        keyed = keyed.where(F.col(WINDOW_START) >= since)
    grouped = keyed.groupBy(*table.entity, WINDOW_START).agg(*map(_aggregate, table.measures))
    return grouped.withColumn(WINDOW_END, window_end(F.col(WINDOW_START))).select(*table.columns)


def hourly_coverage_stats(
    df: DataFrame, time_col: str = "timestamp", since: Moment = None
) -> DataFrame:
    return hourly_rollup(df, COVERAGE_STATS, time_col, since)


def hourly_performance_stats(
    df: DataFrame, time_col: str = "timestamp", since: Moment = None
) -> DataFrame:
    return hourly_rollup(df, PERFORMANCE_STATS, time_col, since)


def hourly_satellite_stats(
    df: DataFrame, time_col: str = "timestamp", since: Moment = None
) -> DataFrame:
    """Fleet statistics per hour of cleaned rows.

    ``total_satellites`` counts observations, not distinct satellites, and ``unknown`` status
    has no column of its own, so the three status counts need not add up to it.
    """
    return hourly_rollup(df, SATELLITE_STATS, time_col, since)


# One pass over valid but unfilled positions gives both the hourly statistics and the fleet-wide
# mean velocity, so filling the gaps needs no extra scan.

_UNDATED = "undated"


def velocity_partials(valid: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Per-hour sums of ``valid_positions`` rows, with what is needed to fill velocity later.

    Rows without a time belong to no window but still count towards the mean; they form a group
    of their own. Its mark is an aggregate, as a filter on a grouping column would be pushed below
    the grouping and set the statistics' input apart from the one of the mean.
    """
    ts = F.col(time_col)
    anchor = F.lit("1970-01-01 00:00:00").cast(valid.schema[time_col].dataType)
    keyed = valid.select(
        "status",
        "altitude",
        nan_to_null(F.col("velocity")).alias("velocity"),
        ts.isNull().alias("no_time"),
        hour_start(F.coalesce(ts, anchor)).alias(WINDOW_START),
    )
    plain = [m for m in SATELLITE_STATS.measures if m.source != "velocity"]
    grouped = keyed.groupBy("no_time", WINDOW_START).agg(
        F.bool_or("no_time").alias(_UNDATED),
        *map(_aggregate, plain),
        exact_sum(F.col("velocity")).alias("velocity_sum"),
        F.count("velocity").alias("velocity_rows"),
    )
    return grouped.drop("no_time")


def mean_velocity_of(partials: DataFrame) -> Column:
    """Fleet-wide mean velocity, as a scalar subquery over the hourly sums.

    The subquery touches every column of ``partials``. Left to the two it needs, it would be pruned
    to a different aggregation than the one of the statistics, and the rows would be read twice;
    this way both take their input from the same shuffle.
    """
    mean = F.try_divide(F.sum("velocity_sum").cast("double"), F.sum("velocity_rows"))
    whole = F.max(F.struct(*partials.columns))
    return partials.agg(F.struct(mean.alias("mean"), whole.alias("whole"))).scalar().getField("mean")


def stats_from_partials(partials: DataFrame) -> DataFrame:
    """Hourly statistics as if missing velocities had been filled with the fleet mean first."""
    missing = F.col("total_satellites") - F.col("velocity_rows")
    known = F.coalesce("velocity_sum", F.lit(0).cast("decimal(32,8)"))
    filled = known.cast("double") + missing * mean_velocity_of(partials)
    mixed = round_half_up_2(F.try_divide(filled, F.col("total_satellites")))
    exact = rounded_quotient_2(known, F.col("total_satellites"))
    return (
        partials.where(~F.col(_UNDATED))
        .withColumns(
            {
                "avg_velocity": F.when(missing > 0, mixed).otherwise(exact),
                WINDOW_END: window_end(F.col(WINDOW_START)),
            }
        )
        .select(*SATELLITE_STATS.columns)
    )


def cast_stats_types(df: DataFrame, table: StatsTable, created_at: bool = True) -> DataFrame:
    """Serving types for a statistics table. A value too large for its type is an error; set such
    rows aside with ``quarantine_stats`` first."""
    typed = df.select(
        *table.key, *(F.col(m.name).cast(m.sql_type).alias(m.name) for m in table.measures)
    )
    return typed.withColumn(CREATED_AT, F.current_timestamp()) if created_at else typed
