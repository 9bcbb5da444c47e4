"""Hourly statistics as partial sums that merge: rows that come late change an old hour without its old rows.

A partial row holds, for an entity and an hour, everything its measures are made of: exact sums and counts, extremes,
counts by status. Partials of several batches add up to those of all their rows, and the statistics that follow from
them are those of a recount of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.expressions import exact_sum, nan_to_null, round_half_up_2, rounded_quotient_2
from perigee.functions.times import hour_start
from perigee.model import RAW_DATASETS, SATELLITE_STATS, STATS_TABLES, WINDOW_END, WINDOW_START, Measure, StatsTable
from perigee.operators.rollups import status_count, window_end

UNDATED = "undated"
#: Type of merged sums; wide enough for the sums of single batches.
_TOTAL = "decimal(32,8)"


def _numbers(table: StatsTable) -> list[str]:
    """Columns whose sums or extremes a table's measures need."""
    return list(dict.fromkeys(m.source for m in table.measures if m.how in ("avg", "min", "max")))


def _statuses(table: StatsTable) -> list[str]:
    return [m.source for m in table.measures if m.how == "status"]


def hourly_partials(df: DataFrame, table: StatsTable, time_col: str = "timestamp") -> DataFrame:
    """One row per entity and UTC hour; rows without a time have one of their own per entity, marked ``undated``.

    Satellite rows are those of ``valid_positions``, velocity not yet filled.
    """
    ts = F.col(time_col)
    anchor = F.lit("1970-01-01 00:00:00").cast(df.schema[time_col].dataType)
    numbers = [nan_to_null(F.col(c)).alias(c) if c == "velocity" else F.col(c) for c in _numbers(table)]
    keyed = df.select(
        *table.entity,
        *(["status"] if _statuses(table) else []),
        *numbers,
        ts.isNull().alias(UNDATED),
        hour_start(F.coalesce(ts, anchor)).alias(WINDOW_START),
    )
    return keyed.groupBy(*table.entity, UNDATED, WINDOW_START).agg(
        F.count(F.lit(1)).alias("rows"),
        *(status_count(s).alias(f"{s}_rows") for s in _statuses(table)),
        *(aggregate for c in _numbers(table) for aggregate in _number_partials(c)),
    )


def _number_partials(column: str) -> list[Column]:
    value = F.col(column)
    return [
        exact_sum(value).alias(f"{column}_sum"),
        F.count(value.try_cast("decimal(22,8)")).alias(f"{column}_exact"),
        F.count(value).alias(f"{column}_count"),
        F.sum(value.cast("double")).alias(f"{column}_double"),
        F.min(value).alias(f"{column}_min"),
        F.max(value).alias(f"{column}_max"),
    ]


def merged_partials(partials: DataFrame, table: StatsTable) -> DataFrame:
    """One row per entity and hour of partials of any number of batches."""
    key = [*table.entity, UNDATED, WINDOW_START]

    def merge(column: str) -> Column:
        if column.endswith("_min"):
            return F.min(column)
        if column.endswith("_max"):
            return F.max(column)
        return F.sum(column).try_cast(_TOTAL) if column.endswith("_sum") else F.sum(column)

    columns = [c for c in partials_schema(partials.sparkSession, table).names if c not in key]
    return partials.groupBy(*key).agg(*(merge(c).alias(c) for c in columns))


def mean_velocity(partials: DataFrame) -> float | None:
    """The mean that fills missing velocities: that of all rows, those without a time included. One number."""
    total = F.sum(F.col("velocity_sum")).cast("double")
    return partials.agg(F.try_divide(total, F.sum("velocity_count"))).first()[0]


def _measure(measure: Measure, filled: float | None) -> Column:
    match measure.how:
        case "rows":
            return F.col("rows")
        case "status":
            return F.col(f"{measure.source}_rows")
        case "min" | "max":
            return F.col(f"{measure.source}_{measure.how}")
    total, number = F.col(f"{measure.source}_sum"), F.col(f"{measure.source}_count")
    exact = rounded_quotient_2(total, number)
    if measure.source == "velocity":
        missing = F.col("rows") - number
        known = F.coalesce(total, F.lit(0).cast(_TOTAL))
        mixed = (known.cast("double") + missing * F.lit(filled).cast("double")) / F.col("rows")
        return F.when(missing > 0, round_half_up_2(mixed)).otherwise(rounded_quotient_2(known, F.col("rows")))
    inexact = round_half_up_2(F.try_divide(F.col(f"{measure.source}_double"), number))
    return F.when(F.col(f"{measure.source}_exact") == number, exact).otherwise(inexact)


def stats_of_partials(merged: DataFrame, table: StatsTable) -> DataFrame:
    """The hourly statistics that a recount of all rows gives."""
    filled = mean_velocity(merged) if table is SATELLITE_STATS else None
    dated = merged.where(~F.col(UNDATED)).withColumn(WINDOW_END, window_end(F.col(WINDOW_START)))
    return dated.select(*table.key, *(_measure(m, filled).alias(m.name) for m in table.measures))


def partials_schema(spark: SparkSession, table: StatsTable):
    dataset = RAW_DATASETS[STATS_TABLES.index(table)]
    return hourly_partials(spark.createDataFrame([], dataset.schema), table).schema
