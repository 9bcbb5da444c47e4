"""Validation and repair of satellite rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import fixed_values as fixed
from perigee.functions.expressions import (
    coverage_radius,
    diurnal_factor,
    ground_track_velocity,
    nan_to_null,
    normalize_status,
    orbital_period,
)

# Comparisons with NULL are not true and NaN sorts above every number, so the upper
# bound of each range drops both.


def filter_required_key(df: DataFrame) -> DataFrame:
    return df.where(F.col("satellite_id").isNotNull())


def filter_latitude(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").between(*map(float, fixed.LATITUDE_RANGE)))


def filter_longitude(df: DataFrame) -> DataFrame:
    return df.where(F.col("longitude").between(*map(float, fixed.LONGITUDE_RANGE)))


def filter_altitude(df: DataFrame) -> DataFrame:
    low, high = map(float, fixed.ALTITUDE_RANGE)
    altitude = F.col("altitude")
    return df.where((altitude > low) & (altitude < high))


def valid_positions(df: DataFrame) -> DataFrame:
    """All row filters, canonical status, and NaN velocity as NULL; velocity is not filled yet."""
    checks = (filter_required_key, filter_latitude, filter_longitude, filter_altitude)
    for check in checks:
        df = df.transform(check)
    return df.withColumns(
        {"status": normalize_status(F.col("status")), "velocity": nan_to_null(F.col("velocity"))}
    )


def mean_velocity(df: DataFrame) -> Column:
    """Mean of the velocities present, as a scalar subquery: nothing is joined or collected."""
    return df.agg(F.avg(nan_to_null(F.col("velocity")))).scalar()


def impute_velocity_mean(df: DataFrame, mean: Column | None = None) -> DataFrame:
    """Fill NULL and NaN velocity with the mean of the rest.

    NaN rows take no part in the mean, and a mean of exactly 0 is used like any other.
    """
    mean = mean_velocity(df) if mean is None else mean
    return df.withColumn("velocity", F.coalesce(nan_to_null(F.col("velocity")), mean))


def clean_satellite(df: DataFrame) -> DataFrame:
    return impute_velocity_mean(valid_positions(df))


def orbital_metrics(df: DataFrame, period_minutes: float = fixed.ORBITAL_PERIOD_MINUTES) -> DataFrame:
    altitude, period = F.col("altitude"), orbital_period(period_minutes)
    return df.withColumns(
        {
            "orbital_period_minutes": period,
            "ground_track_velocity_kmh": ground_track_velocity(altitude, period),
            "estimated_coverage_radius_km": coverage_radius(altitude),
        }
    )


def diurnal_adjust(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Remove the time-of-day swing from latency and throughput."""
    factor = diurnal_factor(F.col(time_col))
    return df.withColumns(
        {
            "base_latency_ms": F.col("latency_ms") / factor,
            "base_throughput_mbps": F.col("throughput_mbps") * factor,
        }
    )
