"""Column expressions. All are built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee import fixed_values as fixed

#: Averages add their values as decimals of this type, whose sums do not depend on the order of rows.
_EXACT = "decimal(22,8)"


def round_half_up_2(value: Column) -> Column:
    """Round half-up to two places, once."""
    return F.round(value.cast("double"), 2)


def exact_sum(value: Column) -> Column:
    """The sum as a decimal, the same in whatever order rows are added."""
    return F.sum(value.try_cast(_EXACT))


def rounded_quotient_2(total: Column, number: Column) -> Column:
    """``total / number`` of an exact sum, rounded half-up to two places in one step; NULL for no rows.

    Whole numbers do it: twice the quotient in hundredths, plus one, halved and cut off.
    """
    hundredths = F.call_function("div", F.abs(total) * 200 + number, number * 2)
    return F.when(number > 0, F.sign(total).cast("double") * hundredths.cast("double") / 100)


def mean_2(value: Column) -> Column:
    """The mean of a column rounded once, from an exact sum.

    Where a value is no such decimal (NaN, infinite or beyond 14 digits before the point), the mean of
    doubles is rounded instead.
    """
    exact = F.count(value.try_cast(_EXACT)) == F.count(value)
    return F.when(exact, rounded_quotient_2(exact_sum(value), F.count(value))).otherwise(round_half_up_2(F.avg(value)))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def null_to_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def precise_mean(value: Column) -> Column:
    """Mean as double from one exact sum; NULL when there is nothing to average."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def normalize_status(status: Column) -> Column:
    """Map raw spellings (case-sensitive) to a canonical status; NULL and the rest are unknown."""
    by_spelling = reduce(
        lambda case, item: case.when(status.isin(*item[1]), F.lit(item[0])),
        fixed.STATUS_SPELLINGS.items(),
        F,
    )
    return by_spelling.otherwise(F.lit(fixed.UNKNOWN_STATUS))


def orbital_period(minutes: float = fixed.ORBITAL_PERIOD_MINUTES) -> Column:
    return F.lit(float(minutes))


def ground_track_velocity(altitude_km: Column, period_minutes: Column) -> Column:
    """Speed over ground in km/h: one circumference at this altitude per period."""
    circumference = F.lit(2 * math.pi) * (F.lit(fixed.EARTH_RADIUS_KM) + altitude_km)
    return F.round(F.try_divide(circumference, period_minutes) * F.lit(60.0), 2)


def coverage_radius(altitude_km: Column) -> Column:
    return F.round(altitude_km * F.lit(fixed.COVERAGE_RADIUS_PER_KM_ALTITUDE), 2)


def orbital_velocity(altitude_km: Column) -> Column:
    """Circular-orbit speed in km/s at an altitude."""
    gm = F.lit(fixed.GRAVITATIONAL_CONSTANT * fixed.EARTH_MASS_KG)
    radius_m = (altitude_km + F.lit(fixed.EARTH_RADIUS_KM)) * F.lit(1000.0)
    return F.sqrt(gm / radius_m) / F.lit(1000.0)


def diurnal_factor(ts: Column) -> Column:
    angle = F.hour(ts) * F.lit(math.pi) / F.lit(fixed.HOURS_PER_HALF_CYCLE)
    return F.lit(1.0) + F.lit(fixed.DIURNAL_AMPLITUDE) * F.sin(angle)


def planar_distance_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Degree-plane distance; it does not wrap at the antimeridian."""
    dlat, dlon = lat - lat0, lon - lon0
    return F.sqrt(dlat * dlat + dlon * dlon) * F.lit(fixed.KM_PER_DEGREE)


def coverage_from_count(satellites: Column) -> Column:
    share = satellites.cast("double") / F.lit(fixed.SATELLITES_FOR_FULL_COVERAGE) * F.lit(100.0)
    return F.round(F.least(F.lit(100.0), share), 2)
