"""Time helpers. The policy is UTC sessions; inputs may be zoned or zone-less timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Moment = Column | datetime | str | None


def hour_start(ts: Column) -> Column:
    """Start of the UTC-aligned hour, keeping the timestamp type. Drops rows whose time is NULL."""
    return F.window(ts, "1 hour").getField("start")


def moment(value: Moment, like: T.DataType) -> Column:
    """A point in time as a column of type ``like``; ``None`` means now.

    Giving the bound the type of the column it meets keeps the comparison free of casts on the
    column side, which would block predicate pushdown.
    """
    if value is None:
        now = F.localtimestamp() if isinstance(like, T.TimestampNTZType) else F.current_timestamp()
        return now.cast(like)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return (value if isinstance(value, Column) else F.lit(value)).cast(like)


def hours_before(value: Moment, hours: int, like: T.DataType) -> Column:
    return moment(value, like) - F.make_dt_interval(hours=F.lit(int(hours)))


def latest(df: DataFrame, time_col: str) -> Column:
    """Largest time in ``df`` as a scalar subquery, usable as an ``as_of``."""
    return df.agg(F.max(time_col)).scalar()


def date_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
