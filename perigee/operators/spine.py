"""Regular time grids, used to surface hours for which an entity has no data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.times import Moment, moment
from perigee.model import WINDOW_START

_TICKS_PER_CHUNK = 1000


def time_spine(
    entities: DataFrame,
    start: Moment,
    end: Moment,
    step_minutes: int = 5,
    tick_col: str = "tick",
    like: T.DataType | None = None,
) -> DataFrame:
    """Every entity at every ``step_minutes`` from ``start`` to ``end``, both included.

    Ticks are generated in chunks that are spread over the cluster before they are unfolded, so
    neither one array nor one task ever holds a whole grid.
    """
    like = like or T.TimestampType()
    first, last = moment(start, like), moment(end, like)
    step = F.make_dt_interval(mins=F.lit(int(step_minutes)))
    stride = F.make_dt_interval(mins=F.lit(int(step_minutes) * _TICKS_PER_CHUNK))
    chunk_end = F.least(F.col("_chunk") + stride - step, F.col("_last"))
    parallelism = entities.sparkSession.sparkContext.defaultParallelism
    starts = F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last", stride))
    bounded = entities.withColumns({"_first": first, "_last": last})
    chunks = bounded.withColumn("_chunk", F.explode(starts))
    return (
        chunks.repartition(parallelism, "_chunk", *entities.columns)
        .withColumn(tick_col, F.explode(F.sequence(F.col("_chunk"), chunk_end, step)))
        .select(*entities.columns, tick_col)
    )


def missing_windows(spine: DataFrame, stats: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Grid points (``entity`` and window start) that a statistics table does not hold."""
    on = [*entity, WINDOW_START]
    return spine.join(stats.select(*on), on, "left_anti")
