"""Reads of what the batch run wrote: statistics tables and the dated satellite copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.times import Moment, moment
from perigee.model import BATCH, SATELLITE, RawDataset, StatsTable
from perigee.sinks.jdbc import JdbcTarget
from perigee.sources.json_records import with_corrupt


def scan_stats(
    spark: SparkSession,
    root: str | None,
    table: StatsTable,
    database: JdbcTarget | None = None,
    span: tuple[object, object] | None = None,
) -> DataFrame:
    """A statistics table from its Parquet folder under ``root``, or from the database.

    A database scan is spread over several connections if the ``span`` of window starts is given.
    """
    if database is not None:
        options = database.read_options(table.name, span)
        return spark.read.format("jdbc").options(**options).load()
    return spark.read.schema(table.schema).parquet(f"{root.rstrip('/')}/{table.name}")


def read_regional(spark: SparkSession, root: str, dataset: RawDataset) -> DataFrame:
    """Processed coverage or performance rows. Region folders keep their names: "01" is no number."""
    folder = f"{root.rstrip('/')}/{dataset.file_stem}"
    return spark.read.schema(dataset.schema).parquet(folder).select(*dataset.schema.names)


def read_rejects(spark: SparkSession, root: str, dataset: RawDataset) -> DataFrame:
    """Raw rows that could not be fully parsed, with their text."""
    schema = with_corrupt(dataset.schema)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/rejected/{dataset.file_stem}").select(*schema.names)


def read_satellite(
    spark: SparkSession, root: str, since: Moment = None, until: Moment = None
) -> DataFrame:
    """Processed satellite rows with ``since <= timestamp < until``.

    The copy is laid out by day, which a filter on ``timestamp`` alone does not prune, so the
    bounds are restated over the directory columns.
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/{SATELLITE.file_stem}").drop(BATCH)
    zone = T.TimestampType()
    day = F.make_date("year", "month", "day")
    if since is not None:
        bound = moment(since, zone)
        df = df.where((day >= bound.cast("date")) & (F.col("timestamp") >= bound))
    if until is not None:
        bound = moment(until, zone)
        df = df.where((day <= bound.cast("date")) & (F.col("timestamp") < bound))
    return df
