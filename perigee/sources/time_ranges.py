"""An index of the times that files hold, so that a time bound skips whole files whatever form their times have.

Row groups of zone-less times, of text, or of times in an old binary form are never skipped by their own statistics.
The index has one row for each file, written once when the file is new; a scan from some time on reads the files that
reach that time, and those the index does not know.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.times import Moment, moment
from perigee.sources.files import exists

SCHEMA = "file string, low bigint, high bigint, rows bigint"


def _files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files at ``path``, which the scan itself lists on the driver too."""
    return sorted(spark.read.parquet(path).inputFiles())


def _indexed(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(index) if exists(spark, index) else spark.createDataFrame([], SCHEMA)


def _read(spark: SparkSession, path: str, names: list[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    reader = reader if schema is None else reader.schema(schema)
    return reader.parquet(*map(unquote, names))


def index_times(spark: SparkSession, path: str, time_col: str, index: str) -> int:
    """Enter the files at ``path`` that the index does not have yet, and return their number.

    Only the time column of new files is read. Files are known by name and must not change under it. Zone-less times
    count as UTC, as everywhere.
    """
    names = spark.createDataFrame([(f,) for f in _files(spark, path)], "file string")
    new = [r["file"] for r in names.join(_indexed(spark, index), "file", "left_anti").collect()]
    if not new:
        return 0
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    rows = _read(spark, path, new, None).select(F.input_file_name().alias("file"), micros.alias("t"))
    found = rows.groupBy("file").agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count(F.lit(1)).alias("rows"))
    empty = spark.createDataFrame([(f,) for f in new], "file string").join(found, "file", "left")  # files without rows too
    empty.select("file", "low", "high", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")).write.mode("append").parquet(index)
    return len(new)


def files_since(spark: SparkSession, path: str, index: str, since: Moment) -> list[str]:
    """Files at ``path`` that may hold times from ``since`` on."""
    bound = F.unix_micros(moment(since, T.TimestampType()))
    names = spark.createDataFrame([(f,) for f in _files(spark, path)], "file string")
    known = _indexed(spark, index).select("file", "high", F.lit(True).alias("known"))
    reach = names.join(known, "file", "left").where(F.col("known").isNull() | (F.col("high") >= bound))
    return sorted(r["file"] for r in reach.select("file").collect())


def scan_since(
    spark: SparkSession, path: str, index: str, time_col: str, since: Moment, schema: T.StructType | None = None
) -> DataFrame:
    """Rows at ``path`` with a time from ``since`` on; reads no file that the index shows to end before."""
    names = files_since(spark, path, index, since)
    whole = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    rows = _read(spark, path, names, schema) if names else whole.limit(0)
    return rows.where(F.col(time_col).cast("timestamp") >= moment(since, T.TimestampType()))
