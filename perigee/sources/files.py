"""File scans under a declared schema: CSV, JSON and Parquet give the same typed columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.sources.json_records import CORRUPT, read_records, with_corrupt


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("any string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns by name, in order, cast to the declared types."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"input lacks declared columns {absent}; it has {df.columns}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    check_header: bool = True,
) -> DataFrame:
    """CSV binds columns by position. A header in another order is an error unless
    ``check_header`` is off. A cell that does not parse becomes NULL (see ``scan_rejects``)."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", not check_header)
        .csv(path)
    )


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """JSON in any layout, read in byte ranges (see ``read_records``): JSON Lines and record arrays on one line or many,
    mixed as they come. ``multi_line`` reads with Spark's own reader instead, one file per task."""
    if multi_line:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return read_records(spark, path, schema).drop(CORRUPT)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with the footer's schema, conformed to ``schema`` if one is given."""
    df = spark.read.parquet(path)
    return df if schema is None else conform_schema(df, schema)


def scan_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "csv",
    header: bool = True,
) -> DataFrame:
    """Rows the reader could not fully parse: what it salvaged, and the raw text of the row or JSON record."""
    match file_format.lower():
        case "csv":
            reader = spark.read.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", CORRUPT)
            df = reader.option("mode", "PERMISSIVE").option("header", header).csv(path)
        case "json":
            return read_records(spark, path, schema).where(F.col(CORRUPT).isNotNull())
        case other:
            raise ValueError(f"no raw text to reject in format {other!r}")
    # The reader only parses the columns a plan asks for, and a cell it skips cannot be faulty.
    # Naming every column keeps the verdict the same whatever the caller selects.
    parsed_all = F.length(F.concat_ws("", *(F.col(f.name).cast("string") for f in schema))) >= 0
    return df.where(F.col(CORRUPT).isNotNull() & parsed_all)
