"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.session import fresh_folder

#: What separates words, as a Java pattern: blank and the controls 9 to 13.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back, which cuts the lineage."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    pieces = F.split(text, SEPARATORS, -1)
    ends = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when(
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1
    ).otherwise(0)
    return F.when(text.isNull(), 0).otherwise(F.size(pieces) - ends).cast("long")
