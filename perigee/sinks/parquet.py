"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.functions.times import date_parts
from perigee.model import BATCH, StatsTable
from perigee.operators.joins import insert_absent_rows
from perigee.session import shared_folder
from perigee.sources.files import exists

SAVE_MODES = ("overwrite", "append", "ignore", "error", "replace")


def observed_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills in when an action runs over it."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def with_date_parts(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df.withColumns(date_parts(F.col(time_col)))


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    gather: bool = True,
    sort_by: Sequence[str] = (),
) -> int | None:
    """Write Parquet and return the number of rows written, counted along the way.

    A partitioned write first gathers the rows of each directory, or every task would leave a
    small file in every directory. Rebalancing, unlike a plain repartition, lets adaptive execution
    split a directory that is too big for one task. Turn ``gather`` off for input that is already
    ordered by directory, to save the shuffle. ``ignore`` returns no count: it may not write.

    ``sort_by`` orders the rows within each task's directory, so that bounds on those columns skip row
    groups. ``replace`` overwrites only the directories that ``df`` has rows for. Rows are counted after
    the shuffle, where a lost task that runs again is not counted twice.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode {mode!r} is none of {SAVE_MODES}")
    counter = None
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    if mode != "ignore":
        df, counter = observed_rows(df, "written")
    writer = df.write.partitionBy(*partition_by)
    if mode == "replace":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer.mode(mode).parquet(path)
    return counter.get["rows"] if counter else None


def batch_files(spark: SparkSession, path: str, batch: str) -> set[str]:
    """Files that hold rows of a batch, as many as the batch has directories or a few times that."""
    if not exists(spark, path):
        return set()
    rows = spark.read.schema(f"{BATCH} string").parquet(path)
    found = rows.where(F.col(BATCH) == batch).select("_metadata.file_path").distinct().collect()
    return {unquote(r["file_path"]) for r in found}


def replace_batch(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    batch: str,
    gather: bool = True,
    sort_by: Sequence[str] = (),
) -> int:
    """Write the rows of a batch in place of all that it left under ``path`` before, and return their number.

    Rows lie in directories of ``partition_by`` and the batch. Those that have rows now are overwritten; those that
    had rows of the batch before and have none now are emptied. Rows of other batches stay as they are.
    """
    spark = df.sparkSession
    before = batch_files(spark, path, batch)
    keyed = df.withColumn(BATCH, F.lit(batch))
    written = write_parquet(keyed, path, [*partition_by, BATCH], "replace", gather, sort_by)
    stale = before & batch_files(spark, path, batch)
    body = T.StructType([f for f in df.schema if f.name not in partition_by])
    for folder in sorted({name.rsplit("/", 1)[0] for name in stale}):
        spark.createDataFrame([], body).write.mode("overwrite").parquet(folder)
    return written


def emptied(spark: SparkSession, path: str) -> None:
    """Give the space of a scratch folder back."""
    spark.createDataFrame([], "nothing string").write.mode("overwrite").parquet(path)


def append_absent(batch: DataFrame, path: str, table: StatsTable) -> int:
    """Append the rows whose key the folder does not hold yet; the first write of a key wins.

    The key check and the append are two steps, so a folder needs a single writer. Only the hours
    the batch touches are read back. Rows with a NULL key must be set aside before.
    """
    shared_folder(batch.sparkSession)
    batch = batch.checkpoint()  # hourly rows: few, and used three times below
    batch.limit(0).write.mode("ignore").parquet(path)  # the first load starts from an empty table
    held = batch.sparkSession.read.schema(batch.schema).parquet(path)
    start = table.key[-2]
    low, high = batch.agg(F.min(start)).scalar(), batch.agg(F.max(start)).scalar()
    held = held.where(F.col(start).between(low, high))
    return write_parquet(insert_absent_rows(batch, held, table.key), path, mode="append")
