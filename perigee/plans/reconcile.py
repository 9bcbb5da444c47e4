"""Row counts of written folders from Parquet footers, against what the ledger entered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.model import BATCH, RAW_DATASETS
from perigee.plans import ledger
from perigee.sources.files import exists


def footer_counts(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``row_count`` by the partition columns, which must be all that the folder has: counts from footers, no scan.

    The frame belongs to a session of its own, whose settings let the Parquet source answer counts; values of partition
    columns come as the text in the directory names.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    rows = session.read.parquet(path)
    return rows.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"))


def reconciled(spark: SparkSession, root: str) -> DataFrame:
    """``batch, output, entered, held``: rows of each complete batch by the ledger and by the footers, for the outputs
    whose rows lie in directories of their batch. Folders that are gone hold 0 rows. As small as the ledger."""
    root = root.rstrip("/")
    kinds = "output string, batch string, held bigint"
    held = spark.createDataFrame([], kinds)
    folders = {d.name: (d.file_stem, d.layout) for d in RAW_DATASETS}
    folders |= {f"rejected/{d.file_stem}": (f"rejected/{d.file_stem}", ()) for d in RAW_DATASETS}
    for output, (folder, layout) in folders.items():
        path = f"{root}/{folder}"
        if not exists(spark, path) or spark.read.schema(f"{BATCH} string").parquet(path).isEmpty():
            continue
        by_batch = footer_counts(spark, path, [*layout, BATCH]).groupBy(BATCH).agg(F.sum("row_count").alias("held")).collect()
        held = held.union(spark.createDataFrame([(output, r[BATCH], r["held"]) for r in by_batch], kinds))
    entered = ledger.entries(spark, root).where((F.col("state") == ledger.PUBLISHED) & F.col("output").isin(*folders))
    joined = entered.select(BATCH, "output", F.col("rows").alias("entered")).join(held, [BATCH, "output"], "left")
    return joined.select(BATCH, "output", "entered", F.coalesce("held", F.lit(0)).cast("bigint").alias("held"))
