"""The ledger of batches: which were begun under a root of results, and which of them are complete.

A batch's rows lie in directories of their own, so running it again replaces them. Outputs are replaced one after the
other, each as a whole; the ledger says when the last one was. A batch that was begun and not published is repeated
with the same input, whatever it left behind. There must be one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.model import BATCH, RAW_DATASETS
from perigee.sinks.parquet import write_parquet
from perigee.sources.files import exists

LEDGER = "batches"
#: States of a batch: begun for the first time, begun again after it was complete, complete.
OPEN, REOPENED, PUBLISHED = "open", "reopened", "published"
SCHEMA = f"state string, output string, rows bigint, at timestamp, {BATCH} string"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def entries(spark: SparkSession, root: str) -> DataFrame:
    """``batch, state, output, rows, at``: a row for each output of a complete batch, one row for any other."""
    path = f"{root.rstrip('/')}/{LEDGER}"
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def states(spark: SparkSession, root: str) -> dict[str, str]:
    """The state of each batch by its name: as many entries as there were batches."""
    return {r[BATCH]: r["state"] for r in entries(spark, root).select(BATCH, "state").distinct().collect()}


def _write(spark: SparkSession, root: str, batch: str, state: str, counts: Mapping[str, int | None]) -> None:
    rows = spark.createDataFrame([(state, o, n, batch) for o, n in counts.items()], f"state string, output string, rows bigint, {BATCH} string")
    write_parquet(rows.withColumn("at", F.current_timestamp()), f"{root.rstrip('/')}/{LEDGER}", [BATCH], "replace")


def begin(spark: SparkSession, root: str, batch: str) -> dict[str, str]:
    """Enter a batch as begun and return the states before. Refuses names that are no plain directory names, and a root
    whose results do not belong to batches."""
    if not _NAME.fullmatch(batch):
        raise ValueError(f"batch name {batch!r}: letters, digits, dots, dashes and underscores only")
    before = states(spark, root)
    if not before and any(exists(spark, f"{root.rstrip('/')}/{d.file_stem}") for d in RAW_DATASETS):
        raise ValueError(f"{root} holds results of a run without batches")
    again = before.get(batch) in (PUBLISHED, REOPENED)
    _write(spark, root, batch, REOPENED if again else OPEN, {"": None})
    return before


def publish(spark: SparkSession, root: str, batch: str, counts: Mapping[str, int]) -> None:
    _write(spark, root, batch, PUBLISHED, counts)


def countable(before: Mapping[str, str], batch: str) -> list[str]:
    """Batches whose rows count in statistics: complete ones, now or before, and the one at hand."""
    return sorted({b for b, state in before.items() if state in (PUBLISHED, REOPENED)} | {batch})
