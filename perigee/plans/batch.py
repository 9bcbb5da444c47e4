"""The batch run: extract, check, transform, load."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.model import BATCH, COVERAGE_STATS, PERFORMANCE_STATS, RAW_DATASETS, SATELLITE_STATS, STATS_TABLES, StatsTable
from perigee.operators.cleaning import impute_velocity_mean, orbital_metrics, valid_positions
from perigee.operators.partials import hourly_partials, mean_velocity, merged_partials, partials_schema, stats_of_partials
from perigee.operators.quarantine import accepted, quarantine_stats, rejected
from perigee.operators.rollups import cast_stats_types
from perigee.plans import ledger
from perigee.plans.transform import transform_all
from perigee.session import fresh_folder, shared_folder, use_utc
from perigee.sinks.jdbc import JdbcTarget, load_jdbc_insert_absent
from perigee.sinks.parquet import emptied, replace_batch, with_date_parts, write_parquet
from perigee.sources.processed import scan_stats
from perigee.sources.json_records import CORRUPT
from perigee.sources.raw import extract_all, extract_with_rejects, raw_path, require_nonempty

log = logging.getLogger(__name__)


class LoadError(RuntimeError):
    """One or more outputs could not be written; the others were."""


@dataclass(frozen=True)
class BatchConfig:
    """With a ``batch`` the results of other batches stay and those of this one are replaced, however often and however
    far it ran before; without one the run replaces everything. ``gather=False`` saves the shuffle of detail rows that
    come in order of their folders."""

    raw_root: str
    processed_root: str
    file_format: str = "csv"
    multi_line: bool = False
    database: JdbcTarget | None = None
    batch: str | None = None
    gather: bool = True


def _load_detail(df: DataFrame, root: str, dataset, batch: str | None, gather: bool) -> int:
    if "year" in dataset.layout:
        df = with_date_parts(df)
    path = f"{root}/{dataset.file_stem}"
    if batch is None:
        return write_parquet(df, path, dataset.layout, "overwrite", gather, ["timestamp"])
    return replace_batch(df, path, dataset.layout, batch, gather, ["timestamp"])


def _load_stats(df: DataFrame, root: str, table, database: JdbcTarget | None) -> dict[str, int]:
    # Hourly tables are small and read several times from here on: compute them once.
    judged = quarantine_stats(df.checkpoint(), table)
    sound = cast_stats_types(accepted(judged), table)
    written = write_parquet(sound, f"{root}/{table.name}")
    refused = write_parquet(rejected(judged), f"{root}/rejected/{table.name}")
    if database is not None:
        load_jdbc_insert_absent(scan_stats(df.sparkSession, root, table), table, database)
    return {table.name: written, f"rejected/{table.name}": refused}


def load_all(
    outputs: Mapping[str, DataFrame],
    root: str,
    database: JdbcTarget | None = None,
    gather: bool = True,
    batch: str | None = None,
) -> dict[str, int]:
    """Write every output present and return the rows written per output.

    Detail rows go to dated or per-region folders, in order of time; statistics get their serving types,
    and rows those types refuse go to ``rejected/``. Only statistics are loaded into the database.
    Outputs are written side by side, so the small ones do not leave the cluster idle. A failing output
    does not keep the others from being written, but the call fails in the end. ``gather`` and ``batch`` are those of
    ``BatchConfig``; a batch concerns detail rows, statistics are always written as they are given.
    """
    root = root.rstrip("/")
    jobs = {
        d.name: lambda df, d=d: {d.name: _load_detail(df, root, d, batch, gather)} for d in RAW_DATASETS
    } | {t.name: lambda df, t=t: _load_stats(df, root, t, database) for t in STATS_TABLES}
    present = [name for name in jobs if name in outputs]
    if not present:
        return {}
    spark = outputs[present[0]].sparkSession
    shared_folder(spark)  # checkpoints need a folder
    results = side_by_side(spark, {name: lambda name=name: jobs[name](outputs[name]) for name in present})
    return {output: rows for counts in results.values() for output, rows in counts.items()}


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable]) -> dict:
    """Results by name, once all jobs have ended; an error that names those that failed."""
    run = inheritable_thread_target(spark)(lambda name: jobs[name]())
    with ThreadPoolExecutor(len(jobs)) as pool:
        results = {name: pool.submit(run, name) for name in jobs}
    failures = {n: r.exception() for n, r in results.items() if r.exception()}
    if failures:
        details = "; ".join(f"{name}: {error}" for name, error in failures.items())
        raise LoadError(details) from next(iter(failures.values()))
    return {name: r.result() for name, r in results.items()}


def _staged(spark: SparkSession, config: BatchConfig, folder: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The raw datasets in columns, and counts of their rows and rejects.

    Text is parsed once: into a columnar copy in ``folder``, which also keeps the text of rows that could not be fully
    parsed; those are written to ``rejected/``. Parquet is used as it is.
    """
    if config.file_format.lower() == "parquet":
        return extract_all(spark, config.raw_root, config.file_format), {}

    def stage(dataset) -> tuple[DataFrame, dict[str, int]]:
        source = raw_path(config.raw_root, dataset, config.file_format)
        text = extract_with_rejects(spark, source, dataset, config.file_format, config.multi_line)
        path = f"{folder}/{dataset.file_stem}"
        extracted = write_parquet(text, path)
        rows = spark.read.schema(text.schema).parquet(path)
        target = f"{config.processed_root.rstrip('/')}/rejected/{dataset.file_stem}"
        bad = rows.where(F.col(CORRUPT).isNotNull())
        refused = write_parquet(bad, target) if config.batch is None else replace_batch(bad, target, (), config.batch)
        return rows.drop(CORRUPT), {f"extracted/{dataset.name}": extracted, f"rejected/{dataset.file_stem}": refused}

    done = side_by_side(spark, {d.name: lambda d=d: stage(d) for d in RAW_DATASETS})
    counts = {name: n for _, some in done.values() for name, n in some.items()}
    return {name: rows for name, (rows, _) in done.items()}, counts


def stored_partials(spark: SparkSession, root: str, table: StatsTable, batches: Sequence[str]) -> DataFrame:
    """Partial sums of the given batches; reads no other rows than theirs."""
    schema = T.StructType([*partials_schema(spark, table), T.StructField(BATCH, T.StringType())])
    stored = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/partials/{table.name}")
    return stored.where(F.col(BATCH).isin(*batches)).drop(BATCH)


def _batch_outputs(raw: Mapping[str, DataFrame], root: str, batch: str, batches: Sequence[str]) -> dict[str, DataFrame]:
    """Detail rows of the batch, and statistics over all batches.

    The batch's partial sums are stored first; statistics follow from the stored sums of all batches. Velocity in the
    detail rows is filled with the mean of the batch, so that they do not depend on the other batches.
    """
    spark = raw["satellite"].sparkSession
    valid = valid_positions(raw["satellite"])
    rows = {SATELLITE_STATS: valid, COVERAGE_STATS: raw["coverage"], PERFORMANCE_STATS: raw["performance"]}
    store = lambda t: replace_batch(hourly_partials(rows[t], t), f"{root}/partials/{t.name}", (), batch)
    side_by_side(spark, {t.name: lambda t=t: store(t) for t in STATS_TABLES})
    mean = mean_velocity(stored_partials(spark, root, SATELLITE_STATS, [batch]))
    outputs = {"satellite": orbital_metrics(impute_velocity_mean(valid, F.lit(mean).cast("double")))}
    outputs |= {name: raw[name] for name in ("coverage", "performance")}
    for table in STATS_TABLES:
        merged = merged_partials(stored_partials(spark, root, table, batches), table)
        outputs[table.name] = stats_of_partials(merged, table)
    return outputs


def run_batch(spark: SparkSession, config: BatchConfig) -> dict[str, int]:
    """Run all three steps and return the rows per output, and of the raw datasets and their rejects.

    Raises on any failure. Counts come along with the passes that are made anyway; for Parquet input the
    raw rows are not counted. A run with a batch that failed, or whose input was corrected, is simply run again under the
    same name; the ledger (see ``ledger``) says which batches are complete. Hours that several batches have rows of get
    the statistics of all of them, from stored partial sums; the database keeps the first values of an hour.
    """
    use_utc(spark)
    shared_folder(spark)
    root, batch = config.processed_root.rstrip("/"), config.batch
    if batch is None and ledger.states(spark, root):
        raise ValueError(f"{root} holds results of batches: name one, or write elsewhere")
    before = ledger.begin(spark, root, batch) if batch is not None else {}
    for name in sorted(n for n, state in before.items() if state != ledger.PUBLISHED and n != batch):
        log.warning("batch %s under %s is not complete: run it again", name, root)
    folder = fresh_folder(spark, "raw")
    try:
        raw, counts = _staged(spark, config, folder)
        require_nonempty(raw)
        if batch is None:
            outputs = transform_all(raw, cut=lambda df: df.checkpoint())
        else:
            outputs = _batch_outputs(raw, root, batch, ledger.countable(before, batch))
        counts |= load_all(outputs, root, config.database, config.gather, batch)
    finally:
        if config.file_format.lower() != "parquet":
            for dataset in RAW_DATASETS:
                emptied(spark, f"{folder}/{dataset.file_stem}")
    if batch is not None:
        ledger.publish(spark, root, batch, counts)
    log.info("rows: %s", counts)
    return counts
