"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.views import coverage, performance, portable, raw_inputs, telemetry
from perigee.functions import expressions as ex
from perigee.functions.times import date_parts, hour_start, hours_before, latest
from perigee.model import (
    COVERAGE,
    COVERAGE_STATS,
    CREATED_AT,
    PERFORMANCE,
    PERFORMANCE_STATS,
    RAW_DATASETS,
    SATELLITE,
    SATELLITE_STATS,
    STATS_TABLES,
    WINDOW_END,
    WINDOW_START,
)
from perigee.operators import cleaning, joins, partials, quarantine, rollups, serving, spine
from perigee.plans.batch import BatchConfig, load_all, run_batch, side_by_side, stored_partials
from perigee.plans.reconcile import reconciled
from perigee.plans.transform import transform_all
from perigee.session import fresh_folder, shared_folder, use_utc
from perigee.sinks.keyed import full_outer_stored, store_by_key
from perigee.sinks.parquet import append_absent, observed_rows, replace_batch, write_parquet
from perigee.sinks.raw_export import export_raw
from perigee.sources import files, processed, raw
from perigee.sources.time_ranges import index_times
from perigee.sources.time_ranges import scan_since as files_scan_since

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH_HOURS = 720


def query(build: Query) -> Query:
    """Register under the function's name; results come in portable types, in a UTC session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return portable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def six_places(column: str):
    return F.round(F.col(column).cast("decimal(20,8)"), 6).cast("double").alias(column)


# ---- inputs shared by the queries below


def cleaned(spark, sf):
    return cleaning.clean_satellite(telemetry(spark, sf))


def latest_hour(df):
    return latest(df.select(hour_start(F.col("ts")).alias("h")), "h")


def typed_stats(spark, sf, table, hours=None):
    """A statistics table in its serving types and its newest window start. With ``hours``, the
    rollup reads only the rows a report over that span can need."""
    view, build = {
        SATELLITE_STATS: (telemetry, None),
        COVERAGE_STATS: (coverage, rollups.hourly_coverage_stats),
        PERFORMANCE_STATS: (performance, rollups.hourly_performance_stats),
    }[table]
    rows = view(spark, sf)
    if build is None:
        rows = cleaning.valid_positions(rows)
        as_of = latest_hour(rows)
        stats = rollups.stats_from_partials(rollups.velocity_partials(rows, "ts"))
    else:
        as_of = latest_hour(rows)
        since = hours_before(as_of, hours, T.TimestampNTZType()) if hours else None
        stats = build(rows, "ts", since)
    return rollups.cast_stats_types(stats, table, created_at=False), as_of


def stored_stats(spark, sf, *tables):
    """Statistics tables rolled up once, written and scanned, as reports read them, and the newest window
    start among them, a literal."""
    root = fresh_folder(spark, "stats")

    def store(table):
        write_parquet(typed_stats(spark, sf, table)[0], f"{root}/{table.name}")
        scan = processed.scan_stats(spark, root, table).drop(CREATED_AT)
        scan = scan.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (WINDOW_START, WINDOW_END)})
        return scan, scan.agg(F.max(WINDOW_START)).first()[0]

    done = side_by_side(spark, {t.name: lambda t=t: store(t) for t in tables})
    scans, newest = zip(*(done[t.name] for t in tables), strict=True)
    return *scans, max(n for n in newest if n)


def counted(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("dataset"), "row_count")
        for n, df in frames.items()
    ]
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def count_rows_frame(spark, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "dataset string, row_count bigint")


# ---- sources


@query
def scan_csv(spark, sf):
    root = fresh_folder(spark, "scan-csv")
    export_raw({"satellite": raw_inputs(spark, sf)["satellite"]}, root, "csv")
    return files.scan_csv(spark, raw.raw_path(root, SATELLITE, "csv"), SATELLITE.schema)


@query
def scan_json(spark, sf):
    root = fresh_folder(spark, "scan-json")
    export_raw({"coverage": raw_inputs(spark, sf)["coverage"]}, root, "json")
    path = raw.raw_path(root, COVERAGE, "json")
    return files.scan_json(spark, path, COVERAGE.schema)


@query
def scan_parquet(spark, sf):
    root = fresh_folder(spark, "scan-parquet")
    export_raw({"performance": raw_inputs(spark, sf)["performance"]}, root, "parquet")
    return files.scan_parquet(
        spark, raw.raw_path(root, PERFORMANCE, "parquet"), PERFORMANCE.schema
    )


@query
def conform_schema(spark, sf):
    text = coverage(spark, sf).withColumnRenamed("ts", "timestamp")
    text = text.select(*(F.col(c).cast("string").alias(c) for c in reversed(text.columns)))
    return files.conform_schema(text, COVERAGE.schema)


@query
def extract_satellite(spark, sf):
    root = fresh_folder(spark, "extract-satellite")
    export_raw({"satellite": raw_inputs(spark, sf)["satellite"]}, root, "CSV")
    return raw.extract_satellite(spark, raw.raw_path(root, SATELLITE, "CSV"), "CSV")


@query
def extract_coverage(spark, sf):
    root = fresh_folder(spark, "extract-coverage")
    export_raw({"coverage": raw_inputs(spark, sf)["coverage"]}, root, "Parquet")
    return raw.extract_coverage(spark, raw.raw_path(root, COVERAGE, "Parquet"), "Parquet")


@query
def extract_performance(spark, sf):
    root = fresh_folder(spark, "extract-performance")
    export_raw({"performance": raw_inputs(spark, sf)["performance"]}, root, "Json")
    path = raw.raw_path(root, PERFORMANCE, "Json")
    return raw.extract_performance(spark, path, "Json")


@query
def extract_all(spark, sf):
    root = fresh_folder(spark, "extract-all")
    export_raw(raw_inputs(spark, sf), root, "csv")
    return counted(raw.extract_all(spark, root, "csv"))


def in_full(frames: dict[str, DataFrame], **columns: str) -> DataFrame:
    """Rows of several datasets in one frame: whose they are, and each row as text of its values."""
    parts = [
        df.select(
            F.lit(name).alias("dataset"),
            *(F.lit(v).alias(c) for c, v in columns.items()),
            F.concat_ws("|", *(F.coalesce(_plain(df, c), F.lit("-")) for c in sorted(df.columns))).alias("row"),
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.union, parts)


def _plain(df: DataFrame, column: str):
    """A value as text that both engines write alike: numbers with six places, times by the second."""
    kind, value = dict(df.dtypes)[column], F.col(column)
    if kind.startswith(("double", "decimal", "int", "bigint")):
        return value.cast("decimal(30,6)").cast("string")
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else value


@query
def extract_all_json(spark, sf):
    """JSON on default arguments, all three datasets in full."""
    root = fresh_folder(spark, "extract-json")
    export_raw(raw_inputs(spark, sf), root, "json")
    return in_full(raw.extract_all(spark, root, "json"))


@query
def require_nonempty(spark, sf):
    return counted(raw.require_nonempty(raw_inputs(spark, sf)))


@query
def scan_rejects(spark, sf):
    """Faults in three columns, alone and together; rows without a key are read like any other."""
    path = fresh_folder(spark, "rejects")
    bad = lambda every, text, good: F.when(F.col("event_id") % every == 0, text).otherwise(good)
    lines = telemetry(spark, sf).select(
        F.concat_ws(
            ",",
            F.coalesce("satellite_id", F.lit("")),
            bad(11, "yesterday", F.col("ts").cast("string")),
            F.lit("1"),
            bad(5, "east", F.lit("2")),
            bad(7, "n/a", F.col("altitude").cast("int").cast("string")),
            F.lit("7"),
            F.lit("online"),
        )
    )
    lines.write.text(path)
    return files.scan_rejects(spark, path, SATELLITE.schema, "csv", header=False)


@query
def scan_stats(spark, sf):
    root = fresh_folder(spark, "stats")
    stats, _ = typed_stats(spark, sf, COVERAGE_STATS)
    write_parquet(stats, f"{root}/{COVERAGE_STATS.name}")
    return processed.scan_stats(spark, root, COVERAGE_STATS).select(*COVERAGE_STATS.columns)


@query
def read_satellite(spark, sf):
    root = fresh_folder(spark, "satellite")
    load_all({"satellite": raw_inputs(spark, sf)["satellite"]}, root)
    kept = processed.read_satellite(spark, root, "2024-01-10 06:30:00", "2024-01-20 18:00:00")
    return kept.select(*SATELLITE.schema.names, "year", "month", "day")


def record_arrays(spark, sf, joint: str, text):
    """A folder of JSON arrays, one for each day of coverage: records as ``text`` has them, ``joint`` between them."""
    path = fresh_folder(spark, "arrays")
    days = coverage(spark, sf).select(F.to_date("ts").alias("d"), "event_id", text.alias("record")).groupBy("d")
    parts = days.agg(F.array_sort(F.collect_list(F.struct("event_id", "record"))).alias("r"))
    array = F.concat(F.lit("["), F.array_join(F.transform("r", lambda r: r["record"]), joint), F.lit("]"))
    parts.select(array).write.text(path)
    return path


@query
def scan_json_arrays(spark, sf):
    """Arrays on one line and arrays spread over many lines, side by side in one folder, read in ranges of bytes."""
    columns = {f.name: F.col("ts" if f.name == "timestamp" else f.name) for f in COVERAGE.schema}
    record = F.to_json(F.struct(*(c.alias(n) for n, c in columns.items())), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    spread = F.regexp_replace(record, ',"', ',\n    "')
    parts = [record_arrays(spark, sf, ",", record), record_arrays(spark, sf, ",\n  ", spread)]
    frames = [files.scan_json(spark, p, COVERAGE.schema) for p in parts]
    return frames[0].unionByName(frames[1])


@query
def scan_rejects_json(spark, sf):
    """Records of arrays with a cell of another type, and broken ones: each reject with its own text."""
    bad = F.when(F.col("event_id") % 11 == 0, '"n/a"').when(F.col("event_id") % 7 == 0, "").otherwise("50.5")
    text = F.concat(F.lit('{"satellite_count": '), "satellite_count", F.lit(', "region_id": "'), "region_id", F.lit('", "coverage_percentage": '), bad, F.lit("}"))
    path = record_arrays(spark, sf, ", ", text)
    return files.scan_rejects(spark, path, COVERAGE.schema, "json").select("_corrupt_record")


# ---- filters

_POSITION = ("event_id", "satellite_id", "latitude", "longitude", "altitude")


@query
def filter_required_key(spark, sf):
    return cleaning.filter_required_key(telemetry(spark, sf)).select(*_POSITION)


@query
def filter_latitude(spark, sf):
    return cleaning.filter_latitude(telemetry(spark, sf)).select(*_POSITION)


@query
def filter_longitude(spark, sf):
    return cleaning.filter_longitude(telemetry(spark, sf)).select(*_POSITION)


@query
def filter_altitude(spark, sf):
    return cleaning.filter_altitude(telemetry(spark, sf)).select(*_POSITION)


@query
def filter_recent(spark, sf):
    rows = coverage(spark, sf)
    return serving.filter_recent(rows, 24, latest(rows, "ts"), "ts")


@query
def scan_since(spark, sf):
    """The last three days, by an index of the times in each file: rows in order of time, in several files."""
    path, index = fresh_folder(spark, "times"), fresh_folder(spark, "time-index")
    rows = coverage(spark, sf)
    rows.repartitionByRange(8, "ts").write.parquet(path)
    index_times(spark, path, "ts", index)
    return files_scan_since(spark, path, index, "ts", hours_before(latest(rows, "ts"), 72, T.TimestampType()))


@query
def filter_region(spark, sf):
    return serving.filter_region(coverage(spark, sf), "EU", "region_id")


@query
def clean_satellite(spark, sf):
    rows = cleaned(spark, sf)
    return rows.withColumns({"velocity": six_places("velocity")})


@query
def quarantine_stats(spark, sf):
    candidates = coverage(spark, sf).select(
        F.when(F.col("event_id") % 23 != 0, F.col("region_name")).alias("region_id"),
        hour_start(F.col("ts")).alias(WINDOW_START),
        rollups.window_end(hour_start(F.col("ts"))).alias(WINDOW_END),
        F.col("coverage_percentage").alias("avg_coverage_percentage"),
        (F.col("coverage_percentage") * 11).alias("max_coverage_percentage"),
        F.col("coverage_percentage").alias("min_coverage_percentage"),
        F.col("satellite_count").cast("double").alias("avg_satellite_count"),
        F.col("satellite_count").alias("max_satellite_count"),
        "avg_signal_strength",
    )
    return quarantine.quarantine_stats(candidates, COVERAGE_STATS)


# ---- projections


@query
def normalize_status(spark, sf):
    return telemetry(spark, sf).select("event_id", ex.normalize_status(F.col("status")).alias("status"))


@query
def orbital_period(spark, sf):
    return telemetry(spark, sf).select("event_id", ex.orbital_period().alias("orbital_period_minutes"))


@query
def ground_track_velocity(spark, sf):
    speed = ex.ground_track_velocity(F.col("altitude"), ex.orbital_period())
    return telemetry(spark, sf).select("event_id", speed.alias("ground_track_velocity_kmh"))


@query
def coverage_radius(spark, sf):
    radius = ex.coverage_radius(F.col("altitude"))
    return telemetry(spark, sf).select("event_id", radius.alias("estimated_coverage_radius_km"))


@query
def orbital_metrics(spark, sf):
    return cleaning.orbital_metrics(cleaning.valid_positions(telemetry(spark, sf)))


@query
def flatten_window(spark, sf):
    rows = coverage(spark, sf).select("event_id", F.window("ts", "1 hour").alias("time_window"))
    return rollups.flatten_window(rows)


@query
def date_parts_of_rows(spark, sf):
    return telemetry(spark, sf).select("event_id", "ts").withColumns(date_parts(F.col("ts")))


@query
def cast_stats_types(spark, sf):
    stats, _ = typed_stats(spark, sf, PERFORMANCE_STATS)
    texts = {m.name: F.col(m.name).cast("string") for m in PERFORMANCE_STATS.measures}
    return stats.withColumns(texts)


@query
def align_region(spark, sf):
    return joins.align_region(coverage(spark, sf))


@query
def null_to_zero(spark, sf):
    value = ex.null_to_zero(F.col("coverage_percentage"))
    return coverage(spark, sf).select("event_id", value.alias("coverage_percentage"))


@query
def orbital_velocity(spark, sf):
    rows = cleaning.valid_positions(telemetry(spark, sf))
    rows = rows.withColumn("orbital_velocity_kms", ex.orbital_velocity(F.col("altitude")))
    return rows.select("event_id", "velocity", six_places("orbital_velocity_kms"))


@query
def diurnal_adjust(spark, sf):
    rows = cleaning.diurnal_adjust(performance(spark, sf), "ts")
    return rows.select("event_id", six_places("base_latency_ms"), six_places("base_throughput_mbps"))


@query
def round_half_up_2(spark, sf):
    value = ex.round_half_up_2(F.col("latency_ms") / F.lit(8.0))
    return performance(spark, sf).select("event_id", value.alias("rounded"))


# ---- aggregations


@query
def impute_velocity_mean(spark, sf):
    return cleaning.impute_velocity_mean(telemetry(spark, sf)).select(
        "event_id", six_places("velocity")
    )


@query
def hourly_coverage_stats(spark, sf):
    return rollups.hourly_coverage_stats(coverage(spark, sf), "ts")


@query
def hourly_performance_stats(spark, sf):
    return rollups.hourly_performance_stats(performance(spark, sf), "ts")


@query
def hourly_satellite_stats(spark, sf):
    """Over cleaned rows, filling velocity within the same single pass."""
    valid = cleaning.valid_positions(telemetry(spark, sf))
    return rollups.stats_from_partials(rollups.velocity_partials(valid, "ts"))


@query
def hourly_satellite_stats_of_clean_rows(spark, sf):
    return rollups.hourly_satellite_stats(cleaned(spark, sf), "ts")


@query
def hourly_stats_of_batches(spark, sf):
    """All three statistics tables from stored partial sums of three batches that share every hour."""
    inputs, root = raw_inputs(spark, sf), fresh_folder(spark, "partials")
    inputs["satellite"] = cleaning.valid_positions(inputs["satellite"])
    stats = {}
    for (name, rows), table in zip(inputs.items(), STATS_TABLES, strict=True):
        for k in range(3):
            part = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == k)
            replace_batch(partials.hourly_partials(part, table), f"{root}/partials/{table.name}", (), f"b{k}")
        merged = partials.merged_partials(stored_partials(spark, root, table, ["b0", "b1", "b2"]), table)
        stats[table.name] = rollups.cast_stats_types(partials.stats_of_partials(merged, table), table, created_at=False)
    return in_full(stats)


@query
def status_counts(spark, sf):
    rows = cleaning.valid_positions(telemetry(spark, sf))
    return rows.agg(
        *(
            rollups.status_count(s).alias(f"{s}_count")
            for s in ("operational", "maintenance", "standby", "unknown")
        )
    )


@query
def fleet_summary(spark, sf):
    stats, as_of = stored_stats(spark, sf, SATELLITE_STATS)
    return serving.fleet_summary(stats, 24, as_of)


@query
def coverage_by_region(spark, sf):
    stats, as_of = stored_stats(spark, sf, COVERAGE_STATS)
    return serving.coverage_by_region(stats, 24, as_of)


@query
def performance_by_region(spark, sf):
    stats, as_of = stored_stats(spark, sf, PERFORMANCE_STATS)
    return serving.performance_by_region(stats, 24, as_of)


def _sections(spark, sf):
    *tables, as_of = stored_stats(spark, sf, *STATS_TABLES)
    return serving.summary_sections(*tables, hours=24, as_of=as_of)


@query
def dashboard_summary(spark, sf):
    return serving.dashboard_summary_rows(_sections(spark, sf))


@query
def dashboard_summary_nested(spark, sf):
    """The nested row with all three sections, unfolded again so that engines can be compared."""
    nested = serving.dashboard_summary(_sections(spark, sf))
    nested = nested.withColumn("c", F.explode("coverage")).withColumn("p", F.explode("performance"))
    nested = nested.where("c.region = p.region")
    return nested.select("satellite.*", "c.*", F.col("p").dropFields("region").alias("p")).select("*", "p.*").drop("p")


@query
def row_counts(spark, sf):
    """Counts that come along with the one pass that writes the cleaned rows."""
    before, extracted = observed_rows(telemetry(spark, sf), "extracted")
    written = write_parquet(cleaning.valid_positions(before), fresh_folder(spark, "clean"))
    return count_rows_frame(spark, {"extracted": extracted.get["rows"], "cleaned": written})


@query
def row_counts_reconciled(spark, sf):
    """Rows of each output of a batch by the ledger and by the footers of its files."""
    root = fresh_folder(spark, "reconcile")
    export_raw(raw_inputs(spark, sf), f"{root}/raw", "csv")
    run_batch(spark, BatchConfig(f"{root}/raw", f"{root}/processed", batch="month"))
    return reconciled(spark, f"{root}/processed")


@query
def distinct_regions(spark, sf):
    return serving.distinct_regions(coverage(spark, sf), "region_id")


# ---- joins


@query
def join_coverage_performance(spark, sf):
    return joins.join_coverage_performance(
        coverage(spark, sf).drop("event_id"), performance(spark, sf).drop("event_id"), "ts"
    )


@query
def join_stored_coverage_performance(spark, sf):
    """The full outer join of tables stored by region and time, without a shuffle; some rows have no region."""
    root = fresh_folder(spark, "keyed")
    name, key, buckets = f"keyed_{root.rsplit('-', 1)[1]}", ("region", "ts"), 8
    no_region = F.when(F.col("event_id") % 41 != 0, F.col("region")).alias("region")
    sides = []
    for side, rows in (("coverage", joins.align_region(coverage(spark, sf))), ("performance", performance(spark, sf))):
        rows = rows.select(no_region, *(c for c in rows.columns if c not in ("event_id", "region")))
        sides.append(store_by_key(rows, f"{name}_{side}", f"{root}/{side}", key, buckets))
    return full_outer_stored(spark, *sides)


@query
def dashboard_view(spark, sf):
    return joins.dashboard_view(
        typed_stats(spark, sf, COVERAGE_STATS)[0], typed_stats(spark, sf, PERFORMANCE_STATS)[0]
    )


@query
def region_coverage_from_positions(spark, sf):
    return joins.region_coverage_from_positions(telemetry(spark, sf), time_col="ts", hourly=True)


@query
def region_coverage_of_crowded_regions(spark, sf):
    """A region for each customer, all within four degrees, and the positions of each day."""
    key = F.col("c_custkey")
    places = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.concat(F.lit("C"), key.cast("string")).alias("region_id"),
        F.col("c_name").alias("region_name"),
        (F.lit(30.0) + (key * 37 % 1000).cast("double") / 500.0).alias("latitude"),
        (F.lit(10.0) + (key * 91 % 1009).cast("double") / 300.0).alias("longitude"),
    )
    days = telemetry(spark, sf).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return joins.region_coverage_from_positions(days, places, time_col="ts")


@query
def insert_absent_rows(spark, sf):
    """Single observations as the batch (many per key), rows of the first half held already."""
    batch = coverage(spark, sf).select(
        "region_id",
        hour_start(F.col("ts")).alias(WINDOW_START),
        "coverage_percentage",
        "satellite_count",
        "avg_signal_strength",
    )
    held = batch.where(F.col(WINDOW_START) < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return joins.insert_absent_rows(batch, held, ["region_id", WINDOW_START])


def _spine(spark, sf):
    rows = coverage(spark, sf)
    hours = rows.select("region_id", hour_start(F.col("ts")).alias(WINDOW_START))
    return spine.time_spine(
        serving.distinct_regions(hours, "region_id"),
        hours.agg(F.min(WINDOW_START)).scalar(),
        hours.agg(F.max(WINDOW_START)).scalar(),
        60,
        WINDOW_START,
        T.TimestampNTZType(),
    ), hours


@query
def time_spine(spark, sf):
    return _spine(spark, sf)[0]


@query
def missing_windows(spark, sf):
    grid, hours = _spine(spark, sf)
    return spine.missing_windows(grid, hours.distinct(), ["region_id"])


# ---- reports


@query
def recent_satellite_stats(spark, sf):
    stats, as_of = stored_stats(spark, sf, SATELLITE_STATS)
    return serving.recent_satellite_stats(stats, MONTH_HOURS, as_of)


@query
def recent_coverage_region(spark, sf):
    stats, as_of = stored_stats(spark, sf, COVERAGE_STATS)
    return serving.recent_coverage(stats, "EU", MONTH_HOURS, as_of)


@query
def recent_coverage_all(spark, sf):
    stats, as_of = stored_stats(spark, sf, COVERAGE_STATS)
    return serving.recent_coverage(stats, None, MONTH_HOURS, as_of)


@query
def recent_performance_region(spark, sf):
    stats, as_of = stored_stats(spark, sf, PERFORMANCE_STATS)
    return serving.recent_performance(stats, "AS", MONTH_HOURS, as_of)


@query
def recent_performance_all(spark, sf):
    stats, as_of = stored_stats(spark, sf, PERFORMANCE_STATS)
    return serving.recent_performance(stats, None, MONTH_HOURS, as_of)


@query
def coverage_series(spark, sf):
    stats, as_of = stored_stats(spark, sf, COVERAGE_STATS)
    series = serving.coverage_series(serving.recent_coverage(stats, None, 48, as_of, limit=None))
    return series.select("region_id", F.posexplode("points").alias("position", "point")).select(
        "region_id", "position", f"point.{WINDOW_START}", "point.avg_coverage_percentage"
    )


@query
def performance_trend(spark, sf):
    stats, as_of = stored_stats(spark, sf, PERFORMANCE_STATS)
    return serving.performance_trend(serving.recent_performance(stats, None, MONTH_HOURS, as_of, limit=None))


# ---- sinks, read back


@query
def write_parquet_partitioned(spark, sf):
    path = fresh_folder(spark, "write")
    write_parquet(coverage(spark, sf), path, ["region_id"])
    return spark.read.parquet(path)


@query
def write_modes(spark, sf):
    """Overwrite, append, then ignore: each row is held twice."""
    path, rows = fresh_folder(spark, "modes"), performance(spark, sf)
    for mode in ("overwrite", "append", "ignore"):
        write_parquet(rows, path, mode=mode)
    return spark.read.parquet(path)


@query
def processed_layout(spark, sf):
    root = fresh_folder(spark, "layout")
    inputs = raw_inputs(spark, sf)
    load_all(inputs, root)
    satellite = spark.read.parquet(f"{root}/satellite_data").groupBy("year", "month", "day").count()
    per_folder = satellite.select(
        F.lit("satellite_data").alias("dataset"),
        F.concat_ws("-", "year", "month", "day").alias("folder"),
        F.col("count").alias("row_count"),
    )
    for dataset in (COVERAGE, PERFORMANCE):
        (column,) = dataset.layout
        counts = spark.read.parquet(f"{root}/{dataset.file_stem}").groupBy(column).count()
        per_folder = per_folder.union(
            counts.select(F.lit(dataset.file_stem), F.col(column), F.col("count"))
        )
    return per_folder


@query
def append_absent_twice(spark, sf):
    """A first load up to mid-month with latencies off by one, then the whole month: hours held
    already keep their first values."""
    path = fresh_folder(spark, "absent")
    stats, _ = typed_stats(spark, sf, PERFORMANCE_STATS)
    mid = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    shifted = (F.col("avg_latency_ms") + 1).cast("decimal(10,2)")
    early = stats.where(F.col(WINDOW_START) < mid).withColumn("avg_latency_ms", shifted)
    append_absent(early, path, PERFORMANCE_STATS)
    append_absent(stats, path, PERFORMANCE_STATS)
    return spark.read.schema(stats.schema).parquet(path)


@query
def load_all_outputs(spark, sf):
    """Everything the load writes, read back in full."""
    root = fresh_folder(spark, "load")
    load_all(transform_all(raw_inputs(spark, sf)), root)
    return in_full(written_outputs(spark, root))


def written_outputs(spark, root):
    satellite = processed.read_satellite(spark, root).select(*transform_columns())
    outputs = {"satellite": satellite.withColumn("velocity", F.round("velocity", 6))}
    outputs |= {d.name: processed.read_regional(spark, root, d) for d in (COVERAGE, PERFORMANCE)}
    return outputs | {t.name: processed.scan_stats(spark, root, t).drop(CREATED_AT) for t in STATS_TABLES}


def transform_columns():
    metrics = ("orbital_period_minutes", "ground_track_velocity_kmh", "estimated_coverage_radius_km")
    return (*SATELLITE.schema.names, *metrics)


@query
def export_raw_round_trip(spark, sf):
    """All three datasets through all three formats, read on default arguments."""
    root = fresh_folder(spark, "export")
    inputs = raw_inputs(spark, sf)
    parts = []
    for file_format in ("csv", "json", "parquet"):
        export_raw(inputs, f"{root}/{file_format}", file_format)
        back = raw.extract_all(spark, f"{root}/{file_format}", file_format)
        parts.append(in_full(back, file_format=file_format))
    return reduce(DataFrame.union, parts)


# ---- whole runs


@query
def transform_all_detail(spark, sf):
    """The satellite detail rows of the whole transformation."""
    rows = transform_all({"satellite": raw_inputs(spark, sf)["satellite"]})["satellite"]
    return rows.withColumns({"velocity": six_places("velocity")})


@query
def transform_all_outputs(spark, sf):
    """All six outputs of the whole transformation, in full."""
    outputs = transform_all(raw_inputs(spark, sf))
    outputs["satellite"] = outputs["satellite"].withColumn("velocity", F.round("velocity", 6))
    typed = {t.name: rollups.cast_stats_types(outputs[t.name], t, created_at=False) for t in STATS_TABLES}
    return in_full(outputs | typed)


@query
def batch_run(spark, sf):
    """From raw CSV files to processed Parquet; the result is everything written, in full."""
    shared_folder(spark)
    root = fresh_folder(spark, "batch")
    export_raw(raw_inputs(spark, sf), f"{root}/raw", "csv")
    run_batch(spark, BatchConfig(f"{root}/raw", f"{root}/processed"))
    return in_full(written_outputs(spark, f"{root}/processed"))


@query
def batch_run_repeated(spark, sf):
    """Two batches, the second with late rows of the first one's hours; a first attempt at the second with the wrong rows, then the
    right ones, then the first one again. The result is everything held, but for filled velocities."""
    root = fresh_folder(spark, "batches")
    late = F.col("minute") % 3 == 0
    for name, part in {"one": ~late, "two": late, "wrong": F.col("minute") % 3 == 1}.items():
        some = {n: df.withColumn("minute", F.minute("timestamp")).where(part).drop("minute") for n, df in raw_inputs(spark, sf).items()}
        export_raw(some, f"{root}/{name}", "json")
    for source, batch in (("one", "one"), ("wrong", "two"), ("two", "two"), ("one", "one")):
        run_batch(spark, BatchConfig(f"{root}/{source}", f"{root}/processed", "json", batch=batch))
    outputs = written_outputs(spark, f"{root}/processed")
    outputs["satellite"] = outputs["satellite"].drop("velocity")
    return in_full(outputs)
