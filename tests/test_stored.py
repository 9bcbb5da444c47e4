"""Indexes of file times, counts from footers, tables stored by key."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.views import coverage, performance, raw_inputs
from perigee.operators.joins import align_region, full_outer_by_key
from perigee.plans import reconcile
from perigee.plans.batch import BatchConfig, run_batch
from perigee.sinks.keyed import full_outer_stored, store_by_key
from perigee.sinks.parquet import write_parquet
from perigee.sinks.raw_export import export_raw
from perigee.sources import time_ranges
from tests.conftest import SF_SMALL, plan, rows

KINDS = {
    "zoned": "t",
    "zoneless": "CAST(t AS timestamp_ntz)",
    "text": "date_format(t, \"yyyy-MM-dd'T'HH:mm:ssXXX\")",
}


def timed(spark, kind):
    hours = spark.range(240).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("t"))
    return hours.select("id", F.expr(KINDS[kind]).alias("t"))


@pytest.mark.parametrize("kind", KINDS)
def test_scan_reads_only_files_that_reach_the_bound(spark, tmp_path, kind):
    path, index, since = str(tmp_path / "data"), str(tmp_path / "index"), "2024-01-09 12:00:00"
    timed(spark, kind).repartitionByRange(10, "id").write.parquet(path)
    assert time_ranges.index_times(spark, path, "t", index) == 10
    assert time_ranges.index_times(spark, path, "t", index) == 0
    df = time_ranges.scan_since(spark, path, index, "t", since)
    assert sorted(r.id for r in df.collect()) == list(range(204, 240))
    assert len(df.inputFiles()) == 2 and spark.read.parquet(*df.inputFiles()).count() == 48
    # a file that the index does not know is read until it is entered
    timed(spark, kind).where("id < 3").coalesce(1).write.mode("append").parquet(path)
    assert len(time_ranges.files_since(spark, path, index, since)) == 3
    assert time_ranges.index_times(spark, path, "t", index) == 1
    assert len(time_ranges.files_since(spark, path, index, since)) == 2
    assert time_ranges.scan_since(spark, path, index, "t", "2025-01-01").count() == 0


def test_time_index_of_partitioned_folders_and_missing_times(spark, tmp_path):
    path, index = str(tmp_path / "data"), str(tmp_path / "index")
    df = timed(spark, "zoneless").withColumn("region", F.concat(F.lit("a b/"), F.col("id") % 3))
    df = df.withColumn("t", F.when(F.col("id") % 7 != 0, F.col("t")))
    write_parquet(df, path, ["region"])
    write_parquet(df.where("id < 0"), path, mode="append", partition_by=["region"])
    assert time_ranges.index_times(spark, path, "t", index) == 3
    found = time_ranges.scan_since(spark, path, index, "t", "2024-01-10 00:00:00")
    assert rows(found.select("id", "region")) == rows(df.where("t >= '2024-01-10'").select("id", "region"))
    other = timed(spark, "zoneless").where("id < 5").select("id", F.lit(None).cast("timestamp_ntz").alias("t"), F.lit("none").alias("region"))
    write_parquet(other, path, ["region"], mode="append")
    assert time_ranges.index_times(spark, path, "t", index) == 1
    assert len(time_ranges.files_since(spark, path, index, "2024-01-01")) == 3


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "data")
    write_parquet(coverage(spark, SF_SMALL).withColumn("batch", F.lit("01")), path, ["region_id", "batch"])
    counts = reconcile.footer_counts(spark, path, ["region_id", "batch"])
    text = plan(counts)
    assert "PushedAggregation: [COUNT(*)]" in text and "BatchScan" in text
    assert rows(counts) == rows(coverage(spark, SF_SMALL).groupBy("region_id").agg(F.lit("01"), F.count("*")))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    write_parquet(coverage(spark, SF_SMALL), str(tmp_path / "plain"))
    assert reconcile.footer_counts(spark, str(tmp_path / "plain")).first().row_count == coverage(spark, SF_SMALL).count()


def test_a_lost_file_shows_in_the_counts(spark, tmp_path):
    inputs, out = raw_inputs(spark, SF_SMALL), tmp_path / "out"
    export_raw({n: df.where("day(timestamp) = 3") for n, df in inputs.items()}, str(tmp_path / "raw"), "parquet")
    run_batch(spark, BatchConfig(str(tmp_path / "raw"), str(out), "parquet", batch="3"))
    counts = {r.output: (r.entered, r.held) for r in reconcile.reconciled(spark, str(out)).collect()}
    assert set(counts) == {"satellite", "coverage", "performance"} and all(a == b > 0 for a, b in counts.values())
    next(Path(out / "coverage_data").rglob("*.parquet")).unlink()
    entered, held = {r.output: (r.entered, r.held) for r in reconcile.reconciled(spark, str(out)).collect()}["coverage"]
    assert entered > held


def sides(spark):
    left = align_region(coverage(spark, SF_SMALL)).drop("event_id")
    right = performance(spark, SF_SMALL).drop("event_id")
    odd = F.when(F.second("ts") % 5 != 0, F.col("region"))
    return left.withColumn("region", odd), right.withColumn("region", odd).withColumn("ts", F.when(F.minute("ts") % 7 != 0, F.col("ts")))


def test_join_of_stored_tables_moves_nothing_and_reads_each_once(spark, tmp_path):
    left, right = sides(spark)
    key = ("region", "ts")
    tables = [store_by_key(df, f"stored_{n}", str(tmp_path / n), key, 4) for n, df in (("left", left), ("right", right))]
    joined = full_outer_stored(spark, *tables)
    text = plan(joined)
    assert "Exchange" not in text and text.count("Scan parquet spark_catalog") == 2 and text.count("SortMergeJoin") == 1
    assert rows(joined) == rows(full_outer_by_key(left, right, key).select(*joined.columns))
    with pytest.raises(ValueError, match="buckets"):
        full_outer_stored(spark, tables[0], store_by_key(right, "stored_other", str(tmp_path / "other"), key, 5))
    with pytest.raises(ValueError, match="both sides"):
        full_outer_stored(spark, tables[0], tables[0])


def test_tables_stored_by_key_are_replaced(spark, tmp_path):
    left, _ = sides(spark)
    for part in (left, left.where("satellite_count = 3")):
        table = store_by_key(part, "stored_again", str(tmp_path / "again"), ("region", "ts"), 3)
        assert table.rows(spark).count() + table.without_key(spark).count() == part.count()
