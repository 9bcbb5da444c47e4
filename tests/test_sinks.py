from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from perigee.model import COVERAGE_STATS, PERFORMANCE_STATS, SATELLITE_STATS, STATS_TABLES
from perigee.operators.quarantine import accepted, quarantine_stats, rejected
from perigee.sinks import jdbc
from perigee.sinks.parquet import append_absent, with_date_parts, write_parquet
from tests.conftest import at, plan, rows

START, END = at("2024-01-01 10:00:00"), at("2024-01-01 11:00:00")


def coverage_stats(spark, *keys, **measures):
    """Rows of (region, hour, measure): every measure of a row has the same value."""
    df = spark.createDataFrame(list(keys), "region_id string, hour int, v double")
    start = F.lit(at("2024-01-01 00:00:00")) + F.make_dt_interval(hours=F.col("hour"))
    return df.select(
        "region_id", start.alias("time_window_start"), (start + F.make_dt_interval(hours=F.lit(1))).alias("time_window_end"),
        *(F.col("v").alias(m.name) for m in COVERAGE_STATS.measures),
    )


def test_write_counts_and_modes(spark, tmp_path):
    df, path = spark.range(10), str(tmp_path / "t")
    assert write_parquet(df, path) == 10
    assert write_parquet(df, path, mode="append") == 10
    assert write_parquet(df, path, mode="ignore") is None
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(df, path, mode="error")
    assert write_parquet(df.limit(3), path, mode="overwrite") == 3
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError, match="upsert"):
        write_parquet(df, path, mode="upsert")
    assert write_parquet(df.limit(0), path) == 0


def test_ignore_writes_where_nothing_is(spark, tmp_path):
    write_parquet(spark.range(4), str(tmp_path / "new"), mode="ignore")
    assert spark.read.parquet(str(tmp_path / "new")).count() == 4


def test_partitioned_write_gathers_small_folders_and_splits_a_big_one(spark, tmp_path, settings):
    settings(adaptive__advisoryPartitionSizeInBytes="64k", adaptive__coalescePartitions__minPartitionSize="16k", shuffle__partitions=64)
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("R"), F.col("id") % 7)).otherwise("hot").alias("region"),
        F.rand(1).alias("value"), F.rand(2).alias("other"),
    )
    assert write_parquet(df, str(tmp_path / "t"), ["region"]) == 60_000
    per_folder = {f.name: len(list(f.glob("*.parquet"))) for f in Path(tmp_path / "t").glob("region=*")}
    assert len(per_folder) == 8
    assert per_folder.pop("region=hot") > 2
    assert max(per_folder.values()) <= 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000
    write_parquet(df, str(tmp_path / "u"), ["region"], gather=False)
    assert len(list(Path(tmp_path / "u" / "region=R0").glob("*.parquet"))) == 8


def test_date_parts_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([("a", at("2024-01-31 23:00:00")), ("b", at("2024-02-01 00:00:00"))], "id string, timestamp timestamp")
    write_parquet(with_date_parts(df), str(tmp_path / "t"), ["year", "month", "day"])
    kept = spark.read.parquet(str(tmp_path / "t")).where("year = 2024 AND month = 2")
    assert [r.id for r in kept.collect()] == ["b"]
    assert "month#" in plan(kept).split("PartitionFilters: [")[1].split("]")[0]


def test_append_absent_is_idempotent_and_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    first = coverage_stats(spark, ("EU", 1, 1.0), ("EU", 2, 2.0))
    again = coverage_stats(spark, ("EU", 2, 9.0), ("EU", 3, 3.0), ("NA", 2, 4.0), ("NA", 2, 5.0))
    assert append_absent(first, path, COVERAGE_STATS) == 2
    assert append_absent(first, path, COVERAGE_STATS) == 0
    assert append_absent(again, path, COVERAGE_STATS) == 2
    got = rows(spark.read.parquet(path).select("region_id", F.hour("time_window_start"), "avg_coverage_percentage"))
    assert got == [("EU", 1, 1.0), ("EU", 2, 2.0), ("EU", 3, 3.0), ("NA", 2, 4.0)]


def test_append_absent_without_region(spark, tmp_path):
    df = coverage_stats(spark, ("EU", 1, 1.0)).drop("region_id")
    df = df.select("time_window_start", "time_window_end", *(F.lit(1).alias(m.name) for m in SATELLITE_STATS.measures))
    assert [append_absent(df, str(tmp_path / "t"), SATELLITE_STATS) for _ in range(2)] == [1, 0]


def test_quarantine(spark):
    df = coverage_stats(
        spark, ("EU", 1, 1.0), ("EU", 2, 2.0), ("EU", 2, 3.0), (None, 1, 1.0), ("ELEVENCHARS", 1, 1.0), ("TENLETTERS", 1, 999.99),
        ("NA", 1, 1000.0), ("NA", 1, 5.0), ("SA", 1, None), ("OC", 1, float("nan")),
    )
    judged = quarantine_stats(df, COVERAGE_STATS)
    assert judged.count() == 10
    assert rows(rejected(judged).groupBy("reject_reason").count()) == [
        ("duplicate_key", 2), ("null_key", 1), ("numeric_overflow", 2), ("region_too_long", 1),
    ]
    assert rows(accepted(judged).select("region_id", F.hour("time_window_start"))) == sorted(
        [("EU", 1), ("NA", 1), ("SA", 1), ("TENLETTERS", 1)]
    )
    assert accepted(judged).columns == df.columns


def test_quarantine_of_a_null_window(spark):
    df = coverage_stats(spark, ("EU", 1, 1.0)).withColumn("time_window_end", F.lit(None).cast("timestamp"))
    assert quarantine_stats(df, COVERAGE_STATS).first().reject_reason == "null_key"


def test_quarantine_splits_a_hot_key(spark, settings):
    from tests.conftest import final_plan

    settings(
        autoBroadcastJoinThreshold=-1, adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__skewJoin__skewedPartitionFactor=2, adaptive__advisoryPartitionSizeInBytes="10k",
    )
    base = spark.range(0, 20_000, 1, 6)
    hour = F.lit(START) + F.make_dt_interval(hours=F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id").cast("int")))
    df = base.select(
        F.lit("EU").alias("region_id"), hour.alias("time_window_start"), hour.alias("time_window_end"),
        *(F.rand(i).alias(m.name) for i, m in enumerate(COVERAGE_STATS.measures)),
    )
    judged = quarantine_stats(df, COVERAGE_STATS)
    assert "skew=true" in final_plan(judged)
    assert rejected(judged).count() == 6_667


def test_ddl():
    sql = jdbc.create_table_sql(COVERAGE_STATS)
    assert sql.startswith("CREATE TABLE IF NOT EXISTS coverage_statistics (region_id VARCHAR(10), ")
    assert "avg_coverage_percentage DECIMAL(5,2)" in sql and "max_satellite_count INT" in sql
    assert "created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP" in sql
    assert sql.endswith("PRIMARY KEY (region_id, time_window_start, time_window_end))")
    assert "PRIMARY KEY (time_window_start, time_window_end)" in jdbc.create_table_sql(SATELLITE_STATS)


def test_merge_statement_never_updates():
    sql = jdbc.insert_absent_sql(PERFORMANCE_STATS, "staging")
    assert sql.startswith("INSERT INTO performance_statistics (region, time_window_start,")
    assert "FROM staging" in sql and sql.endswith("ON CONFLICT DO NOTHING")


def test_jdbc_options_leave_out_what_is_not_set():
    target = jdbc.JdbcTarget.postgres("db.example", "telemetry", 5433, user="u")
    assert target.options("t") == {
        "url": "jdbc:postgresql://db.example:5433/telemetry", "dbtable": "t", "user": "u",
        "driver": "org.postgresql.Driver", "numPartitions": "8",
    }


def test_database_scans_are_cut_by_hours():
    target = jdbc.JdbcTarget("jdbc:any", connections=4)
    assert "partitionColumn" not in target.read_options("t")
    cut = target.read_options("t", (START, END))
    assert cut["partitionColumn"] == "time_window_start" and cut["numPartitions"] == "4"
    assert (cut["lowerBound"], cut["upperBound"]) == ("2024-01-01 10:00:00", "2024-01-01 11:00:00")


@pytest.mark.parametrize("table", STATS_TABLES, ids=lambda t: t.name)
def test_staged_load_order(spark, monkeypatch, table):
    """No database here: the steps are recorded instead."""
    steps = []
    monkeypatch.setattr(jdbc, "_write", lambda df, t, target, name, mode: steps.append((mode, name, df.columns)))
    target = jdbc.JdbcTarget("jdbc:postgresql://h/d", execute=steps.append)
    jdbc.load_jdbc_insert_absent(spark.createDataFrame([], table.schema), table, target)
    create, (mode, staging, columns), merge, drop = steps
    assert create == jdbc.create_table_sql(table)
    assert (mode, columns) == ("overwrite", table.schema.names)
    assert staging.startswith(f"{table.name}_staging_") and merge == jdbc.insert_absent_sql(table, staging)
    assert drop == f"DROP TABLE IF EXISTS {staging}"


def test_staging_is_dropped_after_a_failure(spark, monkeypatch):
    steps = []

    def fail(*_):
        raise RuntimeError("connection lost")

    monkeypatch.setattr(jdbc, "_write", fail)
    target = jdbc.JdbcTarget("jdbc:postgresql://h/d", execute=steps.append)
    with pytest.raises(RuntimeError, match="connection lost"):
        jdbc.load_jdbc_insert_absent(spark.createDataFrame([], COVERAGE_STATS.schema), COVERAGE_STATS, target)
    assert [s.split()[0] for s in steps] == ["CREATE", "DROP"]


def test_portable_load_appends_absent_rows_only(spark, monkeypatch):
    """No database here: a frame stands for the table."""
    typed = coverage_stats(spark, ("EU", 1, 1.0), ("EU", 2, 2.0)).withColumn("created_at", F.current_timestamp())
    held, writes = coverage_stats(spark, ("EU", 1, 7.0)), []
    monkeypatch.setattr(jdbc, "_held_keys", lambda batch, t, target: held.select(*t.key))
    monkeypatch.setattr(jdbc, "_write", lambda df, t, target, name, mode: writes.append((name, mode, df.count())))
    jdbc.load_jdbc_insert_absent(typed, COVERAGE_STATS, jdbc.JdbcTarget("jdbc:any"))
    assert writes == [("coverage_statistics", "append", 1)]


def test_portable_load_needs_a_table(spark, monkeypatch):
    def missing(*_):
        raise RuntimeError("no such table")

    writes = []
    monkeypatch.setattr(jdbc, "_held_keys", missing)
    monkeypatch.setattr(jdbc, "_write", lambda *a: writes.append(a))
    typed = coverage_stats(spark, ("EU", 1, 1.0)).withColumn("created_at", F.current_timestamp())
    with pytest.raises(RuntimeError, match="no such table"):
        jdbc.load_jdbc_insert_absent(typed, COVERAGE_STATS, jdbc.JdbcTarget("jdbc:any"))
    assert not writes
