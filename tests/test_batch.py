from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.views import raw_inputs
from perigee import job
from perigee.model import COVERAGE, COVERAGE_STATS, PERFORMANCE, PERFORMANCE_STATS, RAW_DATASETS, SATELLITE_STATS, STATS_TABLES
from perigee.operators import partials
from perigee.plans import batch, ledger
from perigee.plans.batch import BatchConfig, LoadError, load_all, run_batch
from perigee.plans.transform import transform_all
from perigee.session import object_store_conf, shared_folder
from perigee.sinks.jdbc import JdbcTarget
from perigee.sinks.raw_export import export_raw
from perigee.sources.processed import read_regional, read_rejects, read_satellite, scan_stats
from tests.conftest import SF_SMALL, plan, rows


def test_transform_outputs(spark):
    inputs = raw_inputs(spark, SF_SMALL)
    outputs = transform_all(inputs)
    assert set(outputs) == {"satellite", "coverage", "performance", *(t.name for t in STATS_TABLES)}
    assert outputs["coverage"] is inputs["coverage"]
    assert set(transform_all({"performance": inputs["performance"]})) == {"performance", PERFORMANCE_STATS.name}
    assert transform_all({}) == {}


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_run(spark, tmp_path, file_format):
    inputs = raw_inputs(spark, SF_SMALL)
    export_raw(inputs, str(tmp_path / "raw"), file_format)
    config = BatchConfig(str(tmp_path / "raw"), str(tmp_path / "out"), file_format)
    counts = run_batch(spark, config)
    if file_format != "parquet":
        assert counts["extracted/satellite"] == inputs["satellite"].count() == 1000
        assert counts["rejected/satellite_data"] == 0
    assert counts["coverage"] == inputs["coverage"].count()
    expected = transform_all(inputs)
    assert counts["satellite"] == expected["satellite"].count()
    for table in STATS_TABLES:
        back = scan_stats(spark, str(tmp_path / "out"), table)
        assert back.dtypes == [(f.name, f.dataType.simpleString()) for f in table.schema]
        assert back.where("created_at IS NULL").count() == 0
        first = table.measures[-1]
        typed = expected[table.name].withColumn(first.name, F.col(first.name).cast(first.sql_type))
        assert rows(back.select(*table.key, first.name)) == rows(typed.select(*table.key, first.name))
        assert counts[table.name] == back.count() and counts[f"rejected/{table.name}"] == 0
    # A second run replaces the results and leaves the same ones.
    assert run_batch(spark, config) == counts


def test_run_needs_all_inputs(spark, tmp_path):
    inputs = raw_inputs(spark, SF_SMALL)
    inputs["coverage"] = inputs["coverage"].limit(0)
    export_raw(inputs, str(tmp_path / "raw"), "parquet")
    with pytest.raises(ValueError, match="no rows in coverage"):
        run_batch(spark, BatchConfig(str(tmp_path / "raw"), str(tmp_path / "out"), "parquet"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_batch(spark, BatchConfig(str(tmp_path / "nothing"), str(tmp_path / "out"), "parquet"))


def test_bad_statistics_are_set_aside(spark, tmp_path):
    coverage = raw_inputs(spark, SF_SMALL)["coverage"]
    coverage = coverage.withColumn("region_id", F.when(F.col("region_id") == "EU", "A LONG REGION").otherwise(F.col("region_id")))
    counts = load_all(transform_all({"coverage": coverage}), str(tmp_path))
    hours = transform_all({"coverage": coverage})[COVERAGE_STATS.name]
    assert counts["rejected/coverage_statistics"] == hours.where("region_id = 'A LONG REGION'").count() > 0
    assert counts["coverage_statistics"] + counts["rejected/coverage_statistics"] == hours.count()
    refused = spark.read.parquet(str(tmp_path / "rejected" / "coverage_statistics"))
    assert {r.reject_reason for r in refused.collect()} == {"region_too_long"}


def test_one_failure_does_not_keep_the_rest_from_loading(spark, tmp_path):
    inputs = raw_inputs(spark, SF_SMALL)
    outputs = {
        "coverage": inputs["coverage"].withColumn("coverage_percentage", F.raise_error(F.lit("bad disk")).cast("double")),
        "performance": inputs["performance"],
    }
    with pytest.raises(LoadError, match="coverage: .*bad disk"):
        load_all(outputs, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "performance_metrics")).count() == inputs["performance"].count()


def test_only_statistics_reach_the_database(spark, tmp_path, monkeypatch):
    loaded = []
    monkeypatch.setattr(batch, "load_jdbc_insert_absent", lambda df, table, target: loaded.append((table.name, df.columns)))
    outputs = transform_all(raw_inputs(spark, SF_SMALL))
    load_all(outputs, str(tmp_path), JdbcTarget("jdbc:any"))
    assert sorted(name for name, _ in loaded) == sorted(t.name for t in STATS_TABLES)
    assert dict(loaded)[SATELLITE_STATS.name] == SATELLITE_STATS.schema.names


def test_a_missing_client_library_is_an_error(monkeypatch):
    monkeypatch.setitem(__import__("sys").modules, "psycopg2", None)
    args = job.parse(["--raw", "a", "--processed", "b", "--db-host", "db"])
    with pytest.raises(ImportError):
        job.database_of(args)


def test_bad_raw_rows_are_written_and_counted(spark, tmp_path):
    inputs = raw_inputs(spark, SF_SMALL)
    export_raw(inputs, str(tmp_path / "raw"), "csv")
    (tmp_path / "raw" / "coverage_data.csv" / "bad.csv").write_text(
        "region_id,region_name,timestamp,coverage_percentage,satellite_count,avg_signal_strength\n"
        "EU,Europe,2024-01-03T10:00:00,many,2,-70\nEU,Europe,noon,5,2,-70\n"
    )
    counts = run_batch(spark, BatchConfig(str(tmp_path / "raw"), str(tmp_path / "out"), "csv"))
    assert counts["rejected/coverage_data"] == 2 and counts["rejected/satellite_data"] == 0
    assert counts["extracted/coverage"] == counts["coverage"] == inputs["coverage"].count() + 2
    refused = spark.read.parquet(str(tmp_path / "out" / "rejected" / "coverage_data"))
    assert {r._corrupt_record.split(",")[2] for r in refused.collect()} == {"2024-01-03T10:00:00", "noon"}


def write_raw(spark, folder, where, inputs=None, file_format="csv"):
    inputs = inputs or raw_inputs(spark, SF_SMALL)
    export_raw({n: df.where(where) for n, df in inputs.items()}, str(folder), file_format)
    return str(folder)


def everything(spark, out):
    """All rows under a root, but for velocities and load times."""
    held = {"satellite": read_satellite(spark, out).drop("velocity")}
    held |= {d.name: read_regional(spark, out, d) for d in (COVERAGE, PERFORMANCE)}
    held |= {t.name: scan_stats(spark, out, t).drop("created_at") for t in STATS_TABLES}
    held |= {f"rejected {d.name}": read_rejects(spark, out, d) for d in RAW_DATASETS}
    return {name: rows(df) for name, df in held.items()}


EARLY, LATE = "day(timestamp) <= 15 AND hour(timestamp) % 4 <> 3", "day(timestamp) > 15 OR hour(timestamp) % 4 = 3"
BAD_LINE = "region_id,region_name,timestamp,coverage_percentage,satellite_count,avg_signal_strength\nEU,Europe,{},many,2,-70\n"


@pytest.fixture(scope="module")
def both_batches(spark, tmp_path_factory):
    """Raw files of two batches, the second with late rows of the first one's hours, and what a run over both gives."""
    folders, tmp_path = {}, tmp_path_factory.mktemp("batches")
    minutes = "minute(timestamp) % 3 = 0"
    parts = {"one": f"({EARLY}) AND NOT {minutes}", "two": f"({LATE}) OR {minutes}", "all": "true"}
    for name, where in parts.items():
        folders[name] = write_raw(spark, tmp_path / "raw" / name, where)
        for k in range(3 if name == "all" else {"one": 1, "two": 2}[name]):
            (tmp_path / "raw" / name / "coverage_data.csv" / f"bad{k}.csv").write_text(BAD_LINE.format("2024-01-03T10:00:00"))
    run_batch(spark, BatchConfig(folders["all"], str(tmp_path / "whole")))
    return folders, everything(spark, str(tmp_path / "whole"))


@pytest.fixture
def two_batches(both_batches, tmp_path):
    folders, whole = both_batches
    return folders, str(tmp_path / "out"), whole


def test_batches_give_what_one_run_over_all_rows_gives(spark, two_batches):
    folders, out, whole = two_batches
    for name in ("one", "two"):
        counts = run_batch(spark, BatchConfig(folders[name], out, batch=f"2024-{name}"))
        assert counts["rejected/coverage_data"] == {"one": 1, "two": 2}[name]
    first = everything(spark, out)
    assert first == whole
    for name in ("two", "one"):
        run_batch(spark, BatchConfig(folders[name], out, batch=f"2024-{name}"))
    assert everything(spark, out) == first
    assert ledger.states(spark, out) == {"2024-one": "published", "2024-two": "published"}
    held = {r.output: r.rows for r in ledger.entries(spark, out).where("batch = '2024-two'").collect()}
    assert held["rejected/coverage_data"] == 2 and held["coverage"] > 0


@pytest.mark.parametrize("at", ["partials/performance_statistics", "coverage_data"])
def test_a_batch_that_broke_is_repeated(spark, two_batches, monkeypatch, at):
    folders, out, whole = two_batches
    run_batch(spark, BatchConfig(folders["one"], out, batch="one"))
    real = batch.replace_batch

    def broken(df, path, *args, **kwargs):
        if path.endswith(at):
            real(df.limit(3), path, *args, **kwargs)
            raise OSError("disk gone")
        return real(df, path, *args, **kwargs)

    monkeypatch.setattr(batch, "replace_batch", broken)
    for name in ("one", "two"):
        with pytest.raises(LoadError, match="disk gone"):
            run_batch(spark, BatchConfig(folders[name], out, batch=name))
    assert ledger.states(spark, out) == {"one": "reopened", "two": "open"}
    monkeypatch.undo()
    for name in ("two", "one"):
        run_batch(spark, BatchConfig(folders[name], out, batch=name))
    assert everything(spark, out) == whole


def test_a_corrected_batch_replaces_its_rows(spark, tmp_path):
    inputs, out = raw_inputs(spark, SF_SMALL), str(tmp_path / "out")
    first = write_raw(spark, tmp_path / "first", "day(timestamp) = 3")
    wrong = write_raw(spark, tmp_path / "wrong", "day(timestamp) IN (4, 5)")
    keep = {n: F.col({"coverage": "region_id", "performance": "region"}[n]) != "EU" for n in ("coverage", "performance")}
    corrected = {n: df.where("day(timestamp) = 4").where(keep.get(n, F.lit(True))) for n, df in inputs.items()}
    right = write_raw(spark, tmp_path / "right", "true", corrected)
    for folder, name in ((first, "3"), (wrong, "4"), (right, "4")):
        run_batch(spark, BatchConfig(folder, out, batch=name))
    wanted = {n: inputs[n].where("day(timestamp) = 3").unionByName(df) for n, df in corrected.items()}
    for dataset in (COVERAGE, PERFORMANCE):
        assert rows(read_regional(spark, out, dataset)) == rows(wanted[dataset.name].select(*dataset.schema.names))
    expected = transform_all(wanted)
    for table in STATS_TABLES:
        assert scan_stats(spark, out, table).count() == expected[table.name].count()
    assert read_satellite(spark, out).count() == expected["satellite"].count()


def test_statistics_follow_from_partials_alone(spark, two_batches):
    folders, out, _ = two_batches
    run_batch(spark, BatchConfig(folders["one"], out, batch="one"))
    run_batch(spark, BatchConfig(folders["two"], out, batch="two"))
    for table in STATS_TABLES:
        merged = partials.merged_partials(batch.stored_partials(spark, out, table, ["one", "two"]), table)
        assert all("/partials/" in f for f in merged.inputFiles())
        assert "batch" in plan(merged).split("PartitionFilters")[1][:200]


def test_roots_with_and_without_batches_do_not_mix(spark, tmp_path):
    raw = write_raw(spark, tmp_path / "raw", "day(timestamp) = 3")
    run_batch(spark, BatchConfig(raw, str(tmp_path / "plain")))
    with pytest.raises(ValueError, match="without batches"):
        run_batch(spark, BatchConfig(raw, str(tmp_path / "plain"), batch="3"))
    run_batch(spark, BatchConfig(raw, str(tmp_path / "keyed"), batch="3"))
    with pytest.raises(ValueError, match="name one"):
        run_batch(spark, BatchConfig(raw, str(tmp_path / "keyed")))
    for name in ("", "a/b", "a=b", "_x", "a b"):
        with pytest.raises(ValueError, match="batch name"):
            run_batch(spark, BatchConfig(raw, str(tmp_path / "keyed"), batch=name))


def test_scratch_copies_are_emptied(spark, tmp_path, monkeypatch):
    raw, folder = write_raw(spark, tmp_path / "raw", "day(timestamp) = 3"), str(tmp_path / "scratch")
    monkeypatch.setattr(batch, "fresh_folder", lambda *_: folder)
    run_batch(spark, BatchConfig(raw, str(tmp_path / "out")))
    assert [spark.read.parquet(f"{folder}/{d.file_stem}").count() for d in RAW_DATASETS] == [0, 0, 0]


def test_the_session_zone_does_not_move_the_folders(spark, tmp_path, settings):
    settings(session__timeZone="Asia/Kolkata")
    inputs = raw_inputs(spark, SF_SMALL)
    settings(session__timeZone="UTC")
    export_raw(inputs, str(tmp_path / "raw"), "csv")
    settings(session__timeZone="Asia/Kolkata")
    run_batch(spark, BatchConfig(str(tmp_path / "raw"), str(tmp_path / "out")))
    back = read_satellite(spark, str(tmp_path / "out"))
    assert back.where("year <> year(timestamp) OR month <> month(timestamp) OR day <> day(timestamp)").count() == 0
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_nothing_to_load(tmp_path):
    assert load_all({}, str(tmp_path)) == {}


def test_arguments(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "secret")
    monkeypatch.setenv("S3_ENDPOINT_URL", "http://store:9000")
    args = job.parse(
        ["--raw", "s3a://raw", "--processed", "s3a://out", "--checkpoint", "s3a://tmp", "--db-host", "db", "--db-append-only"]
    )
    assert (args.format, args.db_port, args.db_password) == ("csv", 5432, "secret")
    target = job.database_of(args)
    assert target.url == "jdbc:postgresql://db:5432/telemetry" and target.password == "secret"
    conf = job.session_conf(args)
    assert conf["spark.checkpoint.dir"] == "s3a://tmp"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    local = job.parse(["--raw", "/data/raw", "--processed", "/data/out"])
    assert job.database_of(local) is None and job.session_conf(local) == {}
    with pytest.raises(SystemExit):
        job.parse(["--raw", "x", "--processed", "y", "--format", "orc"])


def test_object_store_without_endpoint_uses_the_default_chain():
    conf = object_store_conf()
    assert "spark.hadoop.fs.s3a.endpoint" not in conf
    assert "Default" in conf["spark.hadoop.fs.s3a.aws.credentials.provider"]
    assert object_store_conf("http://h", "a", "b")["spark.hadoop.fs.s3a.access.key"] == "a"


def test_exit_code_reports_failure(monkeypatch):
    class Stopped:
        def stop(self):
            self.done = True

    session = Stopped()
    monkeypatch.setattr(job, "build_session", lambda *_: session)
    monkeypatch.setattr(job, "run_batch", lambda *_: {})
    arguments = ["--raw", "a", "--processed", "b"]
    assert job.main(arguments) == 0 and session.done

    def fail(*_):
        raise ValueError("no rows")

    monkeypatch.setattr(job, "run_batch", fail)
    assert job.main(arguments) == 1


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
