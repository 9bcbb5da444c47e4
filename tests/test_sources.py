from __future__ import annotations

import json
import math
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.model import COVERAGE, PERFORMANCE, RAW_DATASETS, SATELLITE
from perigee.plans.batch import load_all
from perigee.sinks.raw_export import export_raw
from perigee.sources import files, processed, raw
from perigee.sources.json_records import read_records
from tests.conftest import at, plan, rows

TIME = "2024-01-01 10:00:00.123456"


@pytest.fixture
def inputs(spark):
    ts = at(TIME)
    return {
        "satellite": spark.createDataFrame(
            [("S1", ts, 1.5, -2.5, 550.0, 7.6, "idle"), ("S2", ts, None, 0.1 + 0.2, 1e-7, None, None)], SATELLITE.schema
        ),
        "coverage": spark.createDataFrame([("EU", "Europe, west", ts, 99.99, 3, -70.25), ("NA", None, ts, None, None, None)], COVERAGE.schema),
        "performance": spark.createDataFrame([(ts, "EU", 20.125, 100.0, 99.9)], PERFORMANCE.schema),
    }


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet", "CSV"])
def test_round_trip(spark, tmp_path, inputs, file_format):
    export_raw(inputs, str(tmp_path), file_format)
    back = raw.extract_all(spark, str(tmp_path), file_format)
    assert set(back) == {d.name for d in RAW_DATASETS}
    for dataset in RAW_DATASETS:
        assert rows(back[dataset.name]) == rows(inputs[dataset.name])
        assert [(f.name, f.dataType) for f in back[dataset.name].schema] == [(f.name, f.dataType) for f in dataset.schema]


def test_single_dataset_extracts(spark, tmp_path, inputs):
    export_raw(inputs, str(tmp_path), "csv")
    for extract, dataset in ((raw.extract_satellite, SATELLITE), (raw.extract_coverage, COVERAGE), (raw.extract_performance, PERFORMANCE)):
        assert rows(extract(spark, raw.raw_path(str(tmp_path), dataset, "csv"), "Csv")) == rows(inputs[dataset.name])


def test_unknown_formats(spark, tmp_path, inputs):
    with pytest.raises(ValueError, match="orc"):
        raw.extract_satellite(spark, str(tmp_path), "orc")
    with pytest.raises(ValueError, match="orc"):
        export_raw(inputs, str(tmp_path), "orc")
    with pytest.raises(ValueError, match="parquet"):
        files.scan_rejects(spark, str(tmp_path), SATELLITE.schema, "parquet")


def test_raw_paths():
    assert raw.raw_path("", SATELLITE, "csv") == "satellite_data.csv"
    assert raw.raw_path("s3a://bucket/base/", PERFORMANCE, "JSON") == "s3a://bucket/base/performance_metrics.json"


HEADER = "satellite_id,timestamp,latitude,longitude,altitude,velocity,status"


def write_csv(path: Path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_faults_become_null_and_are_reported(spark, tmp_path):
    path = write_csv(
        tmp_path / "s.csv", HEADER,
        f"S1,{TIME},1,2,550,7.5,idle", "S2,yesterday,1,2,550,7.5,idle", f"S3,{TIME},1", f"S4,{TIME},x,2,550,7.5,idle",
    )
    df = files.scan_csv(spark, path, SATELLITE.schema)
    got = {r.satellite_id: r for r in df.collect()}
    assert len(got) == 4
    assert got["S2"].timestamp is None and got["S3"].longitude is None and got["S4"].latitude is None
    rejects = files.scan_rejects(spark, path, SATELLITE.schema)
    assert {r.satellite_id: r._corrupt_record.split(",")[0] for r in rejects.collect()} == {s: s for s in ("S2", "S3", "S4")}
    assert rejects.count() == 3
    assert rejects.select("satellite_id").count() == 3


def test_csv_float_in_int_column(spark, tmp_path):
    path = write_csv(
        tmp_path / "c.csv", "region_id,region_name,timestamp,coverage_percentage,satellite_count,avg_signal_strength",
        f"EU,Europe,{TIME},50,4.0,-70",
    )
    assert files.scan_csv(spark, path, COVERAGE.schema).first().satellite_count is None
    assert files.scan_rejects(spark, path, COVERAGE.schema).count() == 1


def test_csv_with_reordered_header_is_refused(spark, tmp_path):
    path = write_csv(
        tmp_path / "s.csv", "timestamp,satellite_id,latitude,longitude,altitude,velocity,status", f"{TIME},S1,1,2,550,7.5,idle"
    )
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, path, SATELLITE.schema).collect()
    assert files.scan_csv(spark, path, SATELLITE.schema, check_header=False).first().satellite_id == TIME


def test_csv_without_header(spark, tmp_path):
    path = write_csv(tmp_path / "s.csv", f"S1,{TIME},1,2,550,7.5,idle")
    assert files.scan_csv(spark, path, SATELLITE.schema, header=False).first().satellite_id == "S1"


def test_json_record_array(spark, tmp_path):
    records = [
        {"region_id": "EU", "region_name": "Europe", "timestamp": "2024-01-01T10:00:00.000", "coverage_percentage": 50,
         "satellite_count": 4, "avg_signal_strength": -70.5},
        {"region_id": "NA", "timestamp": "2024-01-01T10:05:00.000", "satellite_count": 4.5},
    ]
    path = tmp_path / "c.json"
    path.write_text(json.dumps(records))
    got = {r.region_id: r for r in files.scan_json(spark, str(path), COVERAGE.schema).collect()}
    assert got["EU"].timestamp == at("2024-01-01 10:00:00") and got["EU"].coverage_percentage == 50.0
    assert got["NA"].satellite_count is None and got["NA"].region_name is None


def test_json_lines_and_their_rejects(spark, tmp_path):
    path = tmp_path / "p.json"
    records = [{"region": r, "timestamp": "2024-01-01T10:00:00", "latency_ms": 1.0} for r in "ab"]
    path.write_text("\n".join([*map(json.dumps, records), '{"region": "c", "latency_ms": "slow"}', '{"region": "d"']))
    assert files.scan_json(spark, str(path), PERFORMANCE.schema).count() == 4
    rejects = files.scan_rejects(spark, str(path), PERFORMANCE.schema, "json")
    assert sorted(r._corrupt_record for r in rejects.collect()) == ['{"region": "c", "latency_ms": "slow"}', '{"region": "d"']
    assert rejects.count() == 2


def test_parquet_of_other_types_is_conformed(spark, tmp_path):
    table = pa.table({
        "satellite_count": pa.array([3], pa.int64()),
        "region_id": ["EU"], "region_name": ["Europe"],
        "timestamp": pa.array([at("2024-01-01 10:00:00")], pa.timestamp("us")),
        "coverage_percentage": pa.array([50], pa.int32()), "avg_signal_strength": [-70.0], "extra": [1],
    })
    pq.write_table(table, tmp_path / "coverage_data.parquet")
    df = raw.extract_coverage(spark, str(tmp_path / "coverage_data.parquet"), "parquet")
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in COVERAGE.schema]
    assert df.first().timestamp == at("2024-01-01 10:00:00")
    assert files.scan_parquet(spark, str(tmp_path / "coverage_data.parquet")).columns == table.column_names


def test_conform_names_what_is_absent(spark):
    with pytest.raises(ValueError, match="region_name"):
        files.conform_schema(spark.createDataFrame([("EU",)], "region_id string"), COVERAGE.schema)


def test_require_nonempty(spark, tmp_path, inputs):
    assert raw.require_nonempty(inputs) is inputs
    path = write_csv(tmp_path / "s.csv", HEADER)
    empty = {"satellite": files.scan_csv(spark, path, SATELLITE.schema), "coverage": inputs["coverage"]}
    with pytest.raises(ValueError, match="no rows in satellite"):
        raw.require_nonempty(empty)


def test_dated_read_prunes_days(spark, tmp_path):
    days = spark.range(0, 20).select(
        F.concat(F.lit("S"), F.col("id")).alias("satellite_id"),
        (F.lit(at("2023-12-22 12:00:00")) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("timestamp"),
        *(F.lit(1.0).alias(c) for c in ("latitude", "longitude", "altitude", "velocity")), F.lit("idle").alias("status"),
    )
    load_all({"satellite": days}, str(tmp_path))
    df = processed.read_satellite(spark, str(tmp_path), "2023-12-30 12:00:00", "2024-01-03 12:00:00")
    assert df.count() == 4
    assert {(r.year, r.month, r.day) for r in df.collect()} == {(2023, 12, 30), (2023, 12, 31), (2024, 1, 1), (2024, 1, 2)}
    partition_filters = plan(df).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "make_date(year" in partition_filters
    files_read = df.inputFiles()
    assert len(files_read) >= 1 and processed.read_satellite(spark, str(tmp_path)).count() == 20


def test_nan_survives_parquet(spark, tmp_path, inputs):
    nan = inputs["performance"].withColumn("latency_ms", F.lit(float("nan")))
    export_raw({"performance": nan}, str(tmp_path), "parquet")
    assert math.isnan(raw.extract_performance(spark, raw.raw_path(str(tmp_path), PERFORMANCE, "parquet"), "parquet").first().latency_ms)


def test_schemas_have_the_declared_order():
    assert SATELLITE.schema.names == HEADER.split(",")
    assert COVERAGE.schema["satellite_count"].dataType == T.IntegerType()
    assert [f.name for d in RAW_DATASETS for f in d.schema if not f.nullable] == [
        "satellite_id", "timestamp", "region_id", "timestamp", "timestamp", "region",
    ]


def performance_record(k: int, region: str = "EU") -> dict:
    return {"timestamp": f"2024-01-01T10:00:{k % 60:02d}", "region": f"{region}{k}", "latency_ms": k + 0.5, "throughput_mbps": None}


def layouts(records: list[dict]) -> dict[str, str]:
    texts = [json.dumps(r) for r in records]
    return {
        "lines": "\n".join(texts) + "\n",
        "lines_without_end": "\n".join(texts),
        "line_array": "[" + ", ".join(texts) + "]",
        "spread": json.dumps(records, indent=2) + "\n",
        "array_by_lines": "[\n" + ",\n".join(texts) + "\n]\n",
        "side_by_side": "".join(texts),
        "marked": "\ufeff[" + ",".join(texts) + "]",
        "blank_lines": "\r\n\r\n" + "\r\n\r\n".join(texts) + "\r\n",
    }


@pytest.mark.parametrize("layout", sorted(layouts([{}])))
@pytest.mark.parametrize("size", [64, 1_000_000])
def test_json_records_of_every_layout_and_range(spark, tmp_path, settings, layout, size):
    settings(files__maxPartitionBytes=size, files__openCostInBytes=1)
    records = [performance_record(k) for k in range(40)]
    (tmp_path / "p.json").write_text(layouts(records)[layout])
    df = files.scan_json(spark, str(tmp_path), PERFORMANCE.schema)
    got = df.select("region", "latency_ms", "throughput_mbps", F.second("timestamp")).collect()
    assert sorted(map(tuple, got)) == sorted((r["region"], r["latency_ms"], None, k) for k, r in enumerate(records))
    assert files.scan_rejects(spark, str(tmp_path), PERFORMANCE.schema, "json").count() == 0
    assert files.scan_json(spark, str(tmp_path / "p.json"), PERFORMANCE.schema).columns == PERFORMANCE.schema.names


def test_files_of_different_layouts_side_by_side(spark, tmp_path):
    for n, (name, text) in enumerate(layouts([performance_record(k) for k in range(25)]).items()):
        (tmp_path / f"{n}-{name}.json").write_text(text)
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ]\n")
    counts = files.scan_json(spark, str(tmp_path), PERFORMANCE.schema).groupBy("region").count().collect()
    assert len(counts) == 25 and {r["count"] for r in counts} == {8}


def test_an_array_on_one_line_is_read_by_several_tasks(spark, tmp_path, settings):
    settings(files__maxPartitionBytes=20_000, files__openCostInBytes=1)
    (tmp_path / "p.json").write_text(json.dumps([performance_record(k) for k in range(3_000)]))
    df = files.scan_json(spark, str(tmp_path), PERFORMANCE.schema)
    by_task = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) > 10 and sum(r["count"] for r in by_task) == 3_000 == df.select("region").distinct().count()


NESTED = [
    {"region": "nested", "latency_ms": 1.0, "site": {"name": "a", "at": {"lat": 1, "lon": [2, 3]}}, "throughput_mbps": 5.0},
    {"site": {"name": "b"}, "region": "first", "latency_ms": 2.0},
    {"region": "list", "points": [{"x": 1}, {"x": 2}, {"x": {"y": 3}}], "latency_ms": 3.0},
    {"region": 'braces } , { "quoted\\" ] [ {', "latency_ms": 4.0},
    {"region": '},{"x":1},{"region":"y"},', "latency_ms": 5.0, "note": "{}{}}{{"},
    {"latency_ms": 6.0, "region": "{"},
    {"region": "back\\\\slash\\", "latency_ms": 7.0, "note": "}"},
    {"region": "ünï 漢 \u2028 \t", "latency_ms": 8.0, "last": {}},
    {"region": None, "latency_ms": 9.0, "list": [[], {}, [{}]]},
]


@pytest.mark.parametrize("layout", ["lines", "line_array", "spread"])
@pytest.mark.parametrize("size", [48, 1_000_000])
def test_json_records_with_nested_objects_and_braces_in_strings(spark, tmp_path, settings, layout, size):
    settings(files__maxPartitionBytes=size, files__openCostInBytes=1)
    records = [*NESTED, performance_record(1), *NESTED, performance_record(2), performance_record(3)]
    (tmp_path / "p.json").write_text(layouts(records)[layout])
    got = files.scan_json(spark, str(tmp_path), PERFORMANCE.schema).select("region", "latency_ms").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r["region"], r["latency_ms"]) for r in records), key=repr)


BROKEN = ['{"region": "a", "latency_ms": "slow"}', '{"region": "b", "latency_ms": }', '{"region": "c', "oops", '{"region": "d", "list": [1, 2}', "{,}"]


@pytest.mark.parametrize("joint, size", [(",", 32), (",\n", 1_000_000), ("\n", 32), (" ", 1_000_000)])
def test_one_broken_record_is_one_reject_with_its_own_text(spark, tmp_path, settings, joint, size):
    settings(files__maxPartitionBytes=size, files__openCostInBytes=1)
    texts = []
    for k, broken in enumerate(BROKEN):
        texts += [json.dumps(performance_record(2 * k)), broken + ("}" if broken.endswith("c") else ""), json.dumps(performance_record(2 * k + 1))]
    (tmp_path / "p.json").write_text("[" + joint.join(texts) + "]")
    rejects = files.scan_rejects(spark, str(tmp_path), PERFORMANCE.schema, "json").collect()
    wanted = [b + "}" if b.endswith("c") else b for b in BROKEN]
    assert sorted(r["_corrupt_record"] for r in rejects) == sorted(wanted)
    good = [r.region for r in files.scan_json(spark, str(tmp_path), PERFORMANCE.schema).collect() if r.latency_ms is not None]
    assert sorted(good) == sorted(f"EU{k}" for k in range(2 * len(BROKEN)))
    both = raw.extract_with_rejects(spark, str(tmp_path), PERFORMANCE, "json")
    assert both.count() == 3 * len(BROKEN) and both.where("_corrupt_record IS NOT NULL").count() == len(BROKEN)


def test_array_cut_off_in_a_record(spark, tmp_path):
    text = json.dumps([performance_record(k) for k in range(3)])
    (tmp_path / "p.json").write_text(text[: text.index('"EU2"') + 5])
    got = raw.extract_with_rejects(spark, str(tmp_path), PERFORMANCE, "json").collect()
    assert len(got) == 3 and [r["_corrupt_record"] for r in got if r["_corrupt_record"]] == ['{"timestamp": "2024-01-01T10:00:02", "region": "EU2"']


def test_json_by_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([performance_record(k) for k in range(3)], indent=1))
    assert files.scan_json(spark, str(tmp_path), PERFORMANCE.schema, multi_line=True).count() == 3


def test_json_record_reader_has_no_python(spark, tmp_path):
    (tmp_path / "p.json").write_text("[]")
    text = plan(files.scan_json(spark, str(tmp_path), PERFORMANCE.schema))
    assert not [p for p in ("Python", "Arrow", "Cartesian", "NestedLoop") if p in text]


def test_json_records_are_parsed_once_where_they_are_read(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"region": "EU", "latency_ms": 1.0}\n')
    df = read_records(spark, str(tmp_path), PERFORMANCE.schema)
    # as records, as pieces without declared keys, as texts joined again; never in a filter or for each column
    assert plan(df).count("from_json(") == 3
