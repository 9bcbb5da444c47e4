"""Schemas of the three raw datasets and the three hourly statistics tables.

A ``StatsTable`` states *what* an hourly table holds (entity column, measures and their
serving types); the rollup, cast, quarantine, report and sink operators are all driven by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from perigee.fixed_values import REGION_ID_WIDTH

WINDOW_START = "time_window_start"
WINDOW_END = "time_window_end"
CREATED_AT = "created_at"
#: Directory column of rows that belong to a batch.
BATCH = "batch"


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(10,2)": T.DecimalType(10, 2),
}


def _schema(required: tuple[str, ...] = (), **columns: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in required) for name, kind in columns.items()]
    )


@dataclass(frozen=True)
class RawDataset:
    name: str
    file_stem: str
    schema: T.StructType
    # Directory columns of the processed copy.
    layout: tuple[str, ...]


SATELLITE = RawDataset(
    "satellite",
    "satellite_data",
    _schema(
        required=("satellite_id", "timestamp"),
        satellite_id="string",
        timestamp="timestamp",
        latitude="double",
        longitude="double",
        altitude="double",
        velocity="double",
        status="string",
    ),
    ("year", "month", "day"),
)
COVERAGE = RawDataset(
    "coverage",
    "coverage_data",
    _schema(
        required=("region_id", "timestamp"),
        region_id="string",
        region_name="string",
        timestamp="timestamp",
        coverage_percentage="double",
        satellite_count="int",
        avg_signal_strength="double",
    ),
    ("region_id",),
)
PERFORMANCE = RawDataset(
    "performance",
    "performance_metrics",
    _schema(
        required=("timestamp", "region"),
        timestamp="timestamp",
        region="string",
        latency_ms="double",
        throughput_mbps="double",
        availability_percentage="double",
    ),
    ("region",),
)
RAW_DATASETS = (SATELLITE, COVERAGE, PERFORMANCE)


@dataclass(frozen=True)
class Measure:
    """One output column of an hourly table: ``how`` applied to ``source``, stored as ``sql_type``."""

    name: str
    how: str  # avg | min | max | rows | status
    source: str  # input column, or the status counted when ``how`` is "status"
    sql_type: str


@dataclass(frozen=True)
class StatsTable:
    name: str
    entity: tuple[str, ...]  # () for the fleet-wide table, else the region column
    measures: tuple[Measure, ...]
    # Measures left out of the recent-window report.
    unreported: tuple[str, ...] = ()
    entity_width: int = REGION_ID_WIDTH

    @property
    def key(self) -> list[str]:
        return [*self.entity, WINDOW_START, WINDOW_END]

    @property
    def columns(self) -> list[str]:
        return [*self.key, *(m.name for m in self.measures)]

    @property
    def report_columns(self) -> list[str]:
        kept = [m.name for m in self.measures if m.name not in self.unreported]
        return [*self.entity, WINDOW_START, *kept]

    @property
    def schema(self) -> T.StructType:
        """Serving schema: the key, the typed measures and the load time."""
        columns = {c: "string" for c in self.entity}
        columns |= {c: "timestamp" for c in (WINDOW_START, WINDOW_END)}
        columns |= {m.name: m.sql_type for m in self.measures}
        return _schema(required=tuple(self.key), **columns, **{CREATED_AT: "timestamp"})


_PERCENT = "decimal(5,2)"
_AMOUNT = "decimal(10,2)"
_COUNT = "int"

SATELLITE_STATS = StatsTable(
    "satellite_statistics",
    (),
    (
        Measure("total_satellites", "rows", "*", _COUNT),
        Measure("operational_count", "status", "operational", _COUNT),
        Measure("maintenance_count", "status", "maintenance", _COUNT),
        Measure("standby_count", "status", "standby", _COUNT),
        Measure("avg_altitude", "avg", "altitude", _AMOUNT),
        Measure("avg_velocity", "avg", "velocity", _AMOUNT),
    ),
)
COVERAGE_STATS = StatsTable(
    "coverage_statistics",
    ("region_id",),
    (
        Measure("avg_coverage_percentage", "avg", "coverage_percentage", _PERCENT),
        Measure("max_coverage_percentage", "max", "coverage_percentage", _PERCENT),
        Measure("min_coverage_percentage", "min", "coverage_percentage", _PERCENT),
        Measure("avg_satellite_count", "avg", "satellite_count", _AMOUNT),
        Measure("max_satellite_count", "max", "satellite_count", _COUNT),
        Measure("avg_signal_strength", "avg", "avg_signal_strength", _AMOUNT),
    ),
    unreported=("max_satellite_count",),
)
PERFORMANCE_STATS = StatsTable(
    "performance_statistics",
    ("region",),
    (
        Measure("avg_latency_ms", "avg", "latency_ms", _AMOUNT),
        Measure("min_latency_ms", "min", "latency_ms", _AMOUNT),
        Measure("max_latency_ms", "max", "latency_ms", _AMOUNT),
        Measure("avg_throughput_mbps", "avg", "throughput_mbps", _AMOUNT),
        Measure("min_throughput_mbps", "min", "throughput_mbps", _AMOUNT),
        Measure("max_throughput_mbps", "max", "throughput_mbps", _AMOUNT),
        Measure("avg_availability_percentage", "avg", "availability_percentage", _PERCENT),
    ),
)
STATS_TABLES = (SATELLITE_STATS, COVERAGE_STATS, PERFORMANCE_STATS)
