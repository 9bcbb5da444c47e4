"""The three raw datasets as views over the test tables ``events`` and ``region``.

The text runs unchanged in Spark SQL and DuckDB; ``{events}`` and ``{region}`` are the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TELEMETRY = """
SELECT event_id,
       CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE concat('SAT-', CAST(user_id AS VARCHAR(20))) END AS satellite_id,
       ts,
       CAST((event_id * 37) % 210 - 105 AS DOUBLE) AS latitude,
       CAST((event_id * 53) % 400 - 200 AS DOUBLE) AS longitude,
       CAST((event_id * 11) % 2200 - 50 AS DOUBLE) AS altitude,
       CASE WHEN event_id % 13 = 0 THEN NULL
            ELSE CAST(7 AS DOUBLE) + CAST(event_id % 100 AS DOUBLE) / 100 END AS velocity,
       CASE event_type WHEN 'view' THEN 'operational'
                       WHEN 'click' THEN 'online'
                       WHEN 'purchase' THEN 'idle'
                       WHEN 'error' THEN 'offline'
                       ELSE CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'Operational' END
       END AS status
FROM {events}
"""

COVERAGE = """
SELECT e.event_id, substr(r.r_name, 1, 2) AS region_id, r.r_name AS region_name, e.ts,
       CASE WHEN e.event_id % 17 = 0 THEN NULL
            ELSE CAST(e.event_id * 7 % 10000 AS DOUBLE) / 100 END AS coverage_percentage,
       CAST(e.event_id % 12 AS INT) AS satellite_count,
       CAST(-80 AS DOUBLE) + CAST(e.event_id % 200 AS DOUBLE) / 10 AS avg_signal_strength
FROM {events} e JOIN {region} r ON e.user_id % 5 = r.r_regionkey
WHERE e.event_id % 3 <> 0
"""

PERFORMANCE = """
SELECT e.event_id, e.ts, substr(r.r_name, 1, 2) AS region,
       CASE WHEN e.event_id % 19 = 0 THEN NULL
            ELSE CAST(20 AS DOUBLE) + e.value END AS latency_ms,
       CAST(e.event_id * 13 % 20000 AS DOUBLE) / 100 AS throughput_mbps,
       CAST(9800 + e.event_id % 200 AS DOUBLE) / 100 AS availability_percentage
FROM {events} e JOIN {region} r ON e.user_id % 5 = r.r_regionkey
WHERE e.event_id % 3 <> 1
"""


def _view(text: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    used = [t for t in ("events", "region") if f"{{{t}}}" in text]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(TELEMETRY, spark, sf_dir)


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(COVERAGE, spark, sf_dir)


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(PERFORMANCE, spark, sf_dir)


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The views under the column names of the raw files."""
    views = {"satellite": telemetry, "coverage": coverage, "performance": performance}
    return {
        name: view(spark, sf_dir).withColumnRenamed("ts", "timestamp").drop("event_id")
        for name, view in views.items()
    }


def portable(df: DataFrame) -> DataFrame:
    """Types two engines compare alike: decimals as doubles, zoned times (UTC) without zone."""
    casts = {"timestamp": "timestamp_ntz"}
    columns = []
    for name, kind in df.dtypes:
        target = "double" if kind.startswith("decimal") else casts.get(kind)
        columns.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*columns)
