"""SQL for DuckDB with the same results as the queries of the same names in ``checks.catalog``."""

from __future__ import annotations

from checks.views import COVERAGE, PERFORMANCE, TELEMETRY

_TABLES = {"events": "events", "region": "region"}


def r2(value: str) -> str:
    """Half-up rounding of one value, on the digits it is written with."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 17)), 2) AS DOUBLE)"


def mean2(column: str) -> str:
    """The mean rounded half-up once, from a sum of whole hundred-millionths."""
    units = f"sum(CAST(round(CAST({column} AS DOUBLE) * 1e8) AS HUGEINT))"
    number = f"CAST(count({column}) AS HUGEINT)"
    whole = f"(abs({units}) * 200 + {number} * 100000000) // nullif({number} * 200000000, 0)"
    return f"sign({units}) * CAST({whole} AS DOUBLE) / 100"


def r6(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(20, 8)), 6) AS DOUBLE)"


def typed(columns: dict[str, str]) -> str:
    return ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in columns.items())


_PERCENT, _AMOUNT = "DECIMAL(5, 2)", "DECIMAL(10, 2)"
_COVERAGE_TYPES = {
    "avg_coverage_percentage": _PERCENT,
    "max_coverage_percentage": _PERCENT,
    "min_coverage_percentage": _PERCENT,
    "avg_satellite_count": _AMOUNT,
    "max_satellite_count": "INTEGER",
    "avg_signal_strength": _AMOUNT,
}
_PERFORMANCE_TYPES = {
    "avg_latency_ms": _AMOUNT,
    "min_latency_ms": _AMOUNT,
    "max_latency_ms": _AMOUNT,
    "avg_throughput_mbps": _AMOUNT,
    "min_throughput_mbps": _AMOUNT,
    "max_throughput_mbps": _AMOUNT,
    "avg_availability_percentage": _PERCENT,
}
_SATELLITE_TYPES = {
    "total_satellites": "INTEGER",
    "operational_count": "INTEGER",
    "maintenance_count": "INTEGER",
    "standby_count": "INTEGER",
    "avg_altitude": _AMOUNT,
    "avg_velocity": _AMOUNT,
}

_STATUS = """CASE WHEN status IN ('operational', 'active', 'online') THEN 'operational'
     WHEN status IN ('maintenance', 'offline', 'inactive') THEN 'maintenance'
     WHEN status IN ('standby', 'idle') THEN 'standby'
     ELSE 'unknown' END"""
_WINDOW = """date_trunc('hour', ts) AS time_window_start,
     date_trunc('hour', ts) + INTERVAL 1 HOUR AS time_window_end"""
_SPEED = "2 * pi() * (6371.0::DOUBLE + altitude) / 95.0::DOUBLE * 60.0::DOUBLE"

PRELUDE = f"""
WITH telemetry AS ({TELEMETRY.format(**_TABLES)}),
coverage AS ({COVERAGE.format(**_TABLES)}),
performance AS ({PERFORMANCE.format(**_TABLES)}),
sound AS (
  SELECT event_id, satellite_id, ts, latitude, longitude, altitude, velocity, {_STATUS} AS status
  FROM telemetry
  WHERE satellite_id IS NOT NULL AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180 AND altitude > 0 AND altitude < 2000
),
cleaned AS (
  SELECT event_id, satellite_id, ts, latitude, longitude, altitude,
         coalesce(velocity, (SELECT avg(velocity) FROM sound)) AS velocity, status
  FROM sound
),
coverage_hours AS (
  SELECT region_id, {_WINDOW},
         {mean2("coverage_percentage")} AS avg_coverage_percentage,
         max(coverage_percentage) AS max_coverage_percentage,
         min(coverage_percentage) AS min_coverage_percentage,
         {mean2("satellite_count")} AS avg_satellite_count,
         max(satellite_count) AS max_satellite_count,
         {mean2("avg_signal_strength")} AS avg_signal_strength
  FROM coverage GROUP BY region_id, date_trunc('hour', ts)
),
performance_hours AS (
  SELECT region, {_WINDOW},
         {mean2("latency_ms")} AS avg_latency_ms,
         min(latency_ms) AS min_latency_ms,
         max(latency_ms) AS max_latency_ms,
         {mean2("throughput_mbps")} AS avg_throughput_mbps,
         min(throughput_mbps) AS min_throughput_mbps,
         max(throughput_mbps) AS max_throughput_mbps,
         {mean2("availability_percentage")} AS avg_availability_percentage
  FROM performance GROUP BY region, date_trunc('hour', ts)
),
satellite_hours AS (
  SELECT {_WINDOW},
         count(*) AS total_satellites,
         count(CASE WHEN status = 'operational' THEN 1 END) AS operational_count,
         count(CASE WHEN status = 'maintenance' THEN 1 END) AS maintenance_count,
         count(CASE WHEN status = 'standby' THEN 1 END) AS standby_count,
         {mean2("altitude")} AS avg_altitude,
         {mean2("velocity")} AS avg_velocity
  FROM cleaned GROUP BY date_trunc('hour', ts)
),
coverage_stats AS (
  SELECT region_id, time_window_start, time_window_end, {typed(_COVERAGE_TYPES)} FROM coverage_hours
),
performance_stats AS (
  SELECT region, time_window_start, time_window_end, {typed(_PERFORMANCE_TYPES)}
  FROM performance_hours
),
satellite_stats AS (
  SELECT time_window_start, time_window_end, {typed(_SATELLITE_TYPES)} FROM satellite_hours
)"""


def as_doubles(types: dict[str, str]) -> str:
    return ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if t.startswith("DECIMAL") else c for c, t in types.items()
    )


def newest(table: str) -> str:
    return f"(SELECT max(time_window_start) FROM {table})"


def recent(table: str, hours: int, column: str = "time_window_start") -> str:
    return f"{column} >= (SELECT max({column}) FROM {table}) - INTERVAL {hours} HOUR"


def mean(column: str) -> str:
    return f"coalesce(CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0), 0.0::DOUBLE)"


_SATELLITE_FILE = """satellite_id, ts AS "timestamp", latitude, longitude, altitude, velocity, status"""
_COVERAGE_FILE = """region_id, region_name, ts AS "timestamp", coverage_percentage, satellite_count,
  avg_signal_strength"""
_PERFORMANCE_FILE = """ts AS "timestamp", region, latency_ms, throughput_mbps, availability_percentage"""
_POSITION = "event_id, satellite_id, latitude, longitude, altitude"
_VIEW_COUNTS = """SELECT 'satellite' AS dataset, count(*) AS row_count FROM telemetry
UNION ALL SELECT 'coverage', count(*) FROM coverage
UNION ALL SELECT 'performance', count(*) FROM performance"""
_METRICS = f"""95.0::DOUBLE AS orbital_period_minutes,
  {r2(_SPEED)} AS ground_track_velocity_kmh,
  {r2("altitude * 1.5::DOUBLE")} AS estimated_coverage_radius_km"""
_DIURNAL = "(1.0::DOUBLE + 0.2::DOUBLE * sin(hour(ts) * pi() / 12))"
_GRAVITY = f"{6.67430e-11 * 5.972e24!r}::DOUBLE"
_FAULT = """CASE WHEN region_id IS NULL OR time_window_start IS NULL OR time_window_end IS NULL
       THEN 'null_key'
     WHEN length(region_id) > 10 THEN 'region_too_long'
     WHEN (max_coverage_percentage IS NOT NULL
           AND TRY_CAST(max_coverage_percentage AS DECIMAL(5, 2)) IS NULL)
       THEN 'numeric_overflow' END"""


def _report_columns(types: dict[str, str], without: tuple[str, ...] = ()) -> str:
    return as_doubles({c: t for c, t in types.items() if c not in without})


_COVERAGE_REPORT = _report_columns(_COVERAGE_TYPES, ("max_satellite_count",))
_PERFORMANCE_REPORT = _report_columns(_PERFORMANCE_TYPES)

# One clock for all sections: the newest hour of the three tables.
_SUMMARY_CTES = f""",
newest AS (
  SELECT greatest({newest("satellite_stats")}, {newest("coverage_stats")}, {newest("performance_stats")}) AS newest_start
),
fleet AS (
  SELECT coalesce(CAST(sum(total_satellites) AS BIGINT), 0) AS total,
         coalesce(CAST(sum(operational_count) AS BIGINT), 0) AS operational,
         {mean("avg_altitude")} AS avg_altitude
  FROM satellite_stats WHERE time_window_start >= (SELECT newest_start FROM newest) - INTERVAL 24 HOUR
),
by_coverage AS (
  SELECT region_id AS region, {mean("avg_coverage_percentage")} AS avg_coverage,
         {mean("avg_satellite_count")} AS avg_satellites
  FROM coverage_stats WHERE time_window_start >= (SELECT newest_start FROM newest) - INTERVAL 24 HOUR
  GROUP BY region_id
),
by_performance AS (
  SELECT region, {mean("avg_latency_ms")} AS avg_latency,
         {mean("avg_throughput_mbps")} AS avg_throughput,
         {mean("avg_availability_percentage")} AS avg_availability
  FROM performance_stats WHERE time_window_start >= (SELECT newest_start FROM newest) - INTERVAL 24 HOUR
  GROUP BY region
)"""


def _unpivot(table: str, section: str, region: str, metrics: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{section}' AS section, {region} AS region, '{m}' AS metric, "
        f"CAST({m} AS DOUBLE) AS value FROM {table}"
        for m in metrics
    )


_SUMMARY_ROWS = "\nUNION ALL ".join(
    (
        _unpivot("fleet", "satellite", "CAST(NULL AS VARCHAR)", ["total", "operational", "avg_altitude"]),
        _unpivot("by_coverage", "coverage", "region", ["avg_coverage", "avg_satellites"]),
        _unpivot(
            "by_performance", "performance", "region",
            ["avg_latency", "avg_throughput", "avg_availability"],
        ),
    )
)

_REGION_CTES = """,
places(region_id, region_name, lat0, lon0) AS (VALUES
  ('NA', 'North America', 45.0::DOUBLE, -100.0::DOUBLE), ('EU', 'Europe', 50.0::DOUBLE, 10.0::DOUBLE),
  ('AS', 'Asia', 35.0::DOUBLE, 100.0::DOUBLE), ('SA', 'South America', -15.0::DOUBLE, -60.0::DOUBLE),
  ('OC', 'Oceania', -25.0::DOUBLE, 135.0::DOUBLE)),
ticks AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM telemetry),
near AS (
  SELECT p.region_id, date_trunc('hour', t.ts) AS ts, count(*) AS n
  FROM telemetry t JOIN places p
    ON sqrt((t.latitude - p.lat0) * (t.latitude - p.lat0)
            + (t.longitude - p.lon0) * (t.longitude - p.lon0)) * 111.0::DOUBLE < 2000.0::DOUBLE
  GROUP BY p.region_id, date_trunc('hour', t.ts)
),
in_range AS (
  SELECT p.region_id, p.region_name, k.ts, CAST(coalesce(n.n, 0) AS BIGINT) AS satellite_count
  FROM ticks k CROSS JOIN places p LEFT JOIN near n ON n.region_id = p.region_id AND n.ts = k.ts
),
shares AS (
  SELECT *, """ + r2("least(100.0::DOUBLE, CAST(satellite_count AS DOUBLE) / 10.0::DOUBLE * 100.0::DOUBLE)") + """
    AS coverage_percentage FROM in_range
)"""

_SPINE_CTES = """,
hours AS (SELECT DISTINCT region_id, date_trunc('hour', ts) AS time_window_start FROM coverage),
grid AS (
  SELECT r.region_id, g.t AS time_window_start
  FROM (SELECT DISTINCT region_id FROM coverage) r,
       (SELECT unnest(generate_series(min(time_window_start), max(time_window_start),
                                      INTERVAL 1 HOUR)) AS t FROM hours) g
)"""

_NUMBER, _TIME, _TEXT = "CAST(CAST({} AS DECIMAL(30, 6)) AS VARCHAR)", "strftime({}, '%Y-%m-%d %H:%M:%S')", "{}"


def in_full(dataset: str, table: str, columns: dict[str, str], more: str = "") -> str:
    """Rows as text of their values, by column name; ``columns`` has how each is written, or name and source."""
    values = []
    for name in sorted(columns):
        kind, source = columns[name] if isinstance(columns[name], tuple) else (columns[name], name)
        values.append(f"coalesce({kind.format(source)}, '-')")
    return f"SELECT '{dataset}' AS dataset, {more}concat_ws('|', {', '.join(values)}) AS row FROM {table}"


_SATELLITE_ROW = {"satellite_id": _TEXT, "timestamp": (_TIME, "ts"), "status": _TEXT} | {
    c: _NUMBER for c in ("latitude", "longitude", "altitude", "velocity")
}
_COVERAGE_ROW = {"region_id": _TEXT, "region_name": _TEXT, "timestamp": (_TIME, "ts")} | {
    c: _NUMBER for c in ("coverage_percentage", "satellite_count", "avg_signal_strength")
}
_PERFORMANCE_ROW = {"region": _TEXT, "timestamp": (_TIME, "ts")} | {
    c: _NUMBER for c in ("latency_ms", "throughput_mbps", "availability_percentage")
}
_HOURS = {"time_window_start": _TIME, "time_window_end": _TIME}


def _raw_in_full(more: str = "") -> str:
    return "\nUNION ALL ".join(
        (
            in_full("satellite", "telemetry", _SATELLITE_ROW, more),
            in_full("coverage", "coverage", _COVERAGE_ROW, more),
            in_full("performance", "performance", _PERFORMANCE_ROW, more),
        )
    )


_METRICS_ROW = {
    "orbital_period_minutes": (_NUMBER, "95.0::DOUBLE"),
    "ground_track_velocity_kmh": (_NUMBER, r2(_SPEED)),
    "estimated_coverage_radius_km": (_NUMBER, r2("altitude * 1.5::DOUBLE")),
}
_UNFILLED_ROW = {c: how for c, how in (_SATELLITE_ROW | _METRICS_ROW).items() if c != "velocity"}
_STATS_OUTPUTS = "\nUNION ALL ".join(
    (
        in_full("satellite_statistics", "satellite_stats", _HOURS | {c: _NUMBER for c in _SATELLITE_TYPES}),
        in_full("coverage_statistics", "coverage_stats", _HOURS | {"region_id": _TEXT} | {c: _NUMBER for c in _COVERAGE_TYPES}),
        in_full("performance_statistics", "performance_stats", _HOURS | {"region": _TEXT} | {c: _NUMBER for c in _PERFORMANCE_TYPES}),
    )
)


def _outputs(satellite_row: dict[str, str]) -> str:
    details = (
        in_full("satellite", "cleaned", satellite_row),
        in_full("coverage", "coverage", _COVERAGE_ROW),
        in_full("performance", "performance", _PERFORMANCE_ROW),
    )
    return "\nUNION ALL ".join((*details, _STATS_OUTPUTS))


_ALL_OUTPUTS = _outputs(_SATELLITE_ROW | _METRICS_ROW)

_BODIES: dict[str, tuple[str, str] | str] = {
    "scan_csv": f"SELECT {_SATELLITE_FILE} FROM telemetry",
    "scan_json": f"SELECT {_COVERAGE_FILE} FROM coverage",
    "scan_parquet": f"SELECT {_PERFORMANCE_FILE} FROM performance",
    "conform_schema": f"SELECT {_COVERAGE_FILE} FROM coverage",
    "extract_satellite": f"SELECT {_SATELLITE_FILE} FROM telemetry",
    "extract_coverage": f"SELECT {_COVERAGE_FILE} FROM coverage",
    "extract_performance": f"SELECT {_PERFORMANCE_FILE} FROM performance",
    "extract_all": _VIEW_COUNTS,
    "require_nonempty": _VIEW_COUNTS,
    "scan_rejects": """SELECT satellite_id,
  CASE WHEN event_id % 11 <> 0 THEN ts END AS "timestamp", 1.0::DOUBLE AS latitude,
  CASE WHEN event_id % 5 <> 0 THEN 2.0::DOUBLE END AS longitude,
  CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(altitude AS INTEGER) AS DOUBLE) END AS altitude,
  7.0::DOUBLE AS velocity, 'online' AS status,
  concat(coalesce(satellite_id, ''), ',', CASE WHEN event_id % 11 = 0 THEN 'yesterday' ELSE CAST(ts AS VARCHAR) END,
         ',1,', CASE WHEN event_id % 5 = 0 THEN 'east' ELSE '2' END, ',',
         CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(altitude AS INTEGER) AS VARCHAR) END,
         ',7,online') AS _corrupt_record
FROM telemetry WHERE event_id % 11 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0""",
    "scan_stats": f"""SELECT region_id, time_window_start, time_window_end,
  {as_doubles(_COVERAGE_TYPES)} FROM coverage_stats""",
    "read_satellite": f"""SELECT {_SATELLITE_FILE}, CAST(year(ts) AS INTEGER) AS year,
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM telemetry WHERE ts >= TIMESTAMP '2024-01-10 06:30:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'""",
    "filter_required_key": f"SELECT {_POSITION} FROM telemetry WHERE satellite_id IS NOT NULL",
    "filter_latitude": f"SELECT {_POSITION} FROM telemetry WHERE latitude BETWEEN -90 AND 90",
    "filter_longitude": f"SELECT {_POSITION} FROM telemetry WHERE longitude BETWEEN -180 AND 180",
    "filter_altitude": f"SELECT {_POSITION} FROM telemetry WHERE altitude > 0 AND altitude < 2000",
    "filter_recent": f"SELECT * FROM coverage WHERE {recent('coverage', 24, 'ts')}",
    "filter_region": "SELECT * FROM coverage WHERE region_id = 'EU'",
    "clean_satellite": f"""SELECT event_id, satellite_id, ts, latitude, longitude, altitude,
  {r6("velocity")} AS velocity, status FROM cleaned""",
    "quarantine_stats": (
        f""",
candidates AS (
  SELECT CASE WHEN event_id % 23 <> 0 THEN region_name END AS region_id, {_WINDOW},
         coverage_percentage AS avg_coverage_percentage,
         coverage_percentage * 11 AS max_coverage_percentage,
         coverage_percentage AS min_coverage_percentage,
         CAST(satellite_count AS DOUBLE) AS avg_satellite_count,
         satellite_count AS max_satellite_count, avg_signal_strength
  FROM coverage
),
judged AS (SELECT *, {_FAULT} AS fault FROM candidates),
repeated AS (
  SELECT region_id, time_window_start FROM judged WHERE fault IS NULL
  GROUP BY region_id, time_window_start HAVING count(*) > 1
)""",
        """SELECT j.region_id, j.time_window_start, j.time_window_end, avg_coverage_percentage,
  max_coverage_percentage, min_coverage_percentage, avg_satellite_count, max_satellite_count,
  avg_signal_strength,
  coalesce(fault, CASE WHEN d.region_id IS NOT NULL THEN 'duplicate_key' END) AS reject_reason
FROM judged j LEFT JOIN repeated d
  ON j.region_id = d.region_id AND j.time_window_start = d.time_window_start AND j.fault IS NULL""",
    ),
    "normalize_status": f"SELECT event_id, {_STATUS} AS status FROM telemetry",
    "orbital_period": "SELECT event_id, 95.0::DOUBLE AS orbital_period_minutes FROM telemetry",
    "ground_track_velocity": f"SELECT event_id, {r2(_SPEED)} AS ground_track_velocity_kmh FROM telemetry",
    "coverage_radius": f"""SELECT event_id, {r2("altitude * 1.5::DOUBLE")} AS estimated_coverage_radius_km
FROM telemetry""",
    "orbital_metrics": f"SELECT *, {_METRICS} FROM sound",
    "flatten_window": f"SELECT event_id, {_WINDOW} FROM coverage",
    "date_parts_of_rows": """SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS year,
  CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM telemetry""",
    "cast_stats_types": "SELECT region, time_window_start, time_window_end, "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _PERFORMANCE_TYPES)
    + " FROM performance_stats",
    "align_region": "SELECT event_id, region_id AS region, region_name, ts, coverage_percentage, "
    "satellite_count, avg_signal_strength FROM coverage",
    "null_to_zero": """SELECT event_id, coalesce(coverage_percentage, 0.0::DOUBLE) AS coverage_percentage
FROM coverage""",
    "orbital_velocity": "SELECT event_id, velocity, "
    + r6(f"sqrt({_GRAVITY} / ((altitude + 6371.0::DOUBLE) * 1000.0::DOUBLE)) / 1000.0::DOUBLE")
    + " AS orbital_velocity_kms FROM sound",
    "diurnal_adjust": f"""SELECT event_id, {r6(f"latency_ms / {_DIURNAL}")} AS base_latency_ms,
  {r6(f"throughput_mbps * {_DIURNAL}")} AS base_throughput_mbps FROM performance""",
    "round_half_up_2": f"""SELECT event_id, {r2("latency_ms / 8.0::DOUBLE")} AS rounded
FROM performance""",
    "impute_velocity_mean": "SELECT event_id, "
    + r6("coalesce(velocity, (SELECT avg(velocity) FROM telemetry))")
    + " AS velocity FROM telemetry",
    "hourly_coverage_stats": "SELECT * FROM coverage_hours",
    "hourly_performance_stats": "SELECT * FROM performance_hours",
    "hourly_satellite_stats": "SELECT * FROM satellite_hours",
    "hourly_satellite_stats_of_clean_rows": "SELECT * FROM satellite_hours",
    "status_counts": "SELECT "
    + ", ".join(
        f"count(CASE WHEN status = '{s}' THEN 1 END) AS {s}_count"
        for s in ("operational", "maintenance", "standby", "unknown")
    )
    + " FROM sound",
    "fleet_summary": f"""SELECT coalesce(CAST(sum(total_satellites) AS BIGINT), 0) AS total,
  coalesce(CAST(sum(operational_count) AS BIGINT), 0) AS operational,
  {mean("avg_altitude")} AS avg_altitude
FROM satellite_stats WHERE {recent("satellite_stats", 24)}""",
    "coverage_by_region": f"""SELECT region_id AS region,
  {mean("avg_coverage_percentage")} AS avg_coverage, {mean("avg_satellite_count")} AS avg_satellites
FROM coverage_stats WHERE {recent("coverage_stats", 24)} GROUP BY region_id""",
    "performance_by_region": f"""SELECT region, {mean("avg_latency_ms")} AS avg_latency,
  {mean("avg_throughput_mbps")} AS avg_throughput,
  {mean("avg_availability_percentage")} AS avg_availability
FROM performance_stats WHERE {recent("performance_stats", 24)} GROUP BY region""",
    "dashboard_summary": (_SUMMARY_CTES, _SUMMARY_ROWS),
    "dashboard_summary_nested": (
        _SUMMARY_CTES,
        """SELECT total, operational, avg_altitude, region, avg_coverage, avg_satellites, avg_latency,
  avg_throughput, avg_availability FROM fleet, by_coverage JOIN by_performance USING (region)""",
    ),
    "row_counts": """SELECT 'extracted' AS dataset, count(*) AS row_count FROM telemetry
UNION ALL SELECT 'cleaned', count(*) FROM sound""",
    "distinct_regions": "SELECT DISTINCT region_id FROM coverage",
    "join_coverage_performance": """SELECT coalesce(c.region_id, p.region) AS region,
  coalesce(c.ts, p.ts) AS ts, c.region_name, c.coverage_percentage, c.satellite_count,
  c.avg_signal_strength, p.latency_ms, p.throughput_mbps, p.availability_percentage
FROM coverage c FULL OUTER JOIN performance p ON c.region_id = p.region AND c.ts = p.ts""",
    "region_coverage_of_crowded_regions": (
        """,
places AS (
  SELECT concat('C', c_custkey) AS region_id, c_name AS region_name,
         30.0::DOUBLE + CAST(c_custkey * 37 % 1000 AS DOUBLE) / 500.0::DOUBLE AS lat0,
         10.0::DOUBLE + CAST(c_custkey * 91 % 1009 AS DOUBLE) / 300.0::DOUBLE AS lon0
  FROM customer
),
days AS (SELECT DISTINCT date_trunc('day', ts) AS ts FROM telemetry),
seen AS (SELECT date_trunc('day', ts) AS ts, latitude, longitude, count(*) AS n FROM telemetry GROUP BY ALL),
near AS (
  SELECT region_id, ts, sum(n) AS n FROM seen JOIN places
    ON sqrt((latitude - lat0) * (latitude - lat0) + (longitude - lon0) * (longitude - lon0)) * 111.0::DOUBLE < 2000.0::DOUBLE
  GROUP BY region_id, ts
),
counted AS (
  SELECT p.region_id, p.region_name, d.ts, CAST(coalesce(n.n, 0) AS BIGINT) AS satellite_count
  FROM days d CROSS JOIN places p LEFT JOIN near n ON n.region_id = p.region_id AND n.ts = d.ts
)""",
        "SELECT *, "
        + r2("least(100.0::DOUBLE, CAST(satellite_count AS DOUBLE) / 10.0::DOUBLE * 100.0::DOUBLE)")
        + " AS coverage_percentage FROM counted",
    ),
    "join_stored_coverage_performance": """SELECT coalesce(c.region, p.region) AS region,
  coalesce(c.ts, p.ts) AS ts, c.region_name, c.coverage_percentage, c.satellite_count,
  c.avg_signal_strength, p.latency_ms, p.throughput_mbps, p.availability_percentage
FROM (SELECT *, CASE WHEN event_id % 41 <> 0 THEN region_id END AS region FROM coverage) c
FULL OUTER JOIN (SELECT * REPLACE (CASE WHEN event_id % 41 <> 0 THEN region END AS region) FROM performance) p
  ON c.region = p.region AND c.ts = p.ts""",
    "dashboard_view": """SELECT c.region_id, c.time_window_start,
  CAST(c.avg_coverage_percentage AS DOUBLE) AS avg_coverage_percentage,
  CAST(c.avg_satellite_count AS DOUBLE) AS avg_satellite_count,
  CAST(p.avg_latency_ms AS DOUBLE) AS avg_latency_ms,
  CAST(p.avg_throughput_mbps AS DOUBLE) AS avg_throughput_mbps,
  CAST(p.avg_availability_percentage AS DOUBLE) AS avg_availability_percentage
FROM coverage_stats c LEFT JOIN performance_stats p
  ON c.region_id = p.region AND c.time_window_start = p.time_window_start""",
    "region_coverage_from_positions": (
        _REGION_CTES,
        "SELECT region_id, region_name, ts, coverage_percentage, satellite_count FROM shares",
    ),
    "insert_absent_rows": """SELECT region_id, time_window_start, coverage_percentage,
  satellite_count, avg_signal_strength
FROM (SELECT region_id, date_trunc('hour', ts) AS time_window_start, coverage_percentage,
             satellite_count, avg_signal_strength,
             row_number() OVER (PARTITION BY region_id, date_trunc('hour', ts)
               ORDER BY coverage_percentage NULLS FIRST, satellite_count, avg_signal_strength) AS n
      FROM coverage) ranked
WHERE n = 1 AND time_window_start >= TIMESTAMP '2024-01-15 12:00:00'""",
    "time_spine": (_SPINE_CTES, "SELECT * FROM grid"),
    "missing_windows": (
        _SPINE_CTES,
        "SELECT * FROM grid EXCEPT SELECT region_id, time_window_start FROM hours",
    ),
    "recent_satellite_stats": f"""SELECT time_window_start, {as_doubles(_SATELLITE_TYPES)}
FROM satellite_stats WHERE {recent("satellite_stats", 720)}
ORDER BY satellite_stats.time_window_start DESC LIMIT 100""",
    "recent_coverage_region": f"""SELECT region_id, time_window_start, {_COVERAGE_REPORT}
FROM coverage_stats WHERE region_id = 'EU' AND {recent("coverage_stats", 720)}
ORDER BY time_window_start DESC LIMIT 100""",
    "recent_coverage_all": f"""SELECT region_id, time_window_start, {_COVERAGE_REPORT}
FROM coverage_stats WHERE {recent("coverage_stats", 720)}
ORDER BY region_id, time_window_start DESC LIMIT 500""",
    "recent_performance_region": f"""SELECT region, time_window_start, {_PERFORMANCE_REPORT}
FROM performance_stats WHERE region = 'AS' AND {recent("performance_stats", 720)}
ORDER BY time_window_start DESC LIMIT 100""",
    "recent_performance_all": f"""SELECT region, time_window_start, {_PERFORMANCE_REPORT}
FROM performance_stats WHERE {recent("performance_stats", 720)}
ORDER BY region, time_window_start DESC LIMIT 500""",
    "coverage_series": f"""SELECT region_id,
  CAST(row_number() OVER (PARTITION BY region_id ORDER BY time_window_start) - 1 AS INTEGER) AS position,
  time_window_start, CAST(avg_coverage_percentage AS DOUBLE) AS avg_coverage_percentage
FROM (SELECT * FROM coverage_stats WHERE {recent("coverage_stats", 48)}
      ORDER BY region_id, time_window_start DESC) report""",
    "performance_trend": (
        f""",
report AS (SELECT * FROM performance_stats WHERE {recent("performance_stats", 720)}
           ORDER BY region, time_window_start DESC)""",
        """SELECT region, time_window_start, CAST(avg_latency_ms AS DOUBLE) AS avg_latency_ms,
  CAST(avg_throughput_mbps AS DOUBLE) AS avg_throughput_mbps
FROM report WHERE region = (SELECT min(region) FROM report)""",
    ),
    "write_parquet_partitioned": "SELECT * FROM coverage",
    "write_modes": "SELECT * FROM performance UNION ALL SELECT * FROM performance",
    "processed_layout": """SELECT 'satellite_data' AS dataset,
  concat(year(ts), '-', month(ts), '-', day(ts)) AS folder, count(*) AS row_count
FROM telemetry GROUP BY year(ts), month(ts), day(ts)
UNION ALL SELECT 'coverage_data', region_id, count(*) FROM coverage GROUP BY region_id
UNION ALL SELECT 'performance_metrics', region, count(*) FROM performance GROUP BY region""",
    "append_absent_twice": "SELECT region, time_window_start, time_window_end, "
    + ", ".join(
        "CAST(avg_latency_ms + CASE WHEN time_window_start < TIMESTAMP '2024-01-15 12:00:00'"
        " THEN 1 ELSE 0 END AS DOUBLE) AS avg_latency_ms"
        if c == "avg_latency_ms"
        else f"CAST({c} AS DOUBLE) AS {c}"
        for c in _PERFORMANCE_TYPES
    )
    + " FROM performance_stats",
    "load_all_outputs": _ALL_OUTPUTS,
    "transform_all_outputs": _ALL_OUTPUTS,
    "export_raw_round_trip": "\nUNION ALL ".join(_raw_in_full(f"'{f}' AS file_format, ") for f in ("csv", "json", "parquet")),
    "extract_all_json": _raw_in_full(),
    "transform_all_detail": f"""SELECT satellite_id, ts AS "timestamp", latitude, longitude, altitude,
  {r6("velocity")} AS velocity, status, {_METRICS} FROM cleaned""",
    "batch_run": _ALL_OUTPUTS,
    "scan_since": f"SELECT * FROM coverage WHERE {recent('coverage', 72, 'ts')}",
    "row_counts_reconciled": "\nUNION ALL ".join(
        f"SELECT 'month' AS batch, '{o}' AS output, {n} AS entered, {n} AS held FROM {t}"
        for o, t, n in (
            ("satellite", "sound", "count(*)"), ("coverage", "coverage", "count(*)"), ("performance", "performance", "count(*)"),
            ("rejected/satellite_data", "telemetry", "count(*) - count(*)"), ("rejected/coverage_data", "coverage", "count(*) - count(*)"),
            ("rejected/performance_metrics", "performance", "count(*) - count(*)"),
        )
    ),
    "batch_run_repeated": _outputs(_UNFILLED_ROW),
    "hourly_stats_of_batches": _STATS_OUTPUTS,
    "scan_json_arrays": f"SELECT {_COVERAGE_FILE} FROM coverage UNION ALL SELECT {_COVERAGE_FILE} FROM coverage",
    "scan_rejects_json": """SELECT concat('{"satellite_count": ', satellite_count, ', "region_id": "', region_id,
  '", "coverage_percentage": ', CASE WHEN event_id % 11 = 0 THEN '"n/a"' ELSE '' END, '}') AS _corrupt_record
FROM coverage WHERE event_id % 11 = 0 OR event_id % 7 = 0""",
}


def _statement(body: tuple[str, str] | str) -> str:
    extra, select = body if isinstance(body, tuple) else ("", body)
    return f"{PRELUDE}{extra}\n{select}"


ORACLES: dict[str, str] = {name: _statement(body) for name, body in _BODIES.items()}
