"""Results depend on each of these being exactly as stated."""

# Raw status spellings accepted for each canonical status; anything else is "unknown".
STATUS_SPELLINGS = {
    "operational": ("operational", "active", "online"),
    "maintenance": ("maintenance", "offline", "inactive"),
    "standby": ("standby", "idle"),
}
UNKNOWN_STATUS = "unknown"

# Accepted position ranges. Coordinates include their bounds, altitude (km) excludes them.
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)
ALTITUDE_RANGE = (0, 2000)

# Orbital constants.
EARTH_RADIUS_KM = 6371.0
ORBITAL_PERIOD_MINUTES = 95.0
COVERAGE_RADIUS_PER_KM_ALTITUDE = 1.5
GRAVITATIONAL_CONSTANT = 6.67430e-11
EARTH_MASS_KG = 5.972e24

# Coverage model: planar distance, satellites needed for 100 %.
KM_PER_DEGREE = 111.0
VISIBLE_RANGE_KM = 2000.0
SATELLITES_FOR_FULL_COVERAGE = 10.0

# Time-of-day factor on latency and throughput: 1 + 0.2 * sin(hour * pi / 12).
DIURNAL_AMPLITUDE = 0.2
HOURS_PER_HALF_CYCLE = 12

# (region_id, name, latitude, longitude) of the default coverage regions.
REGIONS = (
    ("NA", "North America", 45.0, -100.0),
    ("EU", "Europe", 50.0, 10.0),
    ("AS", "Asia", 35.0, 100.0),
    ("SA", "South America", -15.0, -60.0),
    ("OC", "Oceania", -25.0, 135.0),
)

# Row limits of the recent-window reports, and their default span.
SINGLE_SERIES_LIMIT = 100
ALL_REGIONS_LIMIT = 500
DEFAULT_RECENT_HOURS = 24

# Longest region identifier the serving tables accept.
REGION_ID_WIDTH = 10
