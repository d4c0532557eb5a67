"""Numbers and names that must be exactly these for results to agree."""

# Region centroids, in tie-break order: (region, latitude, longitude).
REGION_CENTROIDS = (
    ("central", 1.3521, 103.8198),
    ("north", 1.4180, 103.8270),
    ("south", 1.2800, 103.8500),
    ("east", 1.3500, 103.9400),
    ("west", 1.3400, 103.7000),
)
REGIONS = ("east", "west", "north", "south", "central")

# Particulate concentration -> air-quality index: straight lines between these points,
# evaluated at the whole part of the concentration, rounded half up, defined for 0..199.
# The points are those of the public definition of the air-quality index.
INDEX_BREAKPOINTS = ((0.0, 0.0), (12.0, 50.0), (35.5, 100.0), (55.5, 150.0), (150.5, 200.0), (250.5, 300.0))
INDEX_DOMAIN = 200

# Index bands: (exclusive upper bound, label); the last band is open.
INDEX_BANDS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Some"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
INDEX_TOP_BAND = "Hazardous"

LOCAL_ZONE = "Asia/Singapore"
UNKNOWN_STATION = "Unknown"
VALID_DIRECTION = (0.0, 360.0)
EARLIEST_DAY = "2016-01-01"

# Lags and windows, in rows of the series' own cadence.
DAILY_LAGS = (1, 2, 3, 4, 5, 6, 7, 14, 28)
DAILY_WINDOWS = (3, 7, 14, 28)
PM25_HOURLY_LAGS = (1, 2, 3, 6, 12, 24)
WEATHER_HOURLY_LAGS = (1, 2, 3, 6, 12, 24, 48, 72, 168)
HOURLY_WINDOWS = (6, 12, 24, 72, 168)
TARGET_LAGS = (1, 3, 6, 12, 24, 48, 72, 168)
TARGET_WINDOWS = (24, 72, 168)
TARGET_HORIZONS = (24, 48, 72, 96, 120, 144, 168)
SENSOR_LAGS = (1, 2, 3, 7)
SENSOR_WINDOWS = (3, 7)

# Expectations on column minima: (column, exclusive lower bound, inclusive upper bound).
SENSOR_EXPECTATIONS = (("pm25", -0.1, 500.0),)
WEATHER_EXPECTATIONS = (("precipitation_sum", -0.1, 1000.0), ("wind_speed_10m_max", -0.1, 1000.0))
MAX_NULLS_PER_SENSOR = 20

# Columns of a merged station file, in output order.
STATION_FILE_COLUMNS = (
    "timestamp", "station_name", "wind_speed_avg", "reading_count", "latitude", "longitude", "last_update",
)
# Columns of a raw reading dump that carry nothing the rollups use.
DUMP_COLUMNS_TO_DROP = ("update_timestamp", "station_id", "station_device_id", "reading_type", "reading_unit")
