"""Table layouts and fixed values shared by every module.

One layout drives reading, writing and table registration, so the stored files
and the registered table cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATION_KEYS = ("dt", "sensor_id")
MEASURES = ("temperature_max", "temperature_min", "precipitation")

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.StringType(), False),
        T.StructField("sensor_id", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("temperature_max", T.DoubleType(), True),
        T.StructField("temperature_min", T.DoubleType(), True),
        T.StructField("precipitation", T.DoubleType(), True),
        T.StructField("source", T.StringType(), False),
        T.StructField("ingestion_timestamp", T.StringType(), False),
    ]
)

DERIVED_SCHEMA = T.StructType(
    [
        T.StructField("temperature_max_f", T.DoubleType(), True),
        T.StructField("temperature_min_f", T.DoubleType(), True),
        T.StructField("temperature_range", T.DoubleType(), True),
        T.StructField("temperature_avg", T.DoubleType(), True),
        T.StructField("temp_category", T.StringType(), True),
        T.StructField("precipitation_level", T.StringType(), True),
        T.StructField("is_complete", T.BooleanType(), True),
        T.StructField("data_quality_score", T.IntegerType(), True),
        T.StructField("processed_at", T.TimestampType(), True),
        T.StructField("processing_version", T.StringType(), True),
        T.StructField("region_avg_temp", T.DoubleType(), True),
        T.StructField("region_total_precipitation", T.DoubleType(), True),
    ]
)

TRANSFORMED_SCHEMA = T.StructType(OBSERVATION_SCHEMA.fields + DERIVED_SCHEMA.fields)

# What a landed response says of its request, and the response itself.
PAYLOAD_REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

REQUIRED_FIELDS = tuple(f.name for f in OBSERVATION_SCHEMA.fields if not f.nullable)

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("last_processed_date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("execution_id", T.StringType()),
    ]
)

RUN_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("last_processed_date", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("num_sensors", T.LongType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("failed_fetches", T.LongType()),
        T.StructField("data_quality_rate", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("execution_id", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

HEALTH_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("rate_limit_remaining", T.StringType()),
        T.StructField("rate_limit_limit", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("execution_id", T.StringType()),
    ]
)

# Labels, thresholds and defaults that results depend on.
UNKNOWN_SENSOR = "UNKNOWN"
UNASSIGNED_REGION = "UNASSIGNED"
PAYLOAD_SOURCE = "open-meteo"
PROCESSING_VERSION = "1.0"
TEMPERATURE_BANDS = ((0, "freezing"), (10, "cold"), (20, "mild"), (30, "warm"))
TEMPERATURE_TOP_BAND = "hot"
PRECIPITATION_BANDS = ((2.5, "light"), (10, "moderate"), (50, "heavy"))
PRECIPITATION_TOP_BAND = "extreme"
PRECIPITATION_MISSING = "unknown"
PRECIPITATION_ZERO = "none"
SCORE_COMPLETE = 100
SCORE_TEMPERATURE_ONLY = 75
SCORE_NO_TEMPERATURE = 25
GRID_SPAN_DEGREES = 0.5
ROWS_PER_FILE = 100_000
MAX_DAYS_PER_REQUEST = 16
LOOKBACK_DAYS = 30
HIGH_LATENCY_MS = 5000
LOW_RATE_LIMIT_SHARE = 0.1
FAILURE_ALERT_SHARE = 0.1
COLD_AFTER_DAYS = 90
EXPIRE_AFTER_DAYS = 455
STALE_AFTER_HOURS = 24
