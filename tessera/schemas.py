"""Declared schemas and the fixed values the ledger and run tables use.

Measurement columns are a declared design choice: the upstream JSON has no
fixed schema, so we fix one at write time and cast to it before every write.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the orchestrator's names for right results.
# ---------------------------------------------------------------------------
STATUS_MATERIALIZED = "MATERIALIZED"
STATUS_FAILED = "FAILED"
STATUS_IN_PROGRESS = "IN_PROGRESS"
RUN_SUCCESS = "SUCCESS"
RUN_FAILURE = "FAILURE"
RUN_STARTED = "STARTED"
TERMINAL_RUN_STATUSES = ("SUCCESS", "FAILURE")

TAG_PARTITION = "dagster/partition"
TAG_PARTITION_DIM_PREFIX = "dagster/partition/"
TAG_BACKFILL = "dagster/backfill"
TAG_SCHEDULE = "dagster/schedule_name"
TAG_AUTO_MATERIALIZE = "dagster/auto_materialize"
TAG_RUN_KEY = "dagster/run_key"
TAG_JOB_NAME = "manual/job_name"
TAG_CI_RUN_ID = "manual/github_actions_run_id"
TAG_CI_URL = "manual/github_actions_url"
TAG_TRIGGERED_BY = "manual/triggered_by"
TRIGGERED_BY_VALUE = "cicd"
TAG_DEFAULT = "NA"
LABEL_DEFAULT = "N/A"

SUCCESS_SERIES = "custom.googleapis.com/dagster/asset_success"
POLICIES = ("missing", "all")
FILE_TYPES = ("parquet",)
REMOTE_SCHEMES = ("s3", "s3a", "gs")
# Schemes a storage location may have; empty: a local path.
STORAGE_SCHEMES = ("gs", "")
LOCATION_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
KEY_SEPARATOR = "|"
DAY_START_SUFFIX = "T00:00:00"
DAY_END_SUFFIX = "T23:59:59"
PARTITION_TZ = "Europe/Amsterdam"
ROW_GROUP_ROWS = 100_000
RATE_CALLS = 100
RATE_MINUTES = 5
LIMITER_TRIES = 10
LIMITER_DELAY_S = 30
RETRY_MAX = 3
RETRY_DELAY_S = 30
UNFINISHED_SKIP_THRESHOLD = 15
FRESHNESS_MAX_LAG_MIN = 10
# ---------------------------------------------------------------------------

MEASUREMENTS = T.StructType([
    T.StructField("formula", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp_measured", T.TimestampType()),
    T.StructField("station_number", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),  # keys of the JSON that are not declared
    T.StructField("date", T.DateType()),
])

# One measurement object inside a page's ``data`` list.
MEASUREMENT_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("formula", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp_measured", T.TimestampType()),
])

PAGINATION = T.StructType([
    T.StructField("current_page", T.IntegerType()),
    T.StructField("next_page", T.IntegerType()),
])


def page_schema(record: T.StructType = MEASUREMENT_RECORD) -> T.StructType:
    """Envelope of one paginated response page."""
    return T.StructType([
        T.StructField("pagination", PAGINATION),
        T.StructField("data", T.ArrayType(record)),
    ])


STATION = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("location", T.StringType()),
])

STATION_DETAIL = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("components", T.ArrayType(T.StringType())),
    T.StructField("first_seen", T.DateType()),
])

LEDGER = T.StructType([
    T.StructField("asset_key", T.StringType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("data_version", T.StringType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("job_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("asset_selection", T.ArrayType(T.StringType())),
    T.StructField("location", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("update_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])

CALLS = T.StructType([
    T.StructField("bucket", T.StringType()),
    T.StructField("call_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
])
