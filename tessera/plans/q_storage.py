"""Check queries for the storage operators B1–B11.

Read-side queries share one landing table per (application, dataset),
written once into the shared folder; writer queries write their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timefn import day_bounds, ts_lit
from tessera.plans.q_ledger import GRID_SQL, measurement_grid
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import MEASUREMENTS, STATION, STATION_DETAIL
from tessera.session import app_id, scratch_path
from tessera.sources import storage as B
from tessera.sources import testviews as V

ASSET = "air_quality_data"
PCOLS = ["date", "station_number"]
_LAKES: dict[tuple[str, str], str] = {}


def landing_rows(spark: SparkSession, d: str) -> DataFrame:
    """Measurements as the landing zone stores them (request bounds added)."""
    m = V.measurements(spark, d)
    start, end = day_bounds("date")
    return m.withColumn("start", start).withColumn("end", end)


def shared_landing(spark: SparkSession, d: str) -> str:
    """Root of a landing lake holding every measurement partition of ``d``."""
    key = (app_id(spark), d)
    if key not in _LAKES:
        root = scratch_path(spark, "landing")
        B.write_partitioned(landing_rows(spark, d), root, ASSET, PCOLS, MEASUREMENTS)
        _LAKES[key] = root
    return _LAKES[key]


def _rows_out(df: DataFrame) -> DataFrame:
    return df.select("station_number", F.col("date").cast("string").alias("date"), "formula", "value",
                     F.unix_micros("timestamp_measured").alias("ts_us"), "start", "end")


_ROWS_SQL = """station_number, CAST(date AS VARCHAR) AS date, formula, value, epoch_us(timestamp_measured) AS ts_us,
       CAST(date AS VARCHAR) || 'T00:00:00' AS start, CAST(date AS VARCHAR) || 'T23:59:59' AS "end\""""

OVERWRITE_DAY = "2024-01-01"


@register("write_partitioned", with_views(f"""
SELECT CAST(date AS VARCHAR) AS date, count(*) AS n_rows,
       round(sum(CASE WHEN date = DATE '{OVERWRITE_DAY}' THEN value * 2 ELSE value END), 2) AS sum_value
FROM v_measurements GROUP BY date""", "v_measurements"))
def q_write_partitioned(spark, d):
    """Write all partitions, then rewrite one day (values doubled): only that
    day's partitions change, all others survive."""
    root = scratch_path(spark, "b1")
    rows = landing_rows(spark, d)
    B.write_partitioned(rows, root, ASSET, PCOLS, MEASUREMENTS)
    day = rows.filter(F.col("date") == F.lit(OVERWRITE_DAY).cast("date")).withColumn("value", F.col("value") * 2)
    B.write_partitioned(day, root, ASSET, PCOLS, MEASUREMENTS)
    back = B.read_all_partitions(spark, root, ASSET, MEASUREMENTS)
    return (back.groupBy(F.col("date").cast("string").alias("date"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("sum_value")))


@register("partition_versions", with_views(f"""
SELECT v.version, CAST(date AS VARCHAR) AS date, count(*) AS n_rows,
       round(sum(CASE WHEN v.version = 2 AND date = DATE '{OVERWRITE_DAY}' THEN value * 2 ELSE value END), 2) AS sum_value
FROM v_measurements, (SELECT 1 AS version UNION ALL SELECT 2 UNION ALL SELECT 3) v
WHERE v.version < 3 OR date <> DATE '{OVERWRITE_DAY}' GROUP BY v.version, date""", "v_measurements"))
def q_partition_versions(spark, d):
    """Write all partitions, rewrite one day with doubled values, then empty it: each version reads as it was."""
    root = scratch_path(spark, "b1v")
    rows = landing_rows(spark, d)
    day = rows.filter(F.col("date") == F.lit(OVERWRITE_DAY).cast("date"))
    versions = [B.publish_partitions(rows, root, ASSET, PCOLS, MEASUREMENTS),
                B.publish_partitions(day.withColumn("value", F.col("value") * 2), root, ASSET, PCOLS, MEASUREMENTS),
                B.publish_partitions(day.limit(0), root, ASSET, PCOLS, MEASUREMENTS, keys=day.select(*PCOLS))]
    out = None
    for v in versions:
        back = B.read_all_partitions(spark, root, ASSET, MEASUREMENTS, v).withColumn("version", F.lit(v))
        out = back if out is None else out.unionByName(back)
    return (out.groupBy("version", F.col("date").cast("string").alias("date"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("sum_value")))


@register("write_unpartitioned", with_views("SELECT number, location FROM v_stations", "v_stations"))
def q_write_unpartitioned(spark, d):
    """Write the station table twice (replace, not append) and read it back."""
    root = scratch_path(spark, "b2")
    st = V.stations(spark, d)
    B.write_unpartitioned(st, root, "air_quality_station_names", STATION)
    B.write_unpartitioned(st, root, "air_quality_station_names", STATION)
    return B.read_unpartitioned(spark, root, "air_quality_station_names", STATION)


@register("write_sized_files", with_views("""
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS files_over_limit FROM v_measurements""", "v_measurements"))
def q_write_sized_files(spark, d):
    """Rows per written file never exceed the limit, here 1,000 rows."""
    root = scratch_path(spark, "b3")
    path = B.write_unpartitioned(landing_rows(spark, d), root, ASSET, MEASUREMENTS, max_records_per_file=1000)
    counts = B.file_row_counts(spark, path)
    return counts.agg(F.sum("row_count").alias("total_rows"),
                      F.count_if(F.col("row_count") > 1000).alias("files_over_limit"))


@register("read_partitions_strict", with_views(f"SELECT {_ROWS_SQL} FROM v_measurements", "v_measurements"))
def q_read_partitions_strict(spark, d):
    root = shared_landing(spark, d)
    keys = V.measurement_ledger(spark, d).select(F.col("date").cast("string").alias("date"), "station_number")
    return _rows_out(B.read_partitions_strict(spark, root, ASSET, keys, MEASUREMENTS, PCOLS))


@register("read_partitions_lenient", with_views(f"""
SELECT {_ROWS_SQL} FROM v_measurements m
WHERE NOT EXISTS (SELECT 1 FROM v_parts p WHERE p.has_error = 1 AND p.date = m.date
                  AND p.station_number = m.station_number)""", "v_measurements", "v_parts"))
def q_read_partitions_lenient(spark, d):
    """Request the whole grid; partitions whose latest status is FAILED (a
    failed rerun) or that never ran are skipped."""
    root = shared_landing(spark, d)
    grid = measurement_grid(spark, d)
    ledger = V.measurement_ledger(spark, d, failed_reruns=True)
    return _rows_out(B.read_partitions_lenient(spark, root, ASSET, grid, ledger, MEASUREMENTS, PCOLS))


@register("missing_on_load", with_views("""
SELECT CAST(g.date AS VARCHAR) AS date, g.station_number
FROM grid g
WHERE g.partition_key NOT IN (
  SELECT partition_key FROM (
    SELECT partition_key, arg_max(status, (event_time, event_id)) AS status
    FROM v_meas_ledger_rr GROUP BY partition_key) s WHERE status = 'MATERIALIZED')""",
                                        "v_stations", "v_meas_ledger_rr", extra={"grid": GRID_SQL}))
def q_missing_on_load(spark, d):
    grid = measurement_grid(spark, d)
    ledger = V.measurement_ledger(spark, d, failed_reruns=True)
    out = B.missing_on_load(grid, ledger, ASSET, PCOLS)
    return out.select(F.col("date").cast("string").alias("date"), "station_number")


@register("read_unpartitioned", with_views("""
SELECT number, location, array_to_string(components, ',') AS components, CAST(first_seen AS VARCHAR) AS first_seen
FROM v_station_details""", "v_station_details"))
def q_read_unpartitioned(spark, d):
    root = scratch_path(spark, "b7")
    B.write_unpartitioned(V.station_details(spark, d), root, "station_details", STATION_DETAIL)
    back = B.read_unpartitioned(spark, root, "station_details", STATION_DETAIL)
    return back.select("number", "location", F.array_join("components", ",").alias("components"),
                       F.col("first_seen").cast("string").alias("first_seen"))


@register("read_all_partitions", with_views("SELECT number, location FROM v_stations", "v_stations"))
def q_read_all_partitions(spark, d):
    """Station table written one partition per station, read back as one."""
    root = scratch_path(spark, "b8")
    B.write_partitioned(V.stations(spark, d), root, "station_names", ["number"], STATION, buckets=16)
    return B.read_all_partitions(spark, root, "station_names", STATION).select("number", "location")


LOCATIONS_SQL = """
SELECT c_custkey, CASE c_custkey % 4
    WHEN 0 THEN 'gs://bucket-' || c_nationkey || '/landing/' || lower(c_mktsegment) || '/' || c_custkey || '/'
    WHEN 1 THEN '/data/lake/' || lower(c_mktsegment) || '/' || c_custkey
    WHEN 2 THEN 's3://bucket-' || c_nationkey || '/raw/' || lower(c_mktsegment)
    ELSE 'minio://bucket-' || c_nationkey || '/x' END AS location
FROM customer"""


def locations(spark: SparkSession, d: str) -> DataFrame:
    """One storage location per customer, in four URI styles."""
    c = V.table(spark, d, "customer")
    k, seg = F.col("c_custkey"), F.lower(F.col("c_mktsegment"))
    b = F.concat(F.lit("bucket-"), F.col("c_nationkey").cast("string"))
    loc = (F.when(k % 4 == 0, F.concat(F.lit("gs://"), b, F.lit("/landing/"), seg, F.lit("/"), k.cast("string"), F.lit("/")))
           .when(k % 4 == 1, F.concat(F.lit("/data/lake/"), seg, F.lit("/"), k.cast("string")))
           .when(k % 4 == 2, F.concat(F.lit("s3://"), b, F.lit("/raw/"), seg))
           .otherwise(F.concat(F.lit("minio://"), b, F.lit("/x"))))
    return c.select("c_custkey", loc.alias("location"))


@register("classify_location", with_views("""
SELECT location, scheme,
       CASE WHEN scheme = 'gs' THEN 'gcs' WHEN scheme = '' THEN 'local' END AS storage_type,
       CASE WHEN scheme = 'gs' THEN regexp_extract(location, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) END AS bucket,
       CASE WHEN scheme = 'gs' THEN trim(regexp_extract(location, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/') END AS prefix,
       scheme IN ('s3', 's3a', 'gs') AS is_remote,
       scheme IN ('gs', '') AS supported
FROM (SELECT location, lower(regexp_extract(location, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1)) AS scheme FROM locs) t""",
                                          extra={"locs": LOCATIONS_SQL}))
def q_classify_location(spark, d):
    return B.classify_location(locations(spark, d)).drop("c_custkey")


@register("list_partition_files", with_views("""
SELECT DISTINCT CAST(date AS VARCHAR) AS date, station_number FROM v_measurements""", "v_measurements"))
def q_list_partition_files(spark, d):
    return B.list_partition_files(spark, shared_landing(spark, d), ASSET, PCOLS)


@register("output_metadata", with_views("""
SELECT 'air_quality_data' AS asset_key, CAST(date AS VARCHAR) || '|' || station_number AS partition_key,
       'MATERIALIZED' AS status, count(*) AS row_count, CAST(count(*) AS BIGINT) * 0 + 1 AS n_files
FROM v_measurements GROUP BY date, station_number""", "v_measurements"))
def q_output_metadata(spark, d):
    root = shared_landing(spark, d)
    meta = B.output_metadata(spark, B.asset_path(root, ASSET), ASSET, PCOLS, ts_lit("2024-01-31 00:00:00"), MEASUREMENTS)
    return (meta.groupBy("asset_key", "partition_key", "status")
            .agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("n_files")))
