"""Check queries for the partition-space operators P1–P9.

Dates leave the check projections as ISO strings so both engines hash the
same text; the library functions themselves return ``DateType``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.timefn import ts_lit
from tessera.operators import partitions as P
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.sources import testviews as V

# P2's fixed "now": 23:30 UTC is already the next day in Amsterdam.
P2_NOW = "2024-01-19 23:30:00"

_DAYS_SQL = """unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY))"""


@register("days_inclusive", with_views(f"""
SELECT name, CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM (SELECT name, {_DAYS_SQL} AS d FROM v_backfills) t""", "v_backfills"))
def q_days_inclusive(spark, d):
    return P.days_inclusive(V.backfills(spark, d)).select("name", F.col("date").cast("string").alias("date"))


@register("days_closed", with_views(f"""
SELECT name, CAST(CAST(d AS DATE) AS VARCHAR) AS date
FROM (SELECT name, unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(upper AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM (SELECT name, start_date,
                   CASE WHEN end_excl IS NULL THEN last_day ELSE least(last_day, end_excl - 1) END AS upper
            FROM (SELECT name, start_date,
                         CASE WHEN request_id % 3 = 0 THEN NULL ELSE end_date + 1 END AS end_excl,
                         CAST(timezone('Europe/Amsterdam', TIMESTAMPTZ '{P2_NOW}+00') AS DATE) - 1 AS last_day
                  FROM v_backfills) a) b) c""", "v_backfills"))
def q_days_closed(spark, d):
    req = V.backfills(spark, d).withColumn(
        "end_excl", F.when(F.col("request_id") % 3 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add("end_date", 1)))
    out = P.days_closed(req, ts_lit(P2_NOW), start="start_date", end="end_excl")
    return out.select("name", F.col("date").cast("string").alias("date"))


@register("static_values", with_views("""
SELECT name, unnest(stations) AS station FROM v_backfills""", "v_backfills"))
def q_static_values(spark, d):
    return P.static_values(V.backfills(spark, d)).select("name", "station")


@register("partition_grid", with_views(f"""
SELECT name, CAST(CAST(d AS DATE) AS VARCHAR) AS daily, station AS stations
FROM (SELECT name, {_DAYS_SQL} AS d, stations FROM v_backfills) t, unnest(t.stations) u(station)""",
                                       "v_backfills"))
def q_partition_grid(spark, d):
    g = P.partition_grid(V.backfills(spark, d), {"daily": ("start_date", "end_date")}, {"stations": "stations"})
    return g.select("name", F.col("daily").cast("string").alias("daily"), "stations")


@register("partition_key_encode", with_views(f"""
SELECT name, CAST(CAST(d AS DATE) AS VARCHAR) || '|' || station AS partition_key
FROM (SELECT name, {_DAYS_SQL} AS d, stations FROM v_backfills) t, unnest(t.stations) u(station)""",
                                             "v_backfills"))
def q_partition_key_encode(spark, d):
    g = P.partition_grid(V.backfills(spark, d), {"daily": ("start_date", "end_date")}, {"stations": "stations"})
    # Dimensions are passed in reverse on purpose: ordering is by name.
    return P.with_partition_key(g, ["stations", "daily"]).select("name", "partition_key")


@register("partition_key_decode", with_views("""
SELECT partition_key, CAST(date AS VARCHAR) AS daily, station_number AS stations FROM v_meas_ledger""",
                                             "v_meas_ledger"))
def q_partition_key_decode(spark, d):
    keys = V.measurement_ledger(spark, d).select("partition_key")
    return P.split_partition_key(keys, "partition_key", ["daily", "stations"])


@register("map_day_to_multi", with_views("""
SELECT CAST(d.date AS VARCHAR) AS daily_key, l.partition_key AS upstream_key
FROM (SELECT DISTINCT date FROM v_meas_ledger) d JOIN v_meas_ledger l ON l.date = d.date""",
                                         "v_meas_ledger"))
def q_map_day_to_multi(spark, d):
    led = V.measurement_ledger(spark, d)
    daily = led.select("date").distinct()
    return P.map_day_to_multi(daily, led.select("date", "partition_key"))


@register("map_multi_to_day", with_views("""
SELECT partition_key AS upstream_key, CAST(date AS VARCHAR) AS daily_key FROM v_meas_ledger""",
                                         "v_meas_ledger"))
def q_map_multi_to_day(spark, d):
    keys = V.measurement_ledger(spark, d).select("partition_key")
    return P.map_multi_to_day(keys).select(F.col("partition_key").alias("upstream_key"), "daily_key")


@register("validate_backfills", with_views("""
SELECT name, errors, CAST(CASE WHEN errors = '' THEN 0 ELSE len(string_split(errors, ';')) END AS INTEGER) AS n_errors,
       errors = '' AS valid
FROM v_backfill_errors""", "v_backfill_errors"))
def q_validate_backfills(spark, d):
    v = P.validate_backfills(V.backfills(spark, d))
    return v.select("name", F.array_join("errors", ";").alias("errors"),
                    F.size("errors").alias("n_errors"), "valid")
