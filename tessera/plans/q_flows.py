"""Check queries for the flows G1–G6 (run end to end on the test tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timefn import ts_lit
from tessera.plans import flows as G
from tessera.plans.q_freshness import VERSION_SQL
from tessera.plans.q_ledger import GRID_SQL, LEDGER_AS_OF, PLAN_SQL, RECONCILE_SQL, measurement_grid
from tessera.plans.q_sources import measurement_pages, short_times
from tessera.plans.q_storage import shared_landing
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import STATION_DETAIL
from tessera.session import scratch_path
from tessera.sources import fetch as S
from tessera.sources import testviews as V

G1_NOW = "2024-01-31 06:00:00"
G6_NOW = "2024-01-31 07:00:00"


def g1_replay(spark: SparkSession, d: str, path: str) -> None:
    """Saved answers for the whole grid, one record a page.  Without data: HTTP
    500 on odd days and 429 on even days.  With data, by the first record's id
    modulo 17: 1 page 2 is 429, 2 page 2 is 500, 3 page 1 is 206 (fine), 4 page 2
    points back to page 1, 5 the body of page 1 is cut off, 6 times have no more
    fraction digits than they need and an offset, 7 values are strings, 8 page 1
    holds an object instead of a list, 9 a number stands beside the records."""
    first = V.measurement_ledger(spark, d).select(F.col("partition_key").alias("request_id"),
                                                  (F.floor(F.col("event_id") / 2) % 17).alias("_rule"))
    pages = measurement_pages(spark, d, page_size=1).join(first, "request_id")
    rule, second, head = F.col("_rule"), F.col("page") == 2, F.col("page") == 1
    status = (F.when(second & (rule == 1), 429).when(second & (rule == 2), 500).when(head & (rule == 3), 206)
              .otherwise(F.col("status")))
    body = (F.when(second & (rule == 4), F.regexp_replace("body", '"next_page":[0-9]+', '"next_page":1'))
            .when(head & (rule == 5), F.substring("body", 1, 40))
            .when(rule == 6, short_times("body"))
            .when(rule == 7, F.regexp_replace("body", '"value":([-0-9.E]+)', '"value":"$1"'))
            .when(head & (rule == 8), F.regexp_replace("body", r'"data":\[(.*)\]', '"data":$1'))
            .when(rule == 9, F.replace("body", F.lit('"data":['), F.lit('"data":[17,'))).otherwise(F.col("body")))
    pages = pages.select("request_id", "page", status.cast("int").alias("status"), body.alias("body"))
    grid = measurement_grid(spark, d)
    errors = (grid.join(first.select(F.col("request_id").alias("partition_key")), "partition_key", "left_anti")
              .select(F.col("partition_key").alias("request_id"), F.lit(1).alias("page"),
                      F.when(F.dayofmonth("date") % 2 == 1, F.lit(500)).otherwise(F.lit(429)).alias("status"),
                      F.lit(None).cast("string").alias("body")))
    pages.unionByName(errors).write.parquet(path)


@register("landing_measurements", with_views(f"""
SELECT partition_key, CASE WHEN outcome = 'ok' THEN 'MATERIALIZED' ELSE 'FAILED' END AS status,
       CASE WHEN outcome = 'ok' THEN n_rows ELSE 0 END AS row_count,
       CASE WHEN outcome = 'ok' THEN CAST(n_rows AS VARCHAR) || '-' || CAST(h1 AS VARCHAR) || '-' || CAST(h2 AS VARCHAR) END AS data_version
FROM (SELECT g.partition_key, v.*,
             CASE WHEN v.n_rows IS NULL THEN CASE WHEN dayofmonth(g.date) % 2 = 1 THEN 'failed' ELSE 'due' END
                  WHEN p.first_id % 17 IN (1, 4) AND p.n >= 2 THEN 'due'
                  WHEN p.first_id % 17 = 2 AND p.n >= 2 THEN 'failed'
                  WHEN p.first_id % 17 IN (5, 8) THEN 'failed' ELSE 'ok' END AS outcome
      FROM grid g LEFT JOIN ({VERSION_SQL.replace('FROM src', 'FROM v_measurements')}) v
        ON v.date = g.date AND v.station_number = g.station_number
      LEFT JOIN v_parts p ON p.date = g.date AND p.station_number = g.station_number) o
WHERE outcome <> 'due'""", "v_stations", "v_measurements", "v_parts", extra={"grid": GRID_SQL}))
def q_landing_measurements(spark, d):
    root = scratch_path(spark, "g1")
    g1_replay(spark, d, f"{root}/replay")
    events = G.landing_measurements(spark, measurement_grid(spark, d), f"{root}/lake", f"{root}/ledger", ts_lit(G1_NOW),
                                    {"transport": "replay", "replay": f"{root}/replay"})
    return events.select("partition_key", "status", "row_count", "data_version")


@register("bronze_daily_measurements", with_views("""
SELECT CAST(d.date AS VARCHAR) AS date, coalesce(w.n_rows, 0) AS n_rows, coalesce(w.n_stations, 0) AS n_stations,
       coalesce(m.n_missing, 0) AS n_missing
FROM (SELECT DISTINCT date FROM v_measurements) d
LEFT JOIN (SELECT date, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_stations
           FROM v_parts WHERE has_error = 0 GROUP BY date) w ON w.date = d.date
LEFT JOIN (SELECT date, count(*) AS n_missing FROM grid
           WHERE partition_key NOT IN (SELECT CAST(date AS VARCHAR) || '|' || station_number FROM v_parts WHERE has_error = 0)
           GROUP BY date) m ON m.date = d.date""", "v_stations", "v_parts", extra={"grid": GRID_SQL}))
def q_bronze_daily_measurements(spark, d):
    """For each day: rows that reached bronze, from how many stations, and
    how many expected stations are missing.  Bronze is built twice, first
    while all partitions were materialized and then after reruns failed for
    those with an ``error`` measurement."""
    lake = shared_landing(spark, d)
    daily = V.measurements(spark, d).select("date").distinct()
    upstream = measurement_grid(spark, d).select("date", "partition_key")
    root = scratch_path(spark, "bronze")
    G.bronze_daily_measurements(spark, lake, V.measurement_ledger(spark, d), daily, upstream, root)
    out = G.bronze_daily_measurements(spark, lake, V.measurement_ledger(spark, d, failed_reruns=True), daily, upstream, root)
    return out.select("date", "n_rows", "n_stations", "n_missing")


def _stations_landed(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    root = scratch_path(spark, "g3")
    S.write_station_list(V.stations(spark, d), f"{root}/stations_json", per_file=64)
    det = V.station_details(spark, d)
    replay = det.select(F.concat(F.lit("stations/"), "number").alias("request_id"), F.lit(1).alias("page"),
                        F.lit(200).alias("status"),
                        F.to_json(F.struct(F.struct(*STATION_DETAIL.fieldNames()).alias("data"))).alias("body"))
    replay.write.parquet(f"{root}/replay")
    out = G.landing_stations(spark, f"{root}/stations_json", f"{root}/lake",
                             {"transport": "replay", "replay": f"{root}/replay"})
    return root, out


@register("landing_stations", with_views("""
SELECT number, location, array_to_string(components, ',') AS components, CAST(first_seen AS VARCHAR) AS first_seen
FROM v_station_details""", "v_station_details"))
def q_landing_stations(spark, d):
    _, out = _stations_landed(spark, d)
    return out.select("number", "location", F.array_join("components", ",").alias("components"),
                      F.col("first_seen").cast("string").alias("first_seen"))


@register("bronze_stations", with_views("SELECT number, location FROM v_stations", "v_stations"))
def q_bronze_stations(spark, d):
    root, _ = _stations_landed(spark, d)
    return G.bronze_stations(spark, f"{root}/lake", f"{root}/bronze")


@register("backfill_missing", with_views("""
SELECT name, 'submit' AS decision, partition_key, job_name AS detail FROM plan
UNION ALL
SELECT name, 'reject', NULL, errors FROM v_backfill_checked WHERE errors <> ''""", "v_backfill_checked", "v_meas_ledger",
                                         extra={"plan": PLAN_SQL}))
def q_backfill_missing(spark, d):
    return G.backfill_missing(V.backfills(spark, d), V.measurement_ledger(spark, d))


@register("report_storage", with_views(f"""
SELECT 'air_quality_data' AS asset_key, partition_key, 'MATERIALIZED' AS status FROM ({RECONCILE_SQL}) r""",
                                       "v_meas_ledger"))
def q_report_storage(spark, d):
    """The ledger as known at a cut-off is written to the shared folder; the
    storage report appends what the lake holds beyond it."""
    root = scratch_path(spark, "g6")
    known = V.measurement_ledger(spark, d).filter(F.col("event_time") < ts_lit(LEDGER_AS_OF))
    G.append_ledger(known, f"{root}/ledger")
    out = G.report_storage(spark, shared_landing(spark, d), "air_quality_data", f"{root}/ledger",
                           ts_lit(G6_NOW), ["date", "station_number"])
    return out.select("asset_key", "partition_key", "status")
