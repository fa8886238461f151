"""Check queries for the fetch side S1–S8.

Page envelopes are built from the measurements with ``to_json`` (three
records per page), so flattening must give the measurements back exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.q_ledger import GRID_SQL, measurement_grid
from tessera.plans.registry import register
from tessera.plans.sqlviews import with_views
from tessera.schemas import STATION_DETAIL
from tessera.session import scratch_path
from tessera.sources import fetch as S
from tessera.sources import rest_source
from tessera.sources import testviews as V

PAGE_SIZE = 3
RECORD_COLS = ["event_id", "formula", "value", "timestamp_measured"]
REQ_SQL = "CAST(date AS VARCHAR) || '|' || station_number"


def measurement_pages(spark: SparkSession, d: str, page_size: int = PAGE_SIZE) -> DataFrame:
    m = V.measurements(spark, d).withColumn("request_id", F.concat_ws("|", F.col("date").cast("string"),
                                                                      "station_number"))
    return S.page_envelopes(m, "request_id", RECORD_COLS, ["timestamp_measured", "event_id"], page_size)


def short_times(body) -> F.Column:
    """Bodies whose times have only the fraction digits they need, and an offset instead of Z."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(body, r"\.0+Z", "Z"), r"(\.\d*[1-9])0+Z", "$1Z"), '(:\\d\\d(?:\\.\\d+)?)Z"', '$1+00:00"')


def _records_out(df: DataFrame) -> DataFrame:
    return df.select("request_id", "event_id", "formula", "value",
                     F.unix_micros("timestamp_measured").alias("ts_us"))


RECORDS_SQL = f"""SELECT {REQ_SQL} AS request_id, event_id, formula, value, epoch_us(timestamp_measured) AS ts_us
FROM v_measurements"""


@register("rest_pages_flatten", with_views(RECORDS_SQL, "v_measurements"))
def q_rest_pages_flatten(spark, d):
    """Every other page has times with only the fraction digits they need, and an offset."""
    pages = measurement_pages(spark, d)
    return _records_out(S.flatten_pages(pages.withColumn("body", F.when(F.col("page") % 2 == 0, short_times("body"))
                                                         .otherwise(F.col("body")))))


@register("rest_record_rejects", with_views(f"""
SELECT {REQ_SQL} AS request_id, event_id, CASE event_id % 5 WHEN 1 THEN 'value: not a double'
       WHEN 2 THEN 'timestamp_measured: not a timestamp' ELSE 'value: not a double;timestamp_measured: not a timestamp' END AS reasons
FROM v_measurements WHERE event_id % 5 IN (1, 2, 3)""", "v_measurements"))
def q_rest_record_rejects(spark, d):
    """By the event's id, three of five records have a value or a time (or both) that is none; two land."""
    m = V.measurements(spark, d).withColumn("request_id", F.concat_ws("|", F.col("date").cast("string"), "station_number"))
    rule = F.col("event_id") % 5
    m = m.withColumn("value", F.when(rule.isin(1, 3), F.concat(F.lit("about "), F.col("value"))).otherwise(F.col("value").cast("string")))
    wrong = m.withColumn("_at", F.col("timestamp_measured")).withColumn(
        "timestamp_measured", F.when(rule.isin(2, 3), F.lit("noon")).otherwise(F.col("_at").cast("string")))
    pages = S.page_envelopes(wrong, "request_id", RECORD_COLS, ["_at", "event_id"], PAGE_SIZE)
    out = S.rejected_records(pages)
    return out.select("request_id", F.get_json_object("raw", "$.event_id").cast("long").alias("event_id"),
                      F.array_join("reasons", ";").alias("reasons"))


@register("rest_page_chain", with_views("""
SELECT partition_key AS request_id,
       n - CASE WHEN n >= 2 AND event_id // 2 % 7 = 1 THEN 1 ELSE 0 END AS n_pages,
       NOT (n >= 2 AND event_id // 2 % 7 IN (1, 2)) AS complete
FROM (SELECT partition_key, event_id, row_count AS n FROM v_meas_ledger) p""", "v_meas_ledger"))
def q_rest_page_chain(spark, d):
    """One record a page.  By the first record's id every seventh chain has lost
    its second page, and in another seventh the second page points back."""
    first = V.measurement_ledger(spark, d).select(F.col("partition_key").alias("request_id"),
                                                  F.floor(F.col("event_id") / 2).alias("first_id"))
    pages = measurement_pages(spark, d, page_size=1).join(first, "request_id")
    rule = F.when(F.col("page") == 2, F.col("first_id") % 7).otherwise(0)
    back = F.regexp_replace("body", '"next_page":[0-9]+', '"next_page":1')
    return S.page_chain_status(pages.filter(rule != 1).withColumn("body", F.when(rule == 2, back).otherwise(F.col("body")))
                               ).select("request_id", "n_pages", "complete")


@register("rest_single_object", with_views("""
SELECT number, location, array_to_string(components, ',') AS components, CAST(first_seen AS VARCHAR) AS first_seen
FROM v_station_details""", "v_station_details"))
def q_rest_single_object(spark, d):
    det = V.station_details(spark, d)
    resp = det.select(F.concat(F.lit("stations/"), "number").alias("request_id"),
                      F.to_json(F.struct(F.struct(*STATION_DETAIL.fieldNames()).alias("data"))).alias("body"))
    out = S.single_objects(resp, STATION_DETAIL)
    return out.select("number", "location", F.array_join("components", ",").alias("components"),
                      F.col("first_seen").cast("string").alias("first_seen"))


@register("request_params", with_views("""
SELECT partition_key AS request_id, 'measurements' AS endpoint, CAST(date AS VARCHAR) AS date, station_number,
       CAST(date AS VARCHAR) || 'T00:00:00' AS start, CAST(date AS VARCHAR) || 'T23:59:59' AS "end"
FROM v_meas_ledger""", "v_meas_ledger"))
def q_request_params(spark, d):
    return S.request_params(V.measurement_ledger(spark, d).select("partition_key"))


@register("measurements_enrich", with_views(f"""
SELECT event_id, formula, value, epoch_us(timestamp_measured) AS ts_us, station_number,
       CAST(date AS VARCHAR) || 'T00:00:00' AS start, CAST(date AS VARCHAR) || 'T23:59:59' AS "end"
FROM v_measurements""", "v_measurements"))
def q_measurements_enrich(spark, d):
    recs = S.flatten_pages(measurement_pages(spark, d))
    reqs = S.request_params(V.measurement_ledger(spark, d).select("partition_key"))
    out = S.enrich(recs, reqs)
    return out.select("event_id", "formula", "value", F.unix_micros("timestamp_measured").alias("ts_us"),
                      "station_number", "start", "end")


def grid_responses(spark: SparkSession, d: str) -> DataFrame:
    """One response status per grid request: 200 where data exists; for the
    rest 500 on odd days of the month, 429 (rate limited) on even days."""
    grid = measurement_grid(spark, d)
    present = V.measurement_ledger(spark, d).select("partition_key", F.lit(True).alias("_has"))
    g = grid.join(present, "partition_key", "left")
    status = (F.when(F.col("_has"), F.lit(200))
              .when(F.dayofmonth("date") % 2 == 1, F.lit(500)).otherwise(F.lit(429)))
    return g.select(F.col("partition_key").alias("request_id"), status.alias("status"))


@register("fetch_error_split", with_views("""
SELECT g.partition_key AS request_id,
       CASE WHEN l.partition_key IS NOT NULL THEN 200 WHEN dayofmonth(g.date) % 2 = 1 THEN 500 ELSE 429 END AS status,
       CASE WHEN l.partition_key IS NOT NULL THEN 'ok' WHEN dayofmonth(g.date) % 2 = 1 THEN 'dead_letter'
            ELSE 'retry' END AS outcome
FROM grid g LEFT JOIN v_meas_ledger l ON l.partition_key = g.partition_key""",
                                          "v_stations", "v_meas_ledger",
                                          extra={"grid": GRID_SQL}))
def q_fetch_error_split(spark, d):
    return S.classify_responses(grid_responses(spark, d)).select("request_id", "status", "outcome")


@register("stations_dim", with_views("SELECT number, location FROM v_stations", "v_stations"))
def q_stations_dim(spark, d):
    path = scratch_path(spark, "stations-json")
    S.write_station_list(V.stations(spark, d), path, per_file=64)
    return S.read_stations(spark, path)


@register("rest_source", with_views(RECORDS_SQL, "v_measurements"))
def q_rest_source(spark, d):
    """Requests for the whole grid against saved pages (an empty ``data`` page
    where a day has no measurements)."""
    params = S.request_params(measurement_grid(spark, d).select("partition_key"))
    pages = measurement_pages(spark, d)
    empty = S.empty_page(params.join(pages.select("request_id").distinct(), "request_id", "left_anti"))
    replay = scratch_path(spark, "replay")
    pages.unionByName(empty).write.parquet(replay)
    return _records_out(S.flatten_pages(rest_source.fetch(S.request_rows(params), {"transport": "replay", "replay": replay})))
