"""End-to-end flows composed from the operators.

Each flow is one Spark job graph for *all* its partitions; the reference ran
one process per partition.  Boundaries that must survive executor loss are
written tables in the shared folder (raw pages, landing, bronze, ledger), so
a retry re-reads them instead of refetching or recomputing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keys import encode_columns
from tessera.functions.timefn import as_col
from tessera.operators import ledger as L
from tessera.operators import partitions as P
from tessera.operators.freshness import data_version
from tessera.operators.pacing import rate_wave_plan
from tessera.schemas import (LEDGER, MEASUREMENT_RECORD, MEASUREMENTS,
                             RATE_CALLS, STATION, STATION_DETAIL,
                             STATUS_FAILED, STATUS_MATERIALIZED)
from tessera.sources import fetch as S
from tessera.sources import rest_source
from tessera.sources import storage as B
from tessera.sources.ledger_store import read_condensed

LANDING = "air_quality_data"
BRONZE = "daily_air_quality_data"
STATIONS_LANDING = "station_names"
STATIONS_BRONZE = "air_quality_station_names"
PCOLS = ["date", "station_number"]
#: Folders of the station table, whatever the number of stations.
STATION_BUCKETS = 16
REJECTS = "_rejects"


def append_ledger(rows: DataFrame, ledger_path: str) -> None:
    """Append events to the ledger table: a folder of its own per append, so
    that appends at the same time don't meet, below it one per asset.  Events
    that are already there stay out, so a repeated run adds nothing; only the
    times and assets that are written are looked up."""
    spark = rows.sparkSession
    new = B.conform(rows, LEDGER)
    if B._path_exists(spark, ledger_path):
        span = new.agg(F.collect_set("asset_key").alias("assets"), F.min("event_time").alias("low"), F.max("event_time").alias("high"))
        assets, low, high = span.first()
        key = ["asset_key", "partition_key", "event_id"]
        known = read_ledger(spark, ledger_path).filter(
            F.col("asset_key").isin(assets) & F.col("event_time").between(F.lit(low), F.lit(high))).select(*key)
        new = new.join(known, key, "left_anti")
    B.conform(new, LEDGER).write.partitionBy("asset_key").parquet(f"{ledger_path}/append=a{uuid.uuid4().hex}")


def number_events(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """``events`` (asset_key, partition_key, event_time, status, data_version) with their ``event_id``.  The first
    event of a partition at a time gets a hash; one that says something new at the same logical time gets the next
    number, so a retry overrules what it retries; one that repeats the last is left out."""
    key = ["asset_key", "partition_key", "event_time"]
    before = ledger.groupBy(*key).agg(F.max(F.struct("event_id", "status", "data_version")).alias("_last"))
    first = F.shiftrightunsigned(F.xxhash64(*key), 2)  # leaves room above
    joined = events.join(before, key, "left")
    repeats = joined["status"].eqNullSafe(F.col("_last.status")) & joined["data_version"].eqNullSafe(F.col("_last.data_version"))
    return (joined.filter(F.col("_last").isNull() | ~repeats)
            .withColumn("event_id", F.coalesce(F.col("_last.event_id") + 1, first)).drop("_last"))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not B._path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", ledger_path).parquet(ledger_path).select(*LEDGER.fieldNames())


def request_waves(params: DataFrame, calls_per_wave: int = RATE_CALLS) -> DataFrame:
    """Every request of S5 with its rate-limit ``wave`` (F11), by day and id.
    A run fetches the waves it has time for and the rest stay due; calls are
    counted per request here, so a request of many pages takes more of the
    limit than its place in the plan."""
    timed = params.withColumn("bucket", F.col("endpoint")).withColumn("_day", F.col("date").cast("timestamp"))
    return rate_wave_plan(timed, limit=calls_per_wave, ts="_day", tie="request_id").drop("_day")


def landing_measurements(spark: SparkSession, keys: DataFrame, lake_root: str, ledger_path: str,
                         now, transport: dict[str, str]) -> DataFrame:
    """G1: fetch every due (day, station) partition (``partition_key``), land
    the rows of those fetched in full and record the outcome in the ledger.

    S5 parameters -> S1 fetch -> raw pages written once, kept per run -> S7 and
    S3 give each request one outcome -> S2 flatten -> S6 enrich -> B1 write ->
    F1 version -> ledger append.  A request is MATERIALIZED only if all its
    pages came and the chain is complete; its partition is replaced even by no
    rows.  A 500 or an unreadable page makes it FAILED, anything else leaves no
    event and it stays due.  Records that can't land go to the run's reject
    table (``read_rejects``).  A retry at the same ``now`` overrules the events
    of the run it repeats.  Returns the ledger rows of ``now``.
    """
    params = S.request_params(keys.select("partition_key").distinct())
    run = uuid.uuid4().hex
    raw_path = f"{lake_root}/_raw_pages/run={run}"
    rest_source.fetch(S.request_rows(params), transport).write.parquet(raw_path)          # fetch exactly once
    pages, links_path = spark.read.parquet(raw_path), f"{lake_root}/_links/run={run}"
    S.page_links(S.classify_responses(pages)).write.parquet(links_path)                   # bodies are read for it once
    outcome_path = f"{lake_root}/_outcomes/run={run}"
    S.request_outcomes(spark.read.parquet(links_path)).write.parquet(outcome_path)
    outcome = spark.read.parquet(outcome_path)
    done = outcome.filter(F.col("outcome") == "ok").select("request_id")
    checked_path = f"{lake_root}/_checked/run={run}"
    S.checked_records(pages.join(done, "request_id", "left_semi"), MEASUREMENT_RECORD).write.parquet(checked_path)
    checked = spark.read.parquet(checked_path)
    rows = S.enrich(S.landed_records(checked, MEASUREMENT_RECORD, extra=True), params)
    S.rejects_of(checked).write.parquet(f"{lake_root}/{REJECTS}/run={run}")
    landed_keys = params.join(done, "request_id", "left_semi").select(F.col("date").cast("date").alias("date"), "station_number")
    path = B.asset_path(lake_root, LANDING)
    version = B.publish_partitions(rows, lake_root, LANDING, PCOLS, MEASUREMENTS, keys=landed_keys)
    landed = B.read_partitions(spark, path, landed_keys, MEASUREMENTS, PCOLS, version)
    versions = data_version(landed.withColumn("request_id", encode_columns(*PCOLS)), ["request_id"],
                            ["formula", "value", "timestamp_measured"])
    t = as_col(now)
    status = (F.when(F.col("outcome") == "ok", F.lit(STATUS_MATERIALIZED))
              .when(F.col("outcome").isin("dead_letter", "malformed"), F.lit(STATUS_FAILED)))
    events = outcome.join(versions, "request_id", "left").filter(status.isNotNull()).select(
        F.lit(LANDING).alias("asset_key"), F.col("request_id").alias("partition_key"),
        status.alias("status"), t.alias("event_time"),
        F.when(status == STATUS_MATERIALIZED, F.concat(F.lit(f"{path}/date="), F.split("request_id", r"\|")[0])).alias("path"),
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("row_count"),
        F.when(status == STATUS_MATERIALIZED, F.coalesce("data_version", F.lit("0-0-0"))).alias("data_version"))
    at_now = read_ledger(spark, ledger_path).filter((F.col("asset_key") == LANDING) & (F.col("event_time") == t))
    append_ledger(number_events(events, at_now), ledger_path)
    return read_ledger(spark, ledger_path).filter((F.col("asset_key") == LANDING) & (F.col("event_time") == t))


def read_rejects(spark: SparkSession, lake_root: str) -> DataFrame:
    """Records of all G1 runs that could not land: request_id, page, place, reasons, raw, run."""
    path = f"{lake_root}/{REJECTS}"
    schema = "request_id string, page int, place int, reasons array<string>, raw string, run string"
    if not B._path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/run=*")


def bronze_daily_measurements(spark: SparkSession, lake_root: str, ledger: DataFrame,
                              daily: DataFrame, upstream: DataFrame, bronze_root: str) -> DataFrame:
    """Landing (day, station) partitions of each requested day -> one
    daily bronze partition; missing stations are tolerated and reported.

    P7 maps days to upstream keys, B5 loads only those whose latest status is
    MATERIALIZED, B1 writes bronze by day, B6 counts the missing ones.  Returns
    per day: rows written, stations present, stations missing.
    """
    mapping = P.map_day_to_multi(daily, upstream)                     # (daily_key, upstream_key)
    requested = (mapping.select(F.col("upstream_key").alias("partition_key"))
                 .select("partition_key", *[c.alias(n) for c, n in
                                            zip(_split(F.col("partition_key")), PCOLS)]))
    data = B.read_partitions_lenient(spark, lake_root, LANDING, requested, ledger, MEASUREMENTS, PCOLS)
    B.write_partitioned(data, bronze_root, BRONZE, ["date"], MEASUREMENTS, keys=daily)
    bronze = B.read_partitions(spark, B.asset_path(bronze_root, BRONZE), daily, MEASUREMENTS, ["date"])
    written = bronze.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("station_number").alias("n_stations"))
    missing = (B.missing_on_load(requested, ledger, LANDING, PCOLS)
               .groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n_missing")))
    days = daily.select(F.col("date").cast("string").alias("date"))
    return (days.join(written, "date", "left").join(missing, "date", "left")
            .fillna(0, ["n_rows", "n_stations", "n_missing"]))


def _split(key):
    parts = F.split(key, "\\|")
    return [parts.getItem(0).cast("date"), parts.getItem(1)]


def landing_stations(spark: SparkSession, station_list_path: str, lake_root: str,
                     transport: dict[str, str]) -> DataFrame:
    """One detail record per listed station -> landing, one partition per
    station in hash-bucket folders (S8 -> S1 single-object fetch -> S4 -> B1).  Raises if any station
    could not be fetched; nothing lands then."""
    stations = S.read_stations(spark, station_list_path)
    reqs = stations.select(F.concat(F.lit("stations/"), "number").alias("request_id"),
                           F.concat(F.lit("stations/"), "number").alias("endpoint"),
                           F.lit(None).cast("string").alias("params_json"))
    raw_path = f"{lake_root}/_raw_stations/run={uuid.uuid4().hex}"
    rest_source.fetch(reqs, transport, paginate=False).write.parquet(raw_path)
    answers = S.classify_responses(spark.read.parquet(raw_path), "OBJECT")
    failed = answers.filter(F.col("outcome") != "ok").select("request_id", "status", "outcome").limit(20).collect()
    if failed:
        raise RuntimeError(f"stations not fetched: {[tuple(r) for r in failed]}")
    details = S.single_objects(answers, STATION_DETAIL).drop("request_id")
    B.write_partitioned(details, lake_root, STATIONS_LANDING, ["number"], STATION_DETAIL, buckets=STATION_BUCKETS)
    return B.read_all_partitions(spark, lake_root, STATIONS_LANDING, STATION_DETAIL)


def bronze_stations(spark: SparkSession, lake_root: str, bronze_root: str) -> DataFrame:
    """All station partitions -> one unpartitioned bronze table."""
    allp = B.read_all_partitions(spark, lake_root, STATIONS_LANDING, STATION_DETAIL)
    B.write_unpartitioned(allp.select(*STATION.fieldNames()), bronze_root, STATIONS_BRONZE, STATION)
    return B.read_unpartitioned(spark, bronze_root, STATIONS_BRONZE, STATION)


def backfill_missing(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Backfill requests -> validated -> missing grid -> run requests.

    Returns accepted run requests (``decision = 'submit'``) and rejected
    backfill requests with their errors (``decision = 'reject'``)."""
    checked = L.with_asset_check(P.validate_backfills(requests), ledger)
    rejected = checked.filter(~F.col("valid")).select(
        "name", F.lit("reject").alias("decision"), F.lit(None).cast("string").alias("partition_key"),
        F.array_join("errors", ";").alias("detail"))
    plan = L.backfill_plan(requests, ledger)
    runs = L.run_request_rows(plan)
    submitted = runs.select(
        F.try_element_at("tags", F.lit("dagster/backfill")).alias("name"), F.lit("submit").alias("decision"),
        F.try_element_at("tags", F.lit("dagster/partition")).alias("partition_key"),
        F.col("job_name").alias("detail"))
    return submitted.unionByName(rejected)


def report_storage(spark: SparkSession, lake_root: str, asset_key: str, ledger_path: str, now,
                   partition_cols: list[str], skip_checks: bool = False) -> DataFrame:
    """Storage listing -> asset check -> reconcile -> ledger append.

    Returns the appended events; a rerun appends nothing because the
    reconciliation runs against the updated ledger.  What was reported before
    comes from the condensed state and the appends since, not from the history.
    """
    ledger = read_condensed(spark, ledger_path)
    L.check_assets_exist(spark.createDataFrame([(asset_key,)], "asset_key string"), ledger, skip_checks)
    listed = B.list_partition_files(spark, lake_root, asset_key, partition_cols)
    keys = listed.select(encode_columns(*partition_cols).alias("partition_key"))
    new = L.reconcile_storage(keys, ledger, asset_key)
    events = L.report_materialized(new, asset_key, now)
    append_ledger(events, ledger_path)
    return read_ledger(spark, ledger_path).filter((F.col("asset_key") == asset_key) & (F.col("event_time") == as_col(now)))
