"""The §2 views over the driver's test tables.

These map the generic test tables onto this package's data model, so every
registered query reads the given tables and its work grows with them.  The
rules are ours (see FIXTURES.md §3); the DuckDB twins live in
``tessera.plans.sqlviews`` and must stay in step with this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.keys import encode_columns
from tessera.functions.tags import sparse_map
from tessera.schemas import (STATUS_FAILED, STATUS_IN_PROGRESS,
                             STATUS_MATERIALIZED, TAG_AUTO_MATERIALIZE,
                             TAG_BACKFILL, TAG_PARTITION,
                             TAG_PARTITION_DIM_PREFIX, TAG_RUN_KEY,
                             TAG_SCHEDULE)

MEASUREMENT_ASSET = "air_quality_data"
DAILY_ASSET = "daily_air_quality_data"
STATION_ASSET = "station_names"
STATION_BRONZE_ASSET = "air_quality_station_names"
# Ten customers share a station, so run and backfill keys grow with the tables.
CUSTOMERS_PER_STATION = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_of(user_id) -> F.Column:
    return F.format_string("NL%05d", user_id)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_measurements``: one measurement per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("event_type").alias("formula"),
        "value",
        station_of(F.col("user_id")).alias("station_number"),
        F.col("ts").cast("timestamp").alias("timestamp_measured"),
        F.to_date("ts").alias("date"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_stations``: distinct stations of the measurements."""
    return (measurements(spark, sf_dir).select(F.col("station_number").alias("number"))
            .distinct()
            .withColumn("location", F.concat(F.lit("Location "), F.col("number"))))


def station_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail record per station: components measured and first day seen."""
    m = measurements(spark, sf_dir)
    return (m.groupBy(F.col("station_number").alias("number"))
            .agg(F.array_sort(F.collect_set("formula")).alias("components"),
                 F.min("date").alias("first_seen"))
            .withColumn("location", F.concat(F.lit("Location "), F.col("number")))
            .select("number", "location", "components", "first_seen"))


def measurement_ledger(spark: SparkSession, sf_dir: str, failed_reruns: bool = False) -> DataFrame:
    """Ledger of the measurement asset.

    Every present (date, station) partition has a MATERIALIZED event at its
    last measurement.  With ``failed_reruns`` a partition holding an ``error``
    measurement was also rerun an hour later and that rerun FAILED, so its
    latest status is FAILED although it was materialized once.
    """
    parts = (measurements(spark, sf_dir)
             .groupBy("date", "station_number")
             .agg(F.max("timestamp_measured").alias("last_ts"),
                  F.min("event_id").alias("first_id"),
                  F.count(F.lit(1)).alias("n"),
                  F.max((F.col("formula") == "error").cast("int")).alias("has_error")))
    base = [F.lit(MEASUREMENT_ASSET).alias("asset_key"),
            encode_columns("date", "station_number").alias("partition_key"),
            "date", "station_number"]
    ok = parts.select(*base, F.lit(STATUS_MATERIALIZED).alias("status"),
                      F.col("last_ts").alias("event_time"),
                      (F.col("first_id") * 2).alias("event_id"),
                      F.col("n").alias("row_count"))
    if not failed_reruns:
        return ok
    failed = (parts.filter(F.col("has_error") == 1)
              .select(*base, F.lit(STATUS_FAILED).alias("status"),
                      (F.col("last_ts") + F.expr("interval 1 hour")).alias("event_time"),
                      (F.col("first_id") * 2 + 1).alias("event_id"),
                      F.lit(0).cast("long").alias("row_count")))
    return ok.unionByName(failed)


def many_assets(ledger: DataFrame) -> DataFrame:
    """The ledger with every event repeated for a second asset, ten days later and never failed, on the same keys:
    what an operator must not mistake for the asset asked about.  For every third event the second asset alone
    keeps its entry."""
    other = ledger.select(F.lit(STATION_ASSET).alias("asset_key"), "partition_key", "date", "station_number",
                          F.lit(STATUS_MATERIALIZED).alias("status"),
                          (F.col("event_time") + F.expr("interval 10 days")).alias("event_time"),
                          F.col("event_id"), "row_count")
    return ledger.filter(F.col("event_id") % 3 != 0).unionByName(other)


def _status3(col: str, f: str, o: str, p: str) -> F.Column:
    c = F.col(col)
    return F.when(c == "F", F.lit(f)).when(c == "O", F.lit(o)).when(c == "P", F.lit(p))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_ledger``: one status event per order, keyed by customer."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_custkey") % 10 < 7, F.lit(MEASUREMENT_ASSET))
        .otherwise(F.lit(STATION_ASSET)).alias("asset_key"),
        F.col("o_custkey").cast("string").alias("partition_key"),
        _status3("o_orderstatus", STATUS_FAILED, STATUS_MATERIALIZED, STATUS_IN_PROGRESS).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_orderkey").alias("event_id"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_runs``: one run record per order.

    priority 1 → backfill (every 7th also carries a schedule tag),
    2 → schedule, 3 → auto-materialize, 4 → manual (every 9th with an empty
    auto-materialize tag), 5 → manual.  Every 20th run is unpartitioned and
    every 50th has an empty asset selection.
    """
    o = table(spark, sf_dir, "orders")
    key, cust, prio = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    asset = (F.when(cust % 3 == 0, F.lit(MEASUREMENT_ASSET))
             .when(cust % 3 == 1, F.lit(DAILY_ASSET)).otherwise(F.lit(STATION_ASSET)))
    # A day per 90 days of orders, from the first day of the measurements on.
    day = F.date_add(F.lit("2024-01-01").cast("date"),
                     F.floor(F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")) / 90).cast("int"))
    station = station_of(F.floor(cust / CUSTOMERS_PER_STATION))
    partitioned = key % 20 != 0
    pkey = F.when(partitioned, F.concat_ws("|", day.cast("string"), station))
    end_us = (F.unix_micros(F.col("o_orderdate").cast("timestamp"))
              + F.pmod(key, F.lit(86400)) * F.lit(1_000_000) + F.pmod(key * 37, F.lit(1_000_000)))
    tags = sparse_map(
        (TAG_PARTITION, pkey),
        (TAG_PARTITION_DIM_PREFIX + "daily", F.when(partitioned, day.cast("string"))),
        (TAG_PARTITION_DIM_PREFIX + "stations", F.when(partitioned, station)),
        (TAG_BACKFILL, F.when(prio.startswith("1"), F.concat(F.lit("backfill-"), (cust % 10).cast("string")))),
        (TAG_SCHEDULE, F.when(prio.startswith("2") | (prio.startswith("1") & (key % 7 == 0)),
                              F.concat(F.lit("schedule-"), (cust % 4).cast("string")))),
        (TAG_AUTO_MATERIALIZE, F.when(prio.startswith("3"), F.lit("true"))
         .when(prio.startswith("4") & (key % 9 == 0), F.lit(""))),
        (TAG_RUN_KEY, F.when(partitioned, F.concat(asset, F.lit(":"), pkey))),
    )
    return o.select(
        key.cast("string").alias("run_id"),
        F.concat(asset, F.lit("_job")).alias("job_name"),
        _status3("o_orderstatus", "FAILURE", "SUCCESS", "STARTED").alias("status"),
        F.when(key % 50 == 0, F.array().cast("array<string>")).otherwise(F.array(asset)).alias("asset_selection"),
        F.when(cust % 2 == 0, F.lit("ingestion-a")).otherwise(F.lit("ingestion-b")).alias("location"),
        tags.alias("tags"),
        F.timestamp_micros(end_us + key % 600 * F.lit(1_000_000)).alias("update_time"),
        F.when(F.col("o_orderstatus") != "P", F.timestamp_micros(end_us)).alias("end_time"),  # none in flight
    )


def backfills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_backfills``: one backfill request per customer, some invalid on purpose."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), (k % 30).cast("int"))
    end = F.when(k % 9 == 8, F.date_sub(start, 1)).otherwise(F.date_add(start, (k % 4).cast("int")))
    return c.select(
        k.alias("request_id"),
        F.concat(F.lit("backfill-"), k.cast("string")).alias("name"),
        F.lit("air_quality_job").alias("job_name"),
        F.lit("ingestion").alias("repository_name"),
        F.when(k % 17 == 5, F.lit(None).cast("string")).when(k % 11 == 10, F.lit("sometimes"))
        .when(k % 2 == 0, F.lit("missing")).otherwise(F.lit("all")).alias("policy"),
        F.when(k % 7 == 3, F.lit(None).cast("string")).when(k % 23 == 6, F.lit("no_such_asset"))
        .otherwise(F.lit(MEASUREMENT_ASSET)).alias("asset_key"),
        F.when(k % 19 != 4, start).alias("start_date"),
        end.alias("end_date"),
        F.array(*[station_of(F.floor(k / CUSTOMERS_PER_STATION) + i) for i in range(3)]).alias("stations"),
        F.when(k % 13 == 12, F.lit("csv")).otherwise(F.lit("parquet")).alias("file_type"),
        (k % 2 == 1).alias("skip_checks"),
        F.when(k % 29 == 7, F.lit("minio://bucket/x")).when(k % 2 == 0, F.lit("gs://bucket/x"))
        .otherwise(F.lit("/data/x")).alias("location"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calls``: every event is one API call, bucketed by event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("bucket"), F.col("event_id").alias("call_id"),
                     F.col("ts").cast("timestamp").alias("ts"))
