"""M6: the polling metrics sensor as a Structured Streaming query.

New run records (files landing in a folder, or any streaming source) ->
terminal runs -> one point per run -> ``foreachBatch`` sink.  The checkpoint is
the cursor: a restart continues where the last committed batch ended.  Keyed
state remembers which runs were reported, so a run is neither lost nor doubled
however late its records come, and of several records in a batch the last
updated one counts.  The state lives in RocksDB with changelog checkpoints: a
batch reads its new records and the state of their runs, never the points
written before, so its cost doesn't grow with history.  Each batch overwrites
its own folder, so one replayed after a failure is idempotent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.monitor import run_labels, success_points
from tessera.schemas import RUNS, TERMINAL_RUN_STATUSES
from tessera.session import ship_package
from tessera.sources.fetch import JSON_OPTS

#: Held by a query from its start on.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Groups of runs by hash in which a batch's records are compared: many, so that a task holds few records at a time.
RUN_GROUPS = 4096


def run_points(runs: DataFrame, environment: str) -> DataFrame:
    """Terminal runs as points (streaming or batch)."""
    return success_points(run_labels(runs.filter(F.col("status").isin(*TERMINAL_RUN_STATUSES)), environment))


def _last_updated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last updated record of each run of a batch (ties: the greatest text); a task holds one record a run of its
    group."""
    best = pa.schema([("run_id", pa.string()), ("updated", pa.int64()), ("record", pa.string())]).empty_table()
    for batch in batches:
        best = pa.concat_tables([best, pa.Table.from_arrays([c.cast(t) for c, t in zip(batch.columns[1:], best.schema.types)],
                                                            schema=best.schema)])
        best = best.sort_by([("run_id", "ascending"), ("updated", "descending"), ("record", "descending")]).combine_chunks()
        run, n = best.column("run_id"), len(best)
        if n > 1:
            differs = pc.fill_null(pc.not_equal(run.slice(1), run.slice(0, n - 1)), True).combine_chunks()
            null = pc.and_(pc.is_null(run.slice(1)), pc.is_null(run.slice(0, n - 1))).combine_chunks()
            best = best.filter(pa.concat_arrays([pa.array([True]), pc.and_not(differs, null)]))
    yield from best.select(["run_id", "record"]).to_batches()


def unreported_runs(runs: DataFrame) -> DataFrame:
    """Streaming run records -> one record per terminal run, when it first comes.  A batch's records are first brought
    down to the last updated one of each run, in groups of runs by a hash; Spark's own keyed state, one lookup a run,
    then lets those through that it hasn't seen.  Records pass as JSON text; one without an update time counts as the
    oldest."""
    schema = runs.schema
    ended = runs.filter(F.col("status").isin(*TERMINAL_RUN_STATUSES)).select(
        F.pmod(F.xxhash64("run_id"), F.lit(RUN_GROUPS)).alias("_group"),
        "run_id", F.coalesce(F.unix_micros("update_time"), F.lit(-(2**62))).alias("updated"),
        F.to_json(F.struct(*schema.fieldNames()), JSON_OPTS).alias("record"))
    last = ended.groupBy("_group").applyInArrow(_last_updated, "run_id string, record string")
    first = last.dropDuplicates(["run_id"])
    return first.select(F.from_json("record", schema, JSON_OPTS).alias("r")).select("r.*")


def start_run_metrics(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                      environment: str, schema: T.StructType = RUNS, available_now: bool = True):
    """Start the stream over Parquet run files in ``source_path``."""
    ship_package(spark)
    points = run_points(unreported_runs(spark.readStream.schema(schema).parquet(source_path)), environment)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{sink_path}/batch_id={batch_id}")

    writer = points.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return writer.start()  # takes the settings along
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_points(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(sink_path)
