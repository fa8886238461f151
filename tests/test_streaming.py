import datetime as dt
import os

from tessera.schemas import RUNS
from tessera.session import scratch_path
from tessera.sources import testviews as V
from tessera.streaming import run_metrics

T = dt.datetime
SF = "/root/testdata/sf0.001"


def test_run_stream_reports_each_run_once_across_restarts(spark):
    root = scratch_path(spark, "t-m6")
    runs = V.runs(spark, SF)
    runs.write.mode("append").parquet(f"{root}/src")
    runs.write.mode("append").parquet(f"{root}/src")
    args = (spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", "dev")
    run_metrics.start_run_metrics(*args).awaitTermination()
    first = run_metrics.read_points(spark, f"{root}/sink").count()
    assert first == runs.filter("status IN ('SUCCESS', 'FAILURE')").count()
    runs.write.mode("append").parquet(f"{root}/src")           # third delivery after a restart
    run_metrics.start_run_metrics(*args).awaitTermination()
    assert run_metrics.read_points(spark, f"{root}/sink").count() == first


def test_runs_that_come_very_late_are_reported(spark):
    root = scratch_path(spark, "t-m6-late")
    runs = V.runs(spark, SF).filter("status IN ('SUCCESS', 'FAILURE')")
    cut = runs.selectExpr("percentile_approx(update_time, 0.5)").first()[0]
    args = (spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", "dev")
    runs.filter(runs.update_time > cut).write.mode("append").parquet(f"{root}/src")
    run_metrics.start_run_metrics(*args).awaitTermination()
    runs.write.mode("append").parquet(f"{root}/src")            # all, the older half years late
    run_metrics.start_run_metrics(*args).awaitTermination()
    got = [r.run_id for r in run_metrics.read_points(spark, f"{root}/sink").collect()]
    assert len(got) == len(set(got)) == runs.count()


def test_last_updated_record_of_a_batch_counts(spark):
    root = scratch_path(spark, "t-m6-latest")
    rows = [(str(i), "j", status, ["a"], "l", {"dagster/partition": f"p{i}"}, T(2024, 1, 1, h), T(2024, 1, 1, h))
            for i in range(30) for h, status in ((1, "FAILURE"), (3, "SUCCESS"), (2, "FAILURE"))]
    runs = spark.createDataFrame([*rows, ("x", "j", "SUCCESS", None, None, None, None, None), ("x", "j", "STARTED", None, None, None, T(2025, 1, 1), None)], RUNS)
    runs.repartition(7).write.parquet(f"{root}/src")
    args = (spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", "dev")
    run_metrics.start_run_metrics(*args).awaitTermination()
    got = {r.run_id: r for r in run_metrics.read_points(spark, f"{root}/sink").collect()}
    assert len(got) == 31 and {r.value for r in got.values()} == {1} and got["x"].seconds is None
    assert got["7"].partition_key == "p7" and got["7"].seconds == int(T(2024, 1, 1, 3, tzinfo=dt.timezone.utc).timestamp())


def test_a_batch_reads_new_records_and_state_only(spark, monkeypatch):
    root = scratch_path(spark, "t-m6-cost")
    args = (spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", "dev")
    def rows(lo, hi):
        return spark.range(lo, hi).selectExpr(
            "cast(id AS string) AS run_id", "'j' AS job_name", "'SUCCESS' AS status", "array('a') AS asset_selection", "'l' AS location",
            "map('k', 'v') AS tags", "timestamp '2024-01-01' AS update_time", "timestamp '2024-01-01' AS end_time")
    rows(0, 5000).write.mode("append").parquet(f"{root}/src")
    run_metrics.start_run_metrics(*args).awaitTermination()
    # the points written so far are not there any more: no batch needs them
    monkeypatch.setattr(run_metrics, "read_points", None)
    os.rename(f"{root}/sink", f"{root}/sink-of-before")
    rows(4990, 5010).coalesce(1).write.mode("append").parquet(f"{root}/src")
    q = run_metrics.start_run_metrics(*args)
    q.awaitTermination()
    last = [p for p in q.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in last] == [20]
    state = last[0]["stateOperators"][0]
    assert state["numRowsUpdated"] == 10 and state["numRowsTotal"] == 5010 and any("rocksdb" in k for k in state["customMetrics"])
    assert spark.read.parquet(f"{root}/sink").count() == 10
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_runs_of_a_batch_are_compared_in_groups_and_looked_up_in_sparks_own_state(spark):
    root = scratch_path(spark, "t-m6-groups")
    spark.range(0, 60_000).selectExpr(
        "cast(id % 20000 AS string) AS run_id", "'j' AS job_name", "if(id < 40000, 'FAILURE', 'SUCCESS') AS status", "array('a') AS asset_selection",
        "'l' AS location", "map('k', 'v') AS tags", "timestamp_seconds(id) AS update_time", "timestamp_seconds(id) AS end_time").write.parquet(f"{root}/src")
    q = run_metrics.start_run_metrics(spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", "dev")
    q.awaitTermination()
    states = [s for p in q.recentProgress if p["numInputRows"] for s in p["stateOperators"]]
    assert [(s["operatorName"], s["numRowsTotal"]) for s in states] == [("dedupe", 20_000)]  # no call of Python a run
    got = run_metrics.read_points(spark, f"{root}/sink")
    assert got.count() == 20_000 and got.filter("value = 0 OR seconds < 40000").count() == 0


def test_last_updated_over_several_arrow_batches():
    import pyarrow as pa

    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.string()))],
                                          names=["_group", "run_id", "updated", "record"])
    out = run_metrics._last_updated(iter([batch((1, "a", 2, "x"), (1, "b", 1, "q"), (1, None, 1, "n")),
                                          batch((1, "a", 1, "z"), (1, "b", 1, "r"), (1, None, 3, "m"))]))
    assert sorted((r for b in out for r in b.to_pylist()), key=str) == [
        {"run_id": "a", "record": "x"}, {"run_id": "b", "record": "r"}, {"run_id": None, "record": "m"}]
