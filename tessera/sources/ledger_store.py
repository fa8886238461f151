"""The ledger on disk: appends that never change, and a condensed state that is kept up to date from them.

Layout below the ledger's path::

    append=a<id>/asset_key=…/part-….parquet     events of one append
    _state/write=w<id>/asset_key=…/…            condensed events (``operators.ledger.condense``)
    _state/_manifests/00000000000000000007.json state 7: which appends it covers, and the write that holds it

Condensed events answer what a plan asks (latest status, materialized or not, known assets) as the whole history does,
and condensing them again with later events gives what condensing all events gives.  So ``compact`` reads the last
state and the appends since, and ``read_condensed`` the same without writing: neither reads the history that a state
covers.  An append counts as covered or not as a whole; one still being written (no ``_SUCCESS`` yet) is left to the
next state.  Of two compactions at a time one publishes; the other starts again from what that one covers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ledger import condense
from tessera.schemas import LEDGER
from tessera.sources import snapshots

STATE = "_state"
KEY = ("asset_key", "partition_key")


def _appends(spark: SparkSession, ledger_path: str) -> list[str]:
    return sorted(n for n in snapshots.folder_names(spark, ledger_path) if n.startswith("append="))


def _finished(spark: SparkSession, folder: str) -> bool:
    fs, marker = snapshots.file_system(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def _read(spark: SparkSession, base: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], LEDGER)
    return (spark.read.schema(LEDGER).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
            .select(*LEDGER.fieldNames()))


def _state_write(snap: snapshots.Snapshot | None) -> list[str]:
    return [] if snap is None else sorted(set(snap.folders.values()))


def _state_and_newer(spark: SparkSession, ledger_path: str, snap: snapshots.Snapshot | None,
                     newer: list[str]) -> DataFrame:
    return (_read(spark, f"{ledger_path}/{STATE}", _state_write(snap))
            .unionByName(_read(spark, ledger_path, newer)))


def read_condensed(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Events that L2 to L6, B5, B6, F5 and F6 answer from as from the whole ledger: the last state and all appends
    it does not cover.  Counts of events (``n_events`` of L1) and the history of a partition need the whole one.
    Without a state it is the whole ledger; a ledger that does not exist is empty."""
    snap = snapshots.snapshot(spark, f"{ledger_path}/{STATE}")
    covered = snap.folders if snap else {}
    return _state_and_newer(spark, ledger_path, snap, [a for a in _appends(spark, ledger_path) if a not in covered])


def compact(spark: SparkSession, ledger_path: str) -> snapshots.Snapshot | None:
    """Bring the state up to date; returns it (None for a ledger without finished appends).  With nothing new the
    last one stays."""
    path = f"{ledger_path}/{STATE}"
    while True:
        snap = snapshots.snapshot(spark, path)
        covered = snap.folders if snap else {}
        newer = [a for a in _appends(spark, ledger_path)
                 if a not in covered and _finished(spark, f"{ledger_path}/{a}")]
        if not newer:
            return snap
        write = f"write=w{uuid.uuid4().hex}"
        state = condense(_state_and_newer(spark, ledger_path, snap, newer))
        (state.hint("rebalance", "asset_key").sortWithinPartitions("asset_key", "partition_key")
         .write.partitionBy("asset_key").parquet(f"{path}/{write}"))
        new = snapshots.Snapshot((snap.version if snap else 0) + 1, dict.fromkeys([*covered, *newer], write), KEY)
        if snapshots.commit(spark, path, new):
            return new


def vacuum_state(spark: SparkSession, ledger_path: str, keep_versions: int = 2,
                 older_than_s: float = 7 * 86400.0) -> int:
    """Delete states but the newest ``keep_versions`` that are older than any reader or compaction still at work, and
    what compactions that never published left.  Appends stay: they are the history.  Returns how many writes went."""
    path = f"{ledger_path}/{STATE}"
    return snapshots.vacuum(spark, path, keep_versions, older_than_s)


def covered_share(spark: SparkSession, ledger_path: str) -> tuple[int, int]:
    """(appends the state covers, appends there are): tells when compacting pays."""
    snap = snapshots.snapshot(spark, f"{ledger_path}/{STATE}")
    there = _appends(spark, ledger_path)
    return len(set(there) & set(snap.folders if snap else {})), len(there)
