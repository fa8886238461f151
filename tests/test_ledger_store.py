"""The ledger on disk: condensed state, later appends, compactions at the same time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ledger as L
from tessera.plans.flows import append_ledger, read_ledger
from tessera.schemas import LEDGER
from tessera.session import scratch_path
from tessera.sources import ledger_store as S
from tessera.sources import snapshots

T = dt.datetime


def _events(seed, n, first_id=0):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([f"2024-01-{d:02d}|s" for d in range(1, 9)] + [None]),
             rng.choice(["MATERIALIZED", "FAILED", "STARTED"]), T(2024, 1, 1 + rng.randrange(20)), first_id + i, "p", i,
             rng.choice(["v1", None])) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, LEDGER)


def _answers(events):
    """What plans ask of a ledger."""
    done = events.filter("status = 'MATERIALIZED'").groupBy("asset_key", "partition_key").agg(F.max("event_time").alias("t"))
    return (sorted(map(str, L.latest_status(events).collect())), sorted(map(str, done.collect())),
            sorted(map(str, events.select("asset_key").distinct().collect())))


def _by_hand(rows):
    kept = {}
    for r in rows:
        key = r[:2]
        order = (r[3], r[4], r[2])
        for kind in ("last", "done") if r[2] == "MATERIALIZED" else ("last",):
            if (key, kind) not in kept or kept[key, kind][0] < order:
                kept[key, kind] = order, r
    return {r for _, r in kept.values()}


def test_condense_keeps_the_deciding_events(spark):
    rows = _events(1, 300)
    got = [tuple(r) for r in L.condense(_frame(spark, rows + rows[:50])).collect()]
    assert len(got) == len(set(got)) and set(got) == _by_hand(rows)
    assert L.condense(_frame(spark, [])).count() == 0


def test_condensing_again_with_later_events(spark):
    early, late = _events(2, 200), _events(3, 200, 1000)
    once = {tuple(r) for r in L.condense(_frame(spark, early + late)).collect()}
    twice = L.condense(L.condense(_frame(spark, early)).unionByName(_frame(spark, late)))
    assert {tuple(r) for r in twice.collect()} == once
    # events out of order: the late ones first
    turned = L.condense(L.condense(_frame(spark, late)).unionByName(_frame(spark, early)))
    assert {tuple(r) for r in turned.collect()} == once


def test_state_and_newer_appends_answer_as_the_whole_ledger(spark):
    path = f"{scratch_path(spark, 't-ledger')}/ledger"
    assert S.compact(spark, path) is None and S.read_condensed(spark, path).count() == 0
    for n in range(4):
        append_ledger(_frame(spark, _events(10 + n, 120, 1000 * n)), path)
        assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))
        if n != 2:
            snap = S.compact(spark, path)
            assert S.covered_share(spark, path) == (n + 1, n + 1)
            assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))
    assert S.compact(spark, path).version == snap.version == 3  # nothing new: no new state
    append_ledger(_frame(spark, []), path)  # an append without events
    assert S.compact(spark, path).version == 4
    assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))


def test_a_plan_reads_no_history_that_the_state_covers(spark):
    path = f"{scratch_path(spark, 't-ledger')}/ledger"
    for n in range(3):
        append_ledger(_frame(spark, _events(n, 200, 1000 * n)), path)
        if n == 1:
            S.compact(spark, path)
    read = S.read_condensed(spark, path)
    files = {r.f for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    appends = {f.split("/append=")[1].split("/")[0] for f in files if "/append=" in f}
    assert len(appends) == 1 and any("/_state/" in f for f in files)
    assert read.count() < 600


def test_an_append_still_being_written_waits_for_the_next_state(spark):
    path = f"{scratch_path(spark, 't-ledger')}/ledger"
    append_ledger(_frame(spark, _events(1, 50)), path)
    append_ledger(_frame(spark, _events(2, 50, 100)), path)
    name = sorted(n for n in snapshots.folder_names(spark, path) if n.startswith("append="))[0]
    fs, marker = snapshots.file_system(spark, f"{path}/{name}/_SUCCESS")
    fs.delete(marker, False)
    assert name not in S.compact(spark, path).folders
    assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))
    fs.create(marker, True).close()
    assert name in S.compact(spark, path).folders
    assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))


@pytest.mark.parametrize("dies", [False, True])
def test_two_compactions_and_one_that_dies(spark, monkeypatch, dies):
    path = f"{scratch_path(spark, 't-ledger')}/ledger"
    append_ledger(_frame(spark, _events(1, 80)), path)
    publish, met = snapshots.commit, []

    def late(spark, table, snap):
        if not met:
            met.append(1)
            if dies:
                raise RuntimeError("driver lost")
            append_ledger(_frame(spark, _events(2, 80, 200)), path)
            S.compact(spark, path)  # another one is first
        return publish(spark, table, snap)

    monkeypatch.setattr(snapshots, "commit", late)
    if dies:
        with pytest.raises(RuntimeError):
            S.compact(spark, path)
        assert S.covered_share(spark, path) == (0, 1)
    snap = S.compact(spark, path)
    assert snap.version == 1 and len(snap.folders) == (1 if dies else 2)
    assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))
    assert S.vacuum_state(spark, path, keep_versions=1, older_than_s=-60) == 1  # what nobody published
    assert _answers(S.read_condensed(spark, path)) == _answers(read_ledger(spark, path))
