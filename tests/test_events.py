"""Event tables: snapshots and markers, and writers that stop at any point."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from martline.operators import registry
from martline.sinks import events as E


def _registry(spark, scratch):
    return E.EventTable(spark, scratch + "/registry", registry.EVENT_SCHEMA, registry.deciding_events)


def _load(spark, table, n, completes=True):
    """A load of two files; files of a load that fails are taken again by the next one."""
    files = spark.sql(f"SELECT '/in/{n}/' || f AS path, f AS file_name FROM VALUES ('a.csv'), ('b.csv') AS t(f)")
    at = F.lit(datetime.datetime(2023, 1, 1) + datetime.timedelta(minutes=n)).cast("timestamp_ntz")
    table.append(registry.register_files(files, at, n))
    if completes:
        table.append(registry.complete_files(files, at, n))


def _state(events):
    """What loads ask of a registry: each file's status, and the completed loads."""
    status = {(r["path"], r["status"], r["last_event_time"]) for r in registry.current_status(events).collect()}
    done = {r["load_id"] for r in events.where("status = 'I'").select("load_id").distinct().collect()}
    return status, done


def test_a_hundred_loads_leave_one_snapshot_and_a_bounded_tail(spark, scratch):
    table = _registry(spark, scratch)
    assert table.read().count() == 0 and not table.compact()
    compacted = 0
    for n in range(100):
        _load(spark, table, n, completes=n % 10 != 3)
        compacted += table.compact()
    snapshot, tail = table.current()
    assert compacted >= 5 and snapshot and len(tail) < E.COMPACT_AFTER + 2
    assert len(os.listdir(table.root.replace("file:", ""))) < 3 * E.COMPACT_AFTER      # old appends are gone
    status, done = _state(table.read())
    assert done == {n for n in range(100) if n % 10 != 3}
    assert {(p, s) for p, s, _ in status} == {(f"/in/{n}/{f}.csv", "A" if n % 10 == 3 else "I")
                                              for n in range(100) for f in "ab"}
    # a completed file is one row of the snapshot, and so is an active one
    held = spark.read.parquet(f"{table.root}/{snapshot}")
    assert held.count() == held.select("path").distinct().count()
    # the plain folder, whatever copies it holds, folds to the same state
    assert _state(spark.read.parquet(table.root)) == (status, done)


class Stopped(Exception):
    pass


def test_a_crash_before_the_marker_loses_nothing(spark, scratch, monkeypatch):
    _crash(spark, scratch, monkeypatch, "_write_marker")


def test_a_crash_after_the_marker_loses_nothing(spark, scratch, monkeypatch):
    _crash(spark, scratch, monkeypatch, "_vacuum")


def _crash(spark, scratch, monkeypatch, step):
    table = _registry(spark, scratch)
    for n in range(3):
        _load(spark, table, n)
    table.compact(after=1)
    for n in range(3, 6):
        _load(spark, table, n, completes=n != 4)
    before = _state(table.read())

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(E.EventTable, step, stop)
        with pytest.raises(Stopped):
            table.compact(after=1)
    assert _state(table.read()) == before
    _load(spark, table, 6)
    _load(spark, table, 4)                       # the failed load's files, taken again
    after = _state(table.read())
    assert table.compact(after=1) and _state(table.read()) == after
    _load(spark, table, 7)
    assert table.compact(after=1) and after[1] | {7} == _state(table.read())[1]
    snapshots = [n for n in os.listdir(table.root.replace("file:", "")) if n.startswith("append=s")]
    assert len(snapshots) == 2                   # the newest and the one before; none is left over


def test_the_second_of_two_writers_gives_up(spark, scratch, monkeypatch):
    table = _registry(spark, scratch)
    for n in range(2):
        _load(spark, table, n)
    before, write, inner = _state(table.read()), E.EventTable._write_marker, []

    def late(self, marker):                      # another writer is done before this one's marker
        if not inner:
            inner.append(True)
            assert table.compact(after=1)
        return write(self, marker)

    monkeypatch.setattr(E.EventTable, "_write_marker", late)
    assert not table.compact(after=1)
    assert _state(table.read()) == before and len(table.markers()) == 1


def test_a_marker_cut_off_and_an_append_cut_off_do_not_count(spark, scratch):
    table = _registry(spark, scratch)
    for n in range(2):
        _load(spark, table, n)
    root, before = table.root.replace("file:", ""), _state(table.read())
    os.makedirs(f"{root}/_markers")
    open(f"{root}/_markers/{1:012d}.json", "w").write('{"snapshot": "append=s')
    assert _state(table.read()) == before
    assert table.compact(after=1) and [m.number for m in table.markers()] == [2]
    _load(spark, table, 5)
    newest = max((f for f in os.listdir(root) if f.startswith("append=a")), key=lambda f: os.path.getmtime(f"{root}/{f}"))
    os.remove(f"{root}/{newest}/_SUCCESS")
    assert 5 not in _state(table.read())[1] and before[1] <= _state(table.read())[1]
