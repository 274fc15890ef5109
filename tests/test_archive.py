"""The batch archive: two phases, stopped between them, repeated."""

import os

import pytest
from pyspark.sql import functions as F

from martline.plans import daily_load as L
from martline.sinks import archive as A
from tests.test_sinks_stream import _drop, _tiny_dims


def _files(scratch, folder):
    root = scratch.replace("file:", "") + "/" + folder
    return sorted(os.path.relpath(f"{d}/{f}", root) for d, _, fs in os.walk(root) for f in fs if f.endswith(".csv"))


def _run(spark, scratch, **options):
    return L.run_daily_load(spark, scratch + "/in", scratch + "/out", _tiny_dims(spark), **options)


def test_completed_and_rejected_files_leave_the_inbox_once(spark, scratch):
    _drop(scratch, "north/sales.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00")
    _drop(scratch, "south/sales.csv", "1,7,sugar,2023-03-04,100,50.00,2,10.00")     # the same name
    first = _run(spark, scratch)                                                    # moves nothing
    assert _files(scratch, "in") == ["north/sales.csv", "south/sales.csv"]
    _drop(scratch, "north/more.csv", "1,7,tea,2023-03-05,100,1.00,1,1.00")
    with open(scratch.replace("file:", "") + "/in/odd.csv", "w") as f:
        f.write("customer_id\n1\n")
    open(scratch.replace("file:", "") + "/in/none.csv", "w").close()
    open(scratch.replace("file:", "") + "/in/notes.txt", "w").close()
    second = _run(spark, scratch, archive_root=scratch + "/old")
    assert _files(scratch, "in") == [] and os.listdir(scratch.replace("file:", "") + "/in").count("notes.txt") == 1
    one, two = f"load_id={first.load_id}", f"load_id={second.load_id}"
    assert _files(scratch, "old/processed") == sorted(
        [f"{one}/north/sales.csv", f"{one}/south/sales.csv", f"{two}/north/more.csv"])
    assert _files(scratch, "old/rejected") == [f"{two}/none.csv", f"{two}/odd.csv"]
    again = L.archive_files(L.event_tables(spark, scratch + "/out"), scratch + "/in", scratch + "/old")
    assert again.count() == 0
    assert [r["total_sales"] for r in spark.read.parquet(second.sales_mart_path).collect()][0] == 111


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["intents", "carry_out"])
def test_a_run_killed_between_the_phases(spark, scratch_of, monkeypatch, step):
    scratch = scratch_of(step)
    _drop(scratch, "a.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00")
    _drop(scratch, "b.csv", "1,7,sugar,2023-03-04,100,50.00,2,10.00")

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(A, step, stop)
        with pytest.raises(Stopped):
            _run(spark, scratch, archive_root=scratch + "/old")
    last = spark.read.parquet(scratch + "/out/job_audit").where("status = 'FAILED'").first()
    assert last["failure_stage"] == "FILE_ARCHIVAL"
    assert _files(scratch, "in") == ["a.csv", "b.csv"]
    if step == "carry_out":                     # one file is moved, its outcome is not written
        due = L.event_tables(spark, scratch + "/out")["moves"].read().where(F.col("path").endswith("a.csv")).first()
        assert A.move_file(due["path"], due["target"], due["file_size"]) == A.MOVED
    res = _run(spark, scratch, archive_root=scratch + "/old")      # loads nothing, ends the archive
    assert _files(scratch, "in") == [] and len(_files(scratch, "old/processed")) == 2
    moves = A.latest_moves(L.event_tables(spark, scratch + "/out")["moves"].read())
    assert [r["status"] for r in moves.collect()] == [A.MOVED] * 2
    assert [r["total_sales"] for r in spark.read.parquet(res.sales_mart_path).collect()] == [110]


def test_a_move_looks_at_both_places(tmp_path):
    old, new = tmp_path / "old.csv", tmp_path / "to" / "new.csv"
    move = lambda size: A.move_file(f"file://{old}", f"file://{new}", size)
    assert move(3) == A.MISSING
    old.write_text("abc")
    assert move(4) == A.CHANGED and old.exists()                   # another file than the one loaded
    assert move(3) == A.MOVED and new.read_text() == "abc" and not old.exists()
    assert move(3) == A.MOVED                                      # repeated
    old.write_text("abc")                                          # a copy whose delete was cut off
    assert move(3) == A.MOVED and not old.exists()
    new.write_text("a")                                            # a copy that was cut off itself
    old.write_text("abc")
    assert move(3) == A.MOVED and new.read_text() == "abc"
    old.write_text("later")                                        # delivered again under the old name
    assert move(3) == A.MOVED and old.exists()


def test_files_elsewhere_and_a_failing_move(spark, scratch, tmp_path):
    table = A.move_table(spark, scratch + "/out")
    now = F.current_timestamp().cast("timestamp_ntz")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("x")
    (tmp_path / "blocked").write_text("a file where a folder should be")
    rows = spark.createDataFrame([(f"file://{tmp_path}/in/x.csv", 1, 5), ("file:///other/in/y.csv", 1, 5)],
                                 "path string, file_size long, load_id long")
    table.append(A.intents(rows, table.read(), f"{tmp_path}/in", f"file://{tmp_path}/blocked", now))
    (tried,) = A.carry_out(table, now).collect()
    assert (tried["status"], bool(tried["error"])) == (A.FAILED, True) and (tmp_path / "in" / "x.csv").exists()
    (tmp_path / "blocked").unlink()
    (tried,) = A.carry_out(table, now).collect()                   # tried again
    assert tried["status"] == A.MOVED and tried["target"].endswith("/blocked/load_id=5/x.csv")
    assert A.carry_out(table, now).count() == 0
