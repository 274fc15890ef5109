"""The sales CSV source: byte ranges, headers by place, and only the chosen files."""

import io
import os
import random

import pytest

from martline.sources import csv_ingest as C
from martline.sources import sales_scan as S
from tests.test_csv_ingest import HEAD, _local, _write


@pytest.mark.parametrize("seed", range(30))
def test_ranges_hold_every_line_once(seed):
    rnd = random.Random(seed)
    lines = [bytes(rnd.choice(b"ab,\r") for _ in range(rnd.randrange(12))) for _ in range(rnd.randrange(40))]
    data = b"\n".join(lines) + rnd.choice([b"", b"\n"])
    want = data.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    for width in (1, 2, 7, 50, 10 ** 6):
        got = []
        for start in range(0, len(data), width):
            for some in S.lines_of(io.BytesIO(data), start, min(len(data), start + width), chunk=rnd.choice([1, 3, 64])):
                got += some
        assert got == want, width


def test_plan_cuts_large_files_and_shares_small_ones():
    files = [(f"f{i}", 10, ["a"], []) for i in range(100)] + [("big", 3 * (8 << 20) + 5, ["b"], [])]
    parts = S.plan_ranges(files, 8 << 20)
    ranges = [r for p in parts for r in p.ranges]
    assert sum(r.end - r.start for r in ranges) == 1000 + 3 * (8 << 20) + 5
    assert [(r.start, r.end) for r in ranges if r.path == "big"][-1] == (3 * (8 << 20), 3 * (8 << 20) + 5)
    assert len(parts) < 25 and max(len(p.ranges) for p in parts) >= 7
    assert S.plan_ranges([]) == []


def _row(i):
    return f"{i},121,sugar,2023-03-03,1,50.00,2,100.00"


def test_large_file_read_in_ranges(spark, scratch):
    root = _local(scratch) + "/in"
    _write(root, "a.csv", "\n" + HEAD + "\r\n" + "".join(_row(i) + "\r\n" for i in range(500)))
    _write(root, "b.csv", "x," + HEAD + "\n" + "".join(f"v,{_row(i)}\n" for i in range(500, 700)))
    C.validate_headers(C.probe_headers(C.list_csv_files(spark, root))).write.parquet(scratch + "/manifest")
    lines = S.scan(spark, scratch + "/manifest", partition_bytes=1000)
    assert lines.rdd.getNumPartitions() > 20
    rows = C.bind_lines(lines, 9).collect()
    assert sorted(r["customer_id"] for r in rows) == list(range(700)) and not any(r["is_malformed"] for r in rows)
    assert {r["additional_column"] for r in rows if r["customer_id"] >= 500} == {"x"}


def test_repeated_header_is_a_bad_row(spark, scratch):
    root = _local(scratch) + "/in"
    _write(root, "a.csv", HEAD + "\n" + _row(1) + "\n" + HEAD + "\n" + _row(2) + "\n")
    rows = C.ingest_sales(spark, root, scratch + "/landing").landed.collect()
    assert sorted((r["is_malformed"], r["customer_id"]) for r in rows if not r["is_malformed"]) == [(False, 1), (False, 2)]
    assert [r["raw_record"] for r in rows if r["is_malformed"]] == [HEAD]


def test_only_chosen_files_are_opened(spark, scratch, monkeypatch):
    """The second load plans and opens none of the first load's files, nor rejected ones."""
    root = _local(scratch) + "/in"
    for i in range(10):
        _write(root, f"old{i}.csv", HEAD + "\n" + _row(i) + "\n")
    _write(root, "new.csv", HEAD + "\n" + _row(99) + "\n")
    _write(root, "short.csv", HEAD.replace(",price", "") + "\n")
    run = C.ingest_sales(spark, root, scratch + "/landing", choose=lambda f: f.where(
        "path like '%new.csv' or path like '%short.csv'"))
    opened = []
    real = S.open_file
    monkeypatch.setattr(S, "open_file", lambda uri: opened.append(os.path.basename(uri)) or real(uri))
    reader = S.SalesCsvReader({"manifest": scratch + "/landing/manifest"})
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert opened == ["new.csv"] and sum(b.num_rows for b in batches) == 1
    # what Spark itself read: the other files may as well be gone
    assert [r["customer_id"] for r in run.landed.collect()] == [99]


def test_nothing_accepted_reads_nothing(spark, scratch):
    spark.createDataFrame([], "path string, file_size long, columns array<string>, extra_columns array<string>, "
                              "accepted boolean").write.parquet(scratch)
    assert S.scan(spark, scratch).collect() == []
