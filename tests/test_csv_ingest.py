import os
from decimal import Decimal as D

from martline.sources import csv_ingest as C

SMALL_DIR = "/root/testdata/sf0.001"
HEAD = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write(root, name, text):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as f:
        f.write(text)


def _fixture(scratch):
    root = _local(scratch) + "/in"
    _write(root, "valid.csv", HEAD + "\n1,121,sugar,2023-03-03,1,50.00,2,100.00\n")
    _write(root, "extra.csv",
           "payment_mode," + HEAD + "\nUPI,2,122,maida,2023-03-04,4,20.00,3,60.00\n")
    _write(root, "reordered.csv",
           "total_cost,quantity,price,sales_person_id,sales_date,product_name,store_id,customer_id\n"
           "10.50,1,10.50,7,2023-03-05,besan,123,3\n")
    _write(root, "missing.csv",
           "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n"
           "1,sugar,2023-03-03,[1, 2, 3],50.00,2,100.00\n")
    _write(root, "malformed.csv", HEAD + "\n"
           "x,121,sugar,2023-03-03,1,50.00,2,100.00\n"
           "5,121,sugar,2023/03/03,1,50.00,2,100.00\n"
           "6,121,sugar,2023-03-03,1,50.00\n"
           "7,121,sugar,2023-03-03,1,50.00,2,100.00,extra\n")
    _write(root, "empty.csv", "")
    _write(root, "notes.txt", "not a csv\n")
    return root


def _manifest(spark, root):
    return {r["file_name"]: r for r in
            C.validate_headers(C.probe_headers(C.list_csv_files(spark, root))).collect()}


def test_header_contract(spark, scratch):
    m = _manifest(spark, _fixture(scratch))
    assert set(m) == {"valid.csv", "extra.csv", "reordered.csv", "missing.csv", "malformed.csv", "empty.csv"}
    assert m["valid.csv"]["accepted"] and m["reordered.csv"]["accepted"]
    assert m["extra.csv"]["accepted"] and m["extra.csv"]["extra_columns"] == ["payment_mode"]
    assert not m["missing.csv"]["accepted"]
    assert m["missing.csv"]["missing_columns"] == ["store_id"]
    # a file of zero bytes is listed and rejected
    assert not m["empty.csv"]["accepted"] and m["empty.csv"]["reason"] == "no header"
    assert m["empty.csv"]["file_size"] == 0


def test_odd_headers(spark, scratch):
    root = _local(scratch) + "/in"
    row = "1,121,sugar,2023-03-03,1,50.00,2,100.00"
    _write(root, "quoted.csv", '"note, free",' + HEAD + '\n"a, b",' + row + "\n")
    _write(root, "twice.csv", HEAD + ",Price\n" + row + ",7\n")
    _write(root, "reserved.csv", HEAD + ",_corrupt_record\n" + row + ",x\n")
    _write(root, "padded.csv", HEAD.replace(",price", ", price") + "\n" + row + "\n")
    _write(root, "blank_first.csv", "\n\n" + HEAD + "\n" + row + "\n")
    _write(root, "no_newline.csv", HEAD)
    _write(root, "only_blank.csv", "\n \n")
    _write(root, "endless.csv", "x" * (C.HEADER_BYTES + 10))
    m = _manifest(spark, root)
    assert {n for n, r in m.items() if r["accepted"]} == {"quoted.csv", "reserved.csv", "blank_first.csv", "no_newline.csv"}
    assert m["twice.csv"]["missing_columns"] == m["padded.csv"]["missing_columns"] == ["price"]
    assert m["only_blank.csv"]["reason"] == "no header"
    assert "bytes" in m["endless.csv"]["reason"]
    # one odd file does not harm the others, and quoted commas shift nothing
    run = C.ingest_sales(spark, root, _local(scratch) + "/landing")
    got = {os.path.basename(r["source_file"]): r for r in run.landed.collect()}
    assert set(got) == {"quoted.csv", "reserved.csv", "blank_first.csv"}
    assert all((r["customer_id"], r["store_id"], r["price"], r["quantity"]) == (1, 121, D("50.00"), 2)
               and not r["is_malformed"] for r in got.values())
    assert got["quoted.csv"]["additional_column"] == "note, free"


def test_blank_first_line_is_skipped(spark, scratch):
    root = _local(scratch) + "/in"
    _write(root, "blank.csv", "\n1,121,sugar\n")
    r = _manifest(spark, root)["blank.csv"]
    assert not r["accepted"] and r["header"] == "1,121,sugar" and len(r["missing_columns"]) == 8


def test_values_bound_by_name_and_bad_rows_flagged(spark, scratch):
    root = _fixture(scratch)
    run = C.ingest_sales(spark, root, _local(scratch) + "/landing")
    rows = run.landed.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r["source_file"]), []).append(r)
    assert "missing.csv" not in by_file and "empty.csv" not in by_file
    (reordered,) = by_file["reordered.csv"]
    assert (reordered["customer_id"], reordered["store_id"], reordered["total_cost"]) == \
        (3, 123, D("10.50"))
    (extra,) = by_file["extra.csv"]
    assert extra["additional_column"] == "payment_mode" and extra["store_id"] == 122
    (valid,) = by_file["valid.csv"]
    assert valid["additional_column"] is None and not valid["is_malformed"]
    bad = by_file["malformed.csv"]
    assert len(bad) == 4 and all(r["is_malformed"] for r in bad)
    assert {r["customer_id"] for r in bad} == {None, 5, 6, 7}
    assert [r["sales_date"] for r in bad if r["customer_id"] == 5] == [None]
    # the raw line of every flagged row is kept
    assert sorted(r["raw_record"].split(",")[0] for r in bad) == ["5", "6", "7", "x"]
    assert valid["raw_record"] is None
    # counted during the landing write, equal to the landed table
    assert run.observation.get["rows"] == len(rows) == 7
    assert run.observation.get["malformed"] == 4


def test_unreadable_file_is_rejected_not_fatal(spark, scratch):
    import pandas as pd
    root = _local(scratch) + "/in"
    _write(root, "valid.csv", HEAD + "\n1,121,sugar,2023-03-03,1,50.00,2,100.00\n")
    probe = pd.DataFrame({"path": ["file:" + root + "/valid.csv", "file:" + root + "/gone.csv"],
                          "file_size": [1, 1], "modified_at": [None, None]})
    out = list(C._probe(iter([probe])))[0]
    assert out.loc[0, "header"] == HEAD and out.loc[0, "probe_error"] is None
    assert out.loc[1, "header"] is None and "gone.csv" in out.loc[1, "probe_error"]
    out["file_size"] = [1, 1]
    manifest = spark.createDataFrame(
        [(r.path, 1, None, r.header, list(r.columns_), r.probe_error)
         for r in out.rename(columns={"columns": "columns_"}).itertuples()], C.MANIFEST_SCHEMA)
    rows = {r["file_name"]: r for r in C.validate_headers(manifest).collect()}
    assert rows["valid.csv"]["accepted"]
    assert not rows["gone.csv"]["accepted"] and rows["gone.csv"]["reason"].startswith("unreadable")


def test_probe_ships_without_the_package(spark, tmp_path):
    """Workers need not have this package: the probe is pickled by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    C.probe_headers(C.list_csv_files(spark, SMALL_DIR))   # registers by-value pickling
    blob = tmp_path / "probe.pkl"
    blob.write_bytes(cloudpickle.dumps(C._probe))
    code = ("import pickle, sys; sys.path = [p for p in sys.path if 'repo' not in p]; "
            f"f = pickle.load(open({str(blob)!r}, 'rb')); print(f.__name__)")
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "_probe"
