from datetime import datetime

from martline.functions import elapsed_seconds, truncate_text
from martline.operators import audit, quality, registry


def test_cleanse_groups_duplicates_and_reasons(spark):
    df = spark.createDataFrame(
        [(1, "a", False), (1, "a", False), (None, "b", False), (2, None, True)],
        "k long, v string, is_malformed boolean")
    out = {(r["k"], r["v"]): (r["reject_reason"], r["copies"])
           for r in quality.cleanse(df, ["k", "v"], ["k", "v"]).collect()}
    assert out == {(1, "a"): (None, 2), (None, "b"): ("missing_required", 1),
                   (2, None): ("malformed", 1)}


def test_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "pid long")
    assert quality.orphan_count(child, "pid", parent, "id", "c").first()["n_violations"] == 2
    both = quality.orphan_counts(child, [("pid", parent, "id", "a->b"), ("pid", child, "pid", "self")])
    assert {r["check_name"]: r["n_violations"] for r in both.collect()} == {"a->b": 2, "self": 0}
    left = quality.cascade(child, "pid", parent, "id").collect()
    assert sorted(r["pid"] or 0 for r in left) == [0, 1]   # a NULL key refers to nothing and stays
    dups = quality.duplicate_keys(child, "child", ["pid"]).collect()
    assert [(r["key_value"], r["n_rows"]) for r in dups] == [("3", 2)]
    dom = spark.createDataFrame([("Y",), ("N",), ("Q",), (None,)], "f string")
    assert quality.domain_violations(dom, "f", ["Y", "N"], "d").first()["n_violations"] == 2
    nulls = {r["column_name"]: r["n_nulls"]
             for r in quality.null_counts(child, "child", ["pid"]).collect()}
    assert nulls == {"pid": 1}


def test_registry_resume_and_new(spark):
    t = lambda h: datetime(2023, 1, 1, h)
    events = spark.createDataFrame(
        [("/x/a.csv", t(1), "A"), ("/x/a.csv", t(1), "I"), ("/x/b.csv", t(1), "A")],
        "path string, event_time timestamp, status string")
    # equal base names in another folder are other files; at equal times 'I' follows 'A'
    on_hand = spark.createDataFrame([("/x/a.csv",), ("/x/b.csv",), ("/y/a.csv",)], "path string")
    assert [r["path"] for r in registry.resume_files(on_hand, events).collect()] == ["/x/b.csv"]
    assert [r["path"] for r in registry.new_files(on_hand, events).collect()] == ["/y/a.csv"]
    assert sorted(r["path"] for r in registry.files_to_load(on_hand, events).collect()) == ["/x/b.csv", "/y/a.csv"]


def test_latest_state_and_scalars(spark):
    events = spark.createDataFrame(
        [(1, datetime(2023, 1, 1, 0, 0, 0), "RUNNING", None),
         (1, datetime(2023, 1, 1, 0, 0, 1, 234000), "FAILED", "x" * 70000)],
        "job_id int, event_time timestamp, status string, error_message string")
    st = audit.latest_state(events, "job_id", "event_time", ["status", "event_time",
                                                              "error_message"]).first()
    assert st["status"] == "FAILED"
    row = spark.createDataFrame([(st["start_time"], st["event_time"], st["error_message"])],
                                "s timestamp, e timestamp, m string") \
        .select(elapsed_seconds("s", "e").alias("sec"), truncate_text("m").alias("m")).first()
    assert str(row["sec"]) == "1.234" and len(row["m"]) == 65000


def test_cast_to_contract_flags_unparseable_values(spark):
    from martline.contracts import SALES_SCHEMA
    raw = spark.createDataFrame(
        [("1", "121", "2023-03-03", "10.50"), ("x", "121", "2023/03/03", None)],
        "customer_id string, store_id string, sales_date string, total_cost string")
    rows = quality.cast_to_contract(raw, SALES_SCHEMA).collect()
    ok, bad = sorted(rows, key=lambda r: r["is_malformed"])
    assert not ok["is_malformed"] and ok["customer_id"] == 1 and str(ok["total_cost"]) == "10.50"
    assert bad["is_malformed"] and bad["customer_id"] is None and bad["sales_date"] is None
    assert bad["total_cost"] is None   # absent value: NULL, but not a parse failure


def test_file_key_is_stable(spark):
    files = spark.createDataFrame([("/x/a.csv", "a.csv"), ("/y/a.csv", "a.csv")], "path string, file_name string")
    t = datetime(2023, 1, 1)
    from pyspark.sql import functions as F
    k1 = registry.register_files(files, F.lit(t)).first()["file_id"]
    k2 = registry.complete_files(files, F.lit(t)).first()["file_id"]
    assert k1 == k2
    assert registry.register_files(files, F.lit(t)).select("file_id").distinct().count() == 2
