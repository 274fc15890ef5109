import os

from pyspark.sql import functions as F

from martline.contracts import MANDATORY_COLUMNS
from martline.sinks import parquet as P
from martline.sources import sales_files as SF
from martline.sources import star as S
from martline.streaming import file_ingest as T
from tests.conftest import SMALL


def test_dynamic_overwrite_replaces_only_touched_partitions(spark, scratch):
    path = scratch + "/t"
    a = spark.createDataFrame([(1, "2023-01"), (2, "2023-02")], "v int, m string")
    P.write_partitioned(a, path, ["m"])
    P.write_partitioned(spark.createDataFrame([(9, "2023-02")], "v int, m string"), path, ["m"])
    P.write_partitioned(spark.createDataFrame([(9, "2023-02")], "v int, m string"), path, ["m"])
    got = sorted(tuple(r) for r in P.read_partitioned(spark, path, a.schema, ["v", "m"]).collect())
    assert got == [(1, "2023-01"), (9, "2023-02")]


def test_partition_filter_prunes_directories(spark, scratch):
    path = scratch + "/t"
    a = spark.createDataFrame([(1, "2023-01"), (2, "2023-02")], "v int, m string")
    P.write_partitioned(a, path, ["m"])
    q = P.read_partitioned(spark, path, a.schema, ["v", "m"]).where(F.col("m") == "2023-02")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    assert [r["v"] for r in q.collect()] == [2]


def test_stream_ingests_each_file_once(spark, scratch):
    fact = S.fact_sales(spark, SMALL)
    early = F.col("sales_date") < F.lit("1997-01-01").cast("date")
    SF.write_standard_files(fact.where(early), scratch + "/inbox/drop=1")
    stream = T.sales_file_stream(spark, scratch + "/inbox/*/batch=*/*.csv",
                                 archive_dir=scratch + "/archive")
    T.run_available(stream, scratch + "/out", scratch + "/ckpt")
    first = T.read_landed(spark, scratch + "/out").count()
    T.run_available(stream, scratch + "/out", scratch + "/ckpt")   # nothing new
    assert T.read_landed(spark, scratch + "/out").count() == first == fact.where(early).count()
    SF.write_standard_files(fact.where(~early), scratch + "/inbox/drop=2")
    T.run_available(stream, scratch + "/out", scratch + "/ckpt")
    assert T.read_landed(spark, scratch + "/out").count() == fact.count()
    archived = [f for _, _, fs in os.walk(scratch.replace("file:", "") + "/archive") for f in fs
                if f.endswith(".csv")]
    assert archived, "consumed files are moved to the archive"


def test_stream_binds_by_name_and_rejects_files(spark, scratch):
    inbox = scratch.replace("file:", "") + "/inbox"
    os.makedirs(inbox)
    with open(inbox + "/swapped.csv", "w") as f:
        f.write("store_id,customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n"
                "5,121,sugar,2023-03-03,1,50.00,2,100.00\n")
    with open(inbox + "/missing.csv", "w") as f:
        f.write("customer_id,product_name\n1,sugar\n")
    T.run_available(T.sales_file_stream(spark, scratch + "/inbox/*.csv"), scratch + "/out", scratch + "/ckpt")
    (r,) = T.read_landed(spark, scratch + "/out").collect()
    assert (r["customer_id"], r["store_id"], r["is_malformed"]) == (121, 5, False)
    files = {os.path.basename(m["path"]): m["accepted"] for m in spark.read.parquet(scratch + "/out/manifest").collect()}
    assert files == {"swapped.csv": True, "missing.csv": False}


def test_synthetic_total_is_price_times_quantity(spark):
    from martline.sources.synthetic import synthetic_sales
    df = synthetic_sales(spark, SMALL)
    bad = df.where((F.col("total_cost") != F.col("price") * F.col("quantity"))
                   | ~F.col("quantity").between(1, 10)).count()
    assert bad == 0 and df.count() == spark.read.parquet(SMALL + "/lineitem.parquet").count()


def test_daily_load_end_to_end(spark, scratch):
    from martline.plans.daily_load import run_daily_load
    fact = S.fact_sales(spark, SMALL)
    SF.write_sales_files(fact, scratch + "/in")
    res = run_daily_load(spark, scratch + "/in", scratch + "/out", S.star(spark, SMALL))
    landed = res.ingest.landed
    files = spark.read.parquet(scratch + "/out/file_audit")
    assert {r["status"] for r in files.select("status").distinct().collect()} == {"RUNNING", "SUCCESS", "FAILED"}
    done = files.where("status <> 'RUNNING'")
    assert done.agg(F.sum("rows_read")).first()[0] == landed.count()
    assert done.where("end_time < start_time or processing_time_seconds is null or source_system is null").count() == 0
    jobs = spark.read.parquet(scratch + "/out/job_audit")
    assert sorted(r["status"] for r in jobs.collect()) == ["RUNNING", "SUCCESS"]
    job = jobs.where("status = 'SUCCESS'").first()
    assert files.where(F.col("job_id") != job["job_id"]).count() == 0
    assert job["execution_time_seconds"] > 0
    assert job["spark_application_id"] == spark.sparkContext.applicationId
    assert job["rows_read"] == landed.count()
    assert job["rows_rejected"] == landed.where("is_malformed").count() > 0
    from martline.operators import audit
    state = audit.latest_state(jobs, "job_id", "event_time", ["status", "rows_read"]).collect()
    assert [(r["status"], r["rows_read"]) for r in state] == [("SUCCESS", landed.count())]
    reg = spark.read.parquet(scratch + "/out/registry")
    assert reg.groupBy("status").count().count() == 2
    held = spark.read.parquet(scratch + "/out/quarantine")
    assert {r["reason"] for r in held.select("reason").distinct().collect()} == {"malformed", "missing_required"}
    assert held.where("reason = 'malformed' and (raw_record is null or source_file is null)").count() == 0
    sales = spark.read.parquet(res.sales_mart_path)
    assert sales.count() == job["sales_mart_rows_written"]
    before = sorted(map(tuple, sales.collect()))
    # second run over the same files: nothing is taken again, nothing changes
    again = run_daily_load(spark, scratch + "/in", scratch + "/out", S.star(spark, SMALL))
    assert again.ingest.manifest.where("accepted").count() == 0
    assert sorted(map(tuple, spark.read.parquet(res.sales_mart_path).collect())) == before


HEAD = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n"


def _tiny_dims(spark):
    return {"dim_customer": spark.createDataFrame(
                [(1, "F", "L", "A", "1", "91")], "customer_id long, first_name string, last_name string, "
                "address string, pincode string, phone_number string"),
            "dim_store": spark.createDataFrame([(7, "R", "M")], "id int, address string, store_manager_name string"),
            "dim_sales_team": spark.createDataFrame(
                [(100, "S", "P", 100, "Y", "SA", "7")], "id long, first_name string, last_name string, "
                "manager_id long, is_manager string, address string, pincode string")}


def _drop(scratch, name, *lines):
    path = scratch.replace("file:", "") + "/in/" + name
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(HEAD + "".join(line + "\n" for line in lines))


def test_two_days_in_one_month_add_up(spark, scratch):
    from decimal import Decimal as D

    from martline.plans.daily_load import run_daily_load
    dims = _tiny_dims(spark)
    _drop(scratch, "day1/sales.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00")
    run_daily_load(spark, scratch + "/in", scratch + "/out", dims)
    _drop(scratch, "day2/sales.csv", "1,7,sugar,2023-03-04,100,3.50,2,7.00", "1,7,sugar,2023-03-05,100,n/a,1,40.00")
    broken = {**dims, "dim_store": dims["dim_store"].drop("store_manager_name")}
    import pytest
    with pytest.raises(Exception):
        run_daily_load(spark, scratch + "/in", scratch + "/out", broken)
    res = run_daily_load(spark, scratch + "/in", scratch + "/out", dims)
    (mart,) = spark.read.parquet(res.sales_mart_path).collect()
    # the row with the bad price counts: the mart needs no price
    assert (mart["total_sales"], mart["incentive"]) == (D("147.00"), D("1.47"))
    (customer,) = spark.read.parquet(res.customer_mart_path).collect()
    assert customer["total_sales"] == D("147.00")
    assert spark.read.parquet(scratch + "/out/sales_partitioned").count() == 3
    (flagged,) = spark.read.parquet(scratch + "/out/quarantine").where(F.col("load_id") == res.load_id).collect()
    assert flagged["raw_record"].endswith("n/a,1,40.00") and flagged["source_file"].endswith("day2/sales.csv")


def test_a_load_reads_touched_parts_only(spark, scratch):
    """The second load finds the sales of the first, and the parts of other months, unreadable."""
    from decimal import Decimal as D

    from martline.plans.daily_load import run_daily_load
    _drop(scratch, "day1/sales.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00", "1,7,tea,2023-02-03,100,5.00,1,5.00")
    run_daily_load(spark, scratch + "/in", scratch + "/out", _tiny_dims(spark))
    out = scratch.replace("file:", "") + "/out"
    spoiled = 0
    for folder, _, names in os.walk(out):
        if any(f"/{t}" in folder for t in ("customer_detail", "sales_detail", "sales_partitioned", "month=2023-02-01", "landing")):
            for name in names:
                os.remove(f"{folder}/.{name}.crc") if os.path.exists(f"{folder}/.{name}.crc") else None
                if name.endswith(".parquet"):
                    open(f"{folder}/{name}", "w").write("no parquet")
                    spoiled += 1
    assert spoiled >= 6
    _drop(scratch, "day2/sales.csv", "1,7,sugar,2023-03-04,100,3.50,2,7.00")
    res = run_daily_load(spark, scratch + "/in", scratch + "/out", _tiny_dims(spark))
    for path in (res.sales_mart_path, res.customer_mart_path):
        assert sorted(r["total_sales"] for r in spark.read.parquet(path).collect()) == [D("5.00"), D("107.00")]


def test_a_replaced_load_leaves_the_marts(spark, scratch):
    from decimal import Decimal as D

    from martline.plans.daily_load import published, run_daily_load
    dims, out = _tiny_dims(spark), scratch + "/out"
    _drop(scratch, "day1/sales.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00")
    run_daily_load(spark, scratch + "/in", out, dims)
    _drop(scratch, "day2/sales.csv", "1,7,sugar,2023-03-04,100,3.50,2,7.00", "1,7,sugar,2023-04-04,100,3.50,2,9.00")
    wrong = run_daily_load(spark, scratch + "/in", out, dims)
    _drop(scratch, "day2b/sales.csv", "1,7,sugar,2023-03-04,100,3.50,2,8.00")
    broken = {**dims, "dim_store": dims["dim_store"].drop("store_manager_name")}
    import pytest
    with pytest.raises(Exception):                  # a failed replacement takes nothing away
        run_daily_load(spark, scratch + "/in", out, broken, replaces=wrong.load_id)
    assert published(spark, out, "sales_detail").agg(F.sum("total_cost")).first()[0] == D("116.00")
    res = run_daily_load(spark, scratch + "/in", out, dims, replaces=wrong.load_id)
    (mart,) = spark.read.parquet(res.sales_mart_path).collect()         # April has no sale left
    assert (mart["sales_month"], mart["total_sales"]) == ("2023-03", D("108.00"))
    (customer,) = spark.read.parquet(res.customer_mart_path).collect()
    assert customer["total_sales"] == D("108.00")
    for name in ("customer_detail", "sales_detail", "sales_partitioned"):
        assert published(spark, out, name).agg(F.sum("total_cost")).first()[0] == D("108.00")
    # a replacement without rows: only the replaced load leaves
    run_daily_load(spark, scratch + "/in", out, dims, replaces=res.load_id)
    assert [r["total_sales"] for r in spark.read.parquet(res.sales_mart_path).collect()] == [D("100.00")]


def test_daily_load_failure_is_audited(spark, scratch):
    import pytest

    from martline.plans.daily_load import run_daily_load
    fact = S.fact_sales(spark, SMALL)
    SF.write_sales_files(fact, scratch + "/in")
    dims = dict(S.star(spark, SMALL))
    dims["dim_store"] = dims["dim_store"].drop("store_manager_name")   # breaks enrichment
    with pytest.raises(Exception):
        run_daily_load(spark, scratch + "/in", scratch + "/out", dims)
    job = spark.read.parquet(scratch + "/out/job_audit").where("status <> 'RUNNING'").first()
    assert job["status"] == "FAILED" and job["failure_stage"] == "DETAIL_MART_WRITE"
    assert job["error_message"] and len(job["error_message"]) <= 65000


def test_stream_restart_after_stop_is_exactly_once(spark, scratch):
    import time

    fact = S.fact_sales(spark, SMALL).where(F.col("sales_date") < F.lit("1995-07-01").cast("date"))
    SF.write_standard_files(fact, scratch + "/inbox")
    stream = T.sales_file_stream(spark, scratch + "/inbox/batch=*/*.csv", max_files_per_trigger=1)
    query = T.start(stream, scratch + "/out", scratch + "/ckpt", processingTime="0 seconds")
    deadline = time.time() + 120
    while not os.path.exists(scratch.replace("file:", "") + "/out/rows/batch_id=0/_SUCCESS"):
        assert time.time() < deadline, "first micro-batch did not commit"
        time.sleep(0.2)
    query.stop()                                    # interrupted mid-way
    T.run_available(stream, scratch + "/out", scratch + "/ckpt", timeout_sec=300)
    rows = T.read_landed(spark, scratch + "/out").select(*MANDATORY_COLUMNS)
    assert rows.count() == fact.count() > 0
    assert rows.exceptAll(fact.select(*MANDATORY_COLUMNS)).count() == 0
    assert fact.select(*MANDATORY_COLUMNS).exceptAll(rows).count() == 0


def test_failed_load_is_resumed_by_the_next_run(spark, scratch):
    import pytest

    from martline.operators import registry
    from martline.plans.daily_load import run_daily_load
    fact = S.fact_sales(spark, SMALL)
    SF.write_sales_files(fact, scratch + "/in")
    good = S.star(spark, SMALL)
    broken = dict(good)
    broken["dim_store"] = good["dim_store"].drop("store_manager_name")
    with pytest.raises(Exception):
        run_daily_load(spark, scratch + "/in", scratch + "/out", broken)
    events = spark.read.parquet(scratch + "/out/registry")
    on_hand = events.select("path").distinct()
    pending = registry.resume_files(on_hand, events).count()
    assert pending == on_hand.count() > 0          # registered, never completed
    res = run_daily_load(spark, scratch + "/in", scratch + "/out", good)
    events = spark.read.parquet(scratch + "/out/registry")
    assert registry.resume_files(on_hand, events).count() == 0
    clean = run_daily_load(spark, scratch + "/in", scratch + "/clean", good)
    resumed = spark.read.parquet(res.sales_mart_path)
    fresh = spark.read.parquet(clean.sales_mart_path).select(*resumed.columns)
    assert resumed.exceptAll(fresh).count() == 0 and fresh.exceptAll(resumed).count() == 0


def test_mart_stream_adds_up_and_closes_days(spark, scratch):
    """A late sale is added to its old month; the state keeps running sums within an arrival day."""
    from decimal import Decimal as D

    from martline.operators import marts
    from martline.streaming import mart_stream as M
    dims = _tiny_dims(spark)
    for name, lines in (("a", ["1,7,sugar,2023-03-03,100,50.00,2,100.00", "1,7,sugar,,100,50.00,2,55.00"]),
                        ("b", ["1,7,sugar,2023-04-03,100,50.00,2,9.00"]),
                        ("c", ["1,7,sugar,2023-03-05,100,50.00,2,7.00", "1,7,sugar,2023-03-05,100,50.00,2,7.00"])):
        _drop(scratch, name + ".csv", *lines)
        T.run_available(T.sales_file_stream(spark, scratch + "/in/*.csv"), scratch + "/out", scratch + "/ckpt")
        for _ in range(2):                          # a run without news changes nothing
            query = M.run_available(M.landed_stream(spark, scratch + "/out"), dims, marts.SALES, scratch + "/marts",
                                    scratch + "/ckpt_sales")
    assert M.dropped_rows(query) == 0
    got = {r["sales_month"]: r["total_sales"] for r in spark.read.parquet(scratch + "/marts/sales_mart").collect()}
    assert got == {"2023-03": D("114.00"), "2023-04": D("9.00")}
    sums = sorted(r["part"] for r in spark.read.parquet(scratch + "/marts/sales_mart_parts").collect())
    assert sums == [D("9.00"), D("100.00"), D("114.00")]    # 114: the state had the 100


def test_a_landed_batch_is_not_written_again(spark, scratch):
    _drop(scratch, "a.csv", "1,7,sugar,2023-03-03,100,50.00,2,100.00")
    from martline.sources import csv_ingest as C
    files = C.list_csv_files(spark, scratch + "/in")
    folder = scratch.replace("file:", "") + "/out/rows/batch_id=0"
    T._land(files, 0, scratch + "/out")
    before = sorted(os.listdir(folder))
    T._land(files, 0, scratch + "/out")
    assert sorted(os.listdir(folder)) == before
    os.remove(folder + "/_SUCCESS")                 # an attempt that was cut off is repeated
    T._land(files, 0, scratch + "/out")
    assert sorted(os.listdir(folder)) != before and T.read_landed(spark, scratch + "/out").count() == 1
