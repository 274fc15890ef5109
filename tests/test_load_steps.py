"""Steps that loads, job audit and mart streams share: the sales travel no more often than they must."""

import time
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest

from martline.operators import enrich, marts
from martline.plans import catalog, ingest  # noqa: F401  (the catalogue first: it imports the others)
from martline.session import together
from martline.sources import star as S
from tests.conftest import SMALL


@pytest.fixture()
def threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "100000")
    yield
    spark.conf.set(key, old)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sales_are_not_shuffled_to_small_dimensions(spark, threshold):
    fact, star = S.fact_sales(spark, SMALL), S.star(spark, SMALL)
    dims = {n: star[n] for n in ("dim_customer", "dim_store", "dim_sales_team")}
    lazy, settled = enrich.enrich_sales(fact, **dims), enrich.enrich_sales(fact, **enrich.written_dims(star))
    # a dimension that is a join itself looks large, whatever its size
    for key in ("sales_person_id", "store_id"):
        assert f"hashpartitioning({key}" in _plan(lazy) and f"hashpartitioning({key}" not in _plan(settled)
    assert settled.count() == lazy.count() and settled.exceptAll(lazy).isEmpty()


def test_the_largest_dimension_is_joined_to_narrow_sales(spark, threshold):
    dims = enrich.written_dims(S.star(spark, SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    plan = _plan(enrich.enrich_sales(S.fact_sales(spark, SMALL), **dims))
    below = plan[plan.index("hashpartitioning(customer_id"):]
    assert "store_manager_name" not in below.split("FileScan")[0]


def test_parts_are_dealt_out_once(spark):
    day = date(2024, 1, 1)
    rows = [(1, 2, day, "A", Decimal("1.50")), (1, 2, day, "A", Decimal("2.00")), (1, 2, day, "B", Decimal("4.00")),
            (None, 2, day, None, Decimal("8.00")), (None, 2, day, None, None), (1, None, None, "A", None)]
    parts = spark.createDataFrame(
        rows, "store_id int, sales_person_id long, month date, full_name string, part decimal(28,2)")
    totals = marts.SALES.totals(marts.SALES.merged(parts.repartition(*marts.SALES.keys)))
    assert _plan(totals).count("Exchange hashpartitioning") == 1
    # every name of a key has the total of the key
    got = {(r["store_id"], r["sales_person_id"], r["full_name"]): r["total_sales"]
           for r in marts.SALES.of_parts(parts).collect()}
    assert got == {(1, 2, "A"): Decimal("7.50"), (1, 2, "B"): Decimal("7.50"), (None, 2, None): Decimal("8.00"),
                   (1, None, "A"): None}
    customer = spark.createDataFrame([(1, day, "A", "x", "9", Decimal("1.00")), (1, day, "A", "y", "9", Decimal("2.00"))],
                                     "customer_id long, month date, full_name string, address string, "
                                     "phone_number string, part decimal(28,2)")
    mart = marts.CUSTOMER.of_parts(customer)
    assert _plan(mart).count("Exchange hashpartitioning") == 1
    assert [r["total_sales"] for r in mart.collect()] == [Decimal("3.00")] * 2


def test_drops_share_one_join_and_files_are_not_landed_for_nothing(spark, monkeypatch):
    for memo in ("_rows", "_roots", "_runs"):
        monkeypatch.setattr(ingest, memo, {})
    rows = ingest.sales_rows(spark, SMALL)
    assert ingest.sales_rows(spark, SMALL) is rows and "Join" not in _plan(rows)
    ingest.files_root(spark, SMALL, "mixed")
    assert ingest._runs == {}


def test_writes_together_end_before_an_error_is_raised(spark, scratch):
    def late():
        time.sleep(0.5)
        spark.range(5).write.parquet(scratch)
        return "late"

    def bad():
        raise ValueError("bad")

    assert together(spark, late, lambda: 2) == ["late", 2]
    with pytest.raises(ValueError, match="bad"):
        together(spark, bad, lambda: spark.range(7).write.mode("overwrite").parquet(scratch))
    assert spark.read.parquet(scratch).count() == 7


def test_a_mart_stream_writes_few_files_a_month(spark, scratch):
    from martline.streaming import mart_stream as M
    landed = scratch + "/landed"
    rows = [(n % 50, 1, "p", date(2024, 1 + n % 2, 1), 2, Decimal(1), 1, Decimal(n), None, False, None, "f") for n in range(200)]
    spark.createDataFrame(rows, M.C.LANDED_SCHEMA).write.parquet(landed + "/rows/batch_id=0")
    person = "first_name string, last_name string, address string, pincode string"
    dims = {"dim_customer": spark.createDataFrame([(c, "A", str(c), "x", "1", "9") for c in range(50)],
                                                  f"customer_id long, {person}, phone_number string"),
            "dim_store": spark.createDataFrame([(1, "s", "m")], "id int, address string, store_manager_name string"),
            "dim_sales_team": spark.createDataFrame([(2, "C", "D", "y", "1", 2, "Y")],
                                                    f"id long, {person}, manager_id long, is_manager string")}
    M.run_available(M.landed_stream(spark, landed), dims, marts.CUSTOMER, scratch + "/m", scratch + "/c")
    parts = spark.read.parquet(scratch + "/m/customer_mart_parts")
    # 8 tasks hold the state; each would write a file in each month
    files = parts.selectExpr("month", "_metadata.file_path as f").distinct().groupBy("month").count().collect()
    assert len(files) == 2 and all(r["count"] <= M.FILES_A_MONTH for r in files)
    mart = spark.read.parquet(scratch + "/m/customer_mart")
    assert mart.count() == 50 and mart.agg({"total_sales": "sum"}).first()[0] == sum(range(200))
    assert mart.selectExpr("sales_date_month", "_metadata.file_path as f").distinct().count() <= 2 * M.FILES_A_MONTH


def test_parts_are_not_shuffled_by_load(spark, scratch, monkeypatch):
    from martline.plans import daily_load as D
    from martline.sinks import parquet as P
    day = date(2024, 1, 1)
    schema = "store_id int, sales_person_id long, month date, full_name string, part decimal(28,2)"
    for load in (7, 8, 9):
        parts = spark.createDataFrame([(1, 2, day, "A", Decimal(load))], schema)
        P.publish_parts(parts, f"{scratch}/sales_mart_parts", load)
    tables = D.event_tables(spark, scratch)
    files = spark.createDataFrame([("f", "f", n) for n in (7, 8)], "path string, file_name string, load_id long")
    tables["registry"].append(D.registry.complete_files(files, D.F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
                              .drop("load_id").crossJoin(files.select("load_id").distinct()))
    plans = []
    monkeypatch.setattr(D.P, "refresh_months", lambda mart, *a: (plans.append(_plan(mart)), P.write_parquet(mart, a[0])))
    # too large to be broadcast by itself, as a plan of joins over event tables always is
    mart = replace(marts.SALES, finish=lambda totals: totals)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert D._refresh(spark, mart, parts.schema, {"sales_mart": f"{scratch}/sales_mart",
                          "sales_mart_parts": f"{scratch}/sales_mart_parts"}, 9, None, D.counted_loads(tables, 9, 8)) == 1
    finally:
        spark.conf.set(key, old)
    assert spark.read.parquet(f"{scratch}/sales_mart").first()["total_sales"] == Decimal(16)
    # the ids are shuffled among themselves, the parts by the mart's keys only
    assert "BroadcastHashJoin [load_id" in plans[0] and "SortMergeJoin [load_id" not in plans[0].split("BroadcastHashJoin")[0]
