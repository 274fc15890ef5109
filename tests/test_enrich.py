from datetime import date
from decimal import Decimal as D

from martline.operators import enrich

FACT = ("customer_id long, store_id int, product_name string, sales_date date, "
        "sales_person_id long, price decimal(10,2), quantity int, total_cost decimal(18,2)")


def _dims(spark):
    cust = spark.createDataFrame(
        [(1, "F", "L", "A", "1", "91")],
        "customer_id long, first_name string, last_name string, address string, pincode string, "
        "phone_number string")
    store = spark.createDataFrame([(7, "R", "M")], "id int, address string, store_manager_name string")
    team = spark.createDataFrame([(100, "S", "P", 100, "Y", "SA", "7")],
                                 "id long, first_name string, last_name string, manager_id long, "
                                 "is_manager string, address string, pincode string")
    return cust, store, team


def test_enriched_plus_unmatched_is_source(spark):
    cust, store, team = _dims(spark)
    fact = spark.createDataFrame([
        (1, 7, "p", date(2023, 1, 1), 100, D("1.00"), 1, D("1.00")),
        (1, 7, "p", date(2023, 1, 1), 100, D("1.00"), 1, D("1.00")),   # duplicate kept
        (2, 7, "p", date(2023, 1, 1), 100, D("1.00"), 1, D("1.00")),   # no customer
        (2, 8, "p", date(2023, 1, 1), 100, D("1.00"), 1, D("1.00")),   # no customer, store
        (None, 7, "p", date(2023, 1, 1), 101, D("1.00"), 1, D("1.00")),  # NULL key, no team
    ], FACT)
    rich = enrich.enrich_sales(fact, cust, store, team)
    lost = enrich.unmatched_dimension_rows(fact, cust, store, team)
    assert rich.count() == 2
    reasons = sorted(r["missing_dimensions"] for r in lost.collect())
    assert reasons == ["customer", "customer,sales_team", "customer,store"]
    assert rich.count() + lost.count() == fact.count()
    assert len(rich.columns) == len(set(rich.columns))


def test_building_a_plan_starts_no_job(spark):
    from martline.plans.catalog import QUERIES
    from tests.conftest import SMALL
    sc = spark.sparkContext
    for name in ("customer_mart", "sales_detail", "dimension_enrichment",
                 "unmatched_dimension_rows", "synthetic_sales"):
        QUERIES[name](spark, SMALL)                     # table readers are resolved here
    tracker = sc.statusTracker()
    sc.setJobGroup("plan-building", "")
    try:
        for name in ("customer_mart", "sales_detail", "dimension_enrichment",
                     "unmatched_dimension_rows", "synthetic_sales"):
            QUERIES[name](spark, SMALL)
        assert not tracker.getJobIdsForGroup("plan-building")
        spark.range(10).count()
        assert tracker.getJobIdsForGroup("plan-building")   # the counter does count jobs
    finally:
        sc._jsc.clearJobGroup()


def test_long_customer_numbers_stay_whole(spark):
    from martline.functions import padded
    rows = spark.createDataFrame([(7,), (12345678,), (123456789,)], "n long").select(padded("n", 8).alias("t"))
    assert [r["t"] for r in rows.collect()] == ["00000007", "12345678", "123456789"]
