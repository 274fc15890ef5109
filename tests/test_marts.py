from datetime import date
from decimal import Decimal as D

from martline.contracts import SALES_DETAIL_COLUMNS
from martline.operators import marts

SALES_SCHEMA = ("store_id int, sales_person_id long, sales_person_first_name string, "
                "sales_person_last_name string, store_manager_name string, manager_id long, "
                "is_manager string, sales_person_address string, sales_person_pincode string, "
                "sales_date date, total_cost decimal(18,2), sales_month string")


def _sales(spark, rows):
    full = [(s, p, f, l, "m", 1, "N", "a", "1", d, D(t) if t is not None else None,
             d.strftime("%Y-%m") if d else None) for s, p, f, l, d, t in rows]
    return spark.createDataFrame(full, SALES_SCHEMA).select(*SALES_DETAIL_COLUMNS)


def _by_person(df):
    return {(r["sales_person_id"], r["sales_month"]): r for r in df.collect()}


def test_sales_mart_ties_share_incentive(spark):
    rows = [(1, 10, "A", "X", date(2023, 3, 1), "100.00"),
            (1, 10, "A", "X", date(2023, 3, 5), "50.00"),
            (1, 11, "B", "Y", date(2023, 3, 2), "150.00"),
            (1, 12, "C", "Z", date(2023, 3, 3), "20.00")]
    out = _by_person(marts.sales_mart(_sales(spark, rows)))
    assert out[(10, "2023-03")]["total_sales"] == D("150.00")
    assert out[(10, "2023-03")]["incentive"] == D("1.50")
    assert out[(11, "2023-03")]["incentive"] == D("1.50")
    assert out[(12, "2023-03")]["incentive"] == D("0.00")


def test_incentive_rounds_half_up(spark):
    rows = [(1, 10, "A", "X", date(2023, 3, 1), "1234.50")]
    out = _by_person(marts.sales_mart(_sales(spark, rows)))
    assert out[(10, "2023-03")]["incentive"] == D("12.35")


def test_null_totals_rank_last_and_all_null_group_ties(spark):
    rows = [(1, 10, "A", "X", date(2023, 3, 1), None),
            (1, 11, "B", "Y", date(2023, 3, 1), "10.00"),
            (2, 20, "C", "Z", date(2023, 3, 1), None),
            (2, 21, "D", "W", date(2023, 3, 1), None)]
    out = _by_person(marts.sales_mart(_sales(spark, rows)))
    assert out[(10, "2023-03")]["incentive"] == D("0.00")
    assert out[(11, "2023-03")]["incentive"] == D("0.10")
    assert out[(20, "2023-03")]["incentive"] is None
    assert out[(21, "2023-03")]["incentive"] is None


def test_window_key_semantics_with_two_names(spark):
    # One salesperson, two name spellings: each output tuple carries the
    # total of the whole (store, person, month) window, as window + DISTINCT would.
    rows = [(1, 10, "A", "X", date(2023, 3, 1), "100.00"),
            (1, 10, "A", "Xx", date(2023, 3, 2), "30.00")]
    out = marts.sales_mart(_sales(spark, rows)).collect()
    assert sorted(r["full_name"] for r in out) == ["A X", "A Xx"]
    assert {r["total_sales"] for r in out} == {D("130.00")}


def test_full_name_null_when_part_missing(spark):
    rows = [(1, 10, "A", None, date(2023, 3, 1), "5.00")]
    out = marts.sales_mart(_sales(spark, rows)).collect()
    assert out[0]["full_name"] is None


def test_store_month_rank_ties(spark):
    rows = [(1, 10, "A", "X", date(2023, 3, 1), "100.00"),
            (1, 11, "B", "Y", date(2023, 3, 1), "100.00"),
            (1, 12, "C", "Z", date(2023, 3, 1), "50.00")]
    ranks = {r["sales_person_id"]: r["rnk"]
             for r in marts.store_month_rank(_sales(spark, rows)).collect()}
    assert ranks == {10: 1, 11: 1, 12: 3}


def test_customer_mart_month_start_and_totals(spark):
    schema = ("customer_id long, first_name string, last_name string, address string, "
              "pincode string, phone_number string, sales_date date, total_cost decimal(18,2)")
    rows = [(1, "F", "L", "A", "1", "91", date(2023, 3, 9), D("1.10")),
            (1, "F", "L", "A", "1", "91", date(2023, 3, 20), D("2.20")),
            (1, "F", "L", "A", "1", "91", date(2023, 4, 1), D("5.00"))]
    out = {r["sales_date_month"]: r["total_sales"]
           for r in marts.customer_mart(spark.createDataFrame(rows, schema)).collect()}
    assert out == {date(2023, 3, 1): D("3.30"), date(2023, 4, 1): D("5.00")}


def test_row_window_keeps_null_keys_and_duplicates(spark):
    rows = [(1, 10, "A", "X", date(2023, 3, 1), "1.00"),
            (1, 10, "A", "X", date(2023, 3, 1), "1.00"),
            (None, 10, "A", "X", date(2023, 3, 1), "2.00")]
    out = marts.sales_month_window(_sales(spark, rows)).collect()
    assert len(out) == 3
    totals = sorted((r["store_id"] is None, r["total_sales_every_month"]) for r in out)
    assert totals == [(False, D("2.00")), (False, D("2.00")), (True, D("2.00"))]


def test_grouped_plan_has_no_window_over_raw_rows(spark):
    from tests.conftest import SMALL
    from martline.plans.catalog import sales_detail_df
    plan = marts._sales_totals(sales_detail_df(spark, SMALL))._jdf.queryExecution() \
        .executedPlan().toString()
    # partial aggregation happens below the first exchange
    assert "partial_sum" in plan


def test_views_for_sql_users(spark):
    from martline.plans.catalog import register_views
    from tests.conftest import SMALL
    names = register_views(spark, SMALL)
    assert {"fact_sales", "sales_mart", "customer_mart"} <= set(names)
    top = spark.sql("SELECT count(*) AS n FROM sales_mart WHERE incentive > 0").first()["n"]
    stores = spark.sql("SELECT count(DISTINCT store_id, sales_month) AS n FROM sales_mart").first()["n"]
    assert 0 < stores <= top   # at least one top seller per store-month (ties share)
