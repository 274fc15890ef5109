"""A key holding a third of all rows: results stay exact when AQE splits
the hot partition of the join-back (forced here with tiny thresholds)."""

from datetime import date, timedelta
from decimal import Decimal as D

import pandas as pd

from martline.operators import marts

SCHEMA = ("customer_id long, first_name string, last_name string, address string, "
          "pincode string, phone_number string, sales_date date, total_cost decimal(18,2)")


def _rows(n):
    out = []
    for i in range(n):
        cust = 1 if i % 3 == 0 else 2 + i % 50          # customer 1: a third of all rows
        day = date(2023, 1, 1) + timedelta(days=i % 90)
        out.append((cust, "F", f"L{cust}", "A", "1", "91", day,
                    (D(i % 1000) / 100).quantize(D("0.01"))))
    return out


def test_hot_key_split_by_aqe_is_exact(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = _rows(6000)
        detail = spark.createDataFrame(rows, SCHEMA).repartition(8)
        df = marts.customer_month_window(detail)
        got = df.toPandas()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "isSkewJoin=true" in plan or "skew=true" in plan
    pdf = pd.DataFrame(rows, columns=["customer_id", "first_name", "last_name", "address",
                                      "pincode", "phone_number", "sales_date", "total_cost"])
    pdf["sales_date_month"] = pdf["sales_date"].map(lambda d: d.replace(day=1))
    pdf["total_sales"] = pdf.groupby(["customer_id", "sales_date_month"])["total_cost"] \
        .transform(lambda s: sum(s, D("0.00")))
    key = ["customer_id", "sales_date", "total_cost", "sales_date_month", "total_sales"]
    expect = sorted(map(tuple, pdf[key].astype(str).values.tolist()))
    actual = sorted(map(tuple, got[key].astype(str).values.tolist()))
    assert len(got) == len(rows) and actual == expect


def test_hot_salesperson_shuffles_partial_rows_only(spark):
    """One salesperson with a third of all sales: the mart's first shuffle
    carries one partial row per group and task, not the sales."""
    import re

    from martline.contracts import SALES_DETAIL_COLUMNS
    schema = ("store_id int, sales_person_id long, sales_person_first_name string, "
              "sales_person_last_name string, store_manager_name string, manager_id long, "
              "is_manager string, sales_person_address string, sales_person_pincode string, "
              "sales_date date, total_cost decimal(18,2), sales_month string")
    rows = []
    for i in range(30000):
        p = 10 if i % 3 == 0 else 11 + i % 40
        d = date(2023, 1, 1) + timedelta(days=i % 60)
        rows.append((1 + p % 3, p, "A", "X", "m", 1, "N", "a", "1", d, D(i % 100),
                     d.strftime("%Y-%m")))
    tasks = 8
    detail = spark.createDataFrame(rows, schema).repartition(tasks).select(*SALES_DETAIL_COLUMNS)
    df = marts._sales_totals(detail)          # what the mart writes once
    groups = len({(r[0], r[1], r[11]) for r in rows})
    df._jdf.queryExecution().executedPlan().executeCollect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    counts = sorted(float(c) for c in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\("
                                                  r"sizeInBytes=[^,]+, rowCount=([^)]+)\)", text))
    assert counts[-1] == len(rows)            # the test's own input repartition
    assert all(c <= groups * tasks for c in counts[:-1])
    assert df.count() == groups


def test_a_store_with_a_third_of_all_salespeople(spark):
    """Rank and top seller stay exact, ties and NULL totals included, and the
    ranking window of the large store spreads over its bands."""
    import random

    from martline.contracts import SALES_DETAIL_COLUMNS
    schema = ("store_id int, sales_person_id long, sales_person_first_name string, "
              "sales_person_last_name string, store_manager_name string, manager_id long, "
              "is_manager string, sales_person_address string, sales_person_pincode string, "
              "sales_date date, total_cost decimal(18,2), sales_month string")
    rnd = random.Random(1)
    rows, totals = [], {}
    for p in range(3000):
        store = 1 if p % 3 == 0 else 2 + p % 20
        cents = rnd.choice([None, -500, 0, 1, 12345, rnd.randrange(10**7)])
        money = None if cents is None else D(cents) / 100
        rows.append((store, p, "A", f"P{p}", "m", 1, "N", "a", "1", date(2023, 1, 5), money, "2023-01"))
        totals[p] = (store, money)
    detail = spark.createDataFrame(rows, schema).select(*SALES_DETAIL_COLUMNS)
    got = {r["sales_person_id"]: r for r in marts.store_month_rank(detail).collect()}
    mart = {r["sales_person_id"]: r for r in marts.sales_mart(detail).collect()}
    by_store = {}
    for store, money in totals.values():
        by_store.setdefault(store, []).append(money)
    low = D("-1e20")
    for p, (store, money) in totals.items():
        rank = 1 + sum((m if m is not None else low) > (money if money is not None else low)
                       for m in by_store[store])
        assert got[p]["rnk"] == rank, (p, money)
        want = (money * D("0.01")).quantize(D("0.01"), "ROUND_HALF_UP") if rank == 1 and money is not None else (
            None if rank == 1 else D("0.00"))
        assert mart[p]["incentive"] == want


_SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
          "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _with_tiny_skew(spark, run):
    old = {k: spark.conf.get(k, None) for k in _SPLIT}
    for k, v in _SPLIT.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_fact_key_of_a_key_check_is_split(spark):
    """flag_matches (J5, X6) and cascade: a key with a third of all facts, unmatched and NULL keys."""
    from martline.operators.joins import flag_matches
    from martline.operators.quality import cascade

    facts = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id % 500 END AS k", "id").repartition(8)
    keys = spark.createDataFrame([(1,), (1,), (None,), *[(i,) for i in range(2, 250)]], "k long")

    def run():
        flagged = flag_matches(facts, "k", keys, "k", "has")
        got = {r["has"]: r["n"] for r in flagged.groupBy("has").count().withColumnRenamed("count", "n").collect()}
        df = flagged.select("id", "has")
        df.collect()
        return got, df._jdf.queryExecution().executedPlan().toString(), cascade(facts, "k", keys, "k").count()

    got, plan, kept = _with_tiny_skew(spark, run)
    assert "skew=true" in plan
    rows = [None if i % 7 == 0 and i % 3 else 1 if i % 3 == 0 else i % 500 for i in range(30000)]
    want = sum(k is not None and 1 <= k < 250 for k in rows)
    assert got == {True: want, False: 30000 - want}
    assert kept == want + sum(k is None for k in rows)


def test_ranks_of_a_hot_store_with_mostly_equal_totals(spark):
    """A third of all rows in one store-month, most totals equal, some NULL: ranks as rank() gives them."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    n = 6000
    rows = spark.range(n).selectExpr(
        "CAST(CASE WHEN id % 3 = 0 THEN 121 ELSE 122 + id % 40 END AS INT) AS store_id", "id AS sales_person_id",
        "'F' AS sales_person_first_name", "'L' AS sales_person_last_name", "DATE '2023-01-05' AS sales_date",
        "CAST(CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 AND id % 5 > 0 THEN 7 ELSE id % 97 - 40 END AS DECIMAL(18,2)) AS total_cost")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["store_id"], r["sales_person_id"]): r["rnk"] for r in marts.store_month_rank(rows).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = rows.withColumn("rnk", F.rank().over(Window.partitionBy("store_id").orderBy(F.col("total_cost").desc_nulls_last())))
    assert got == {(r["store_id"], r["sales_person_id"]): r["rnk"] for r in want.collect()}


def test_sums_before_spread_over_tasks(spark):
    """One key holds all rows: the stretches lie in several tasks, and NULL keys are a key."""
    from pyspark.sql import functions as F
    from martline.operators.prefix import sum_before

    rows = spark.range(5000).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE 'a' END AS k", "id AS v", "id % 4 AS n")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sum_before(rows, ["k"], [F.col("v").desc()], "n", "before").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    sums = {None: 0, "a": 0}
    for r in sorted(got, key=lambda r: -r["v"]):
        assert r["before"] == sums[r["k"]]
        sums[r["k"]] += r["n"]
    assert len(got) == 5000
