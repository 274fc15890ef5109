"""Plan-shape checks: the properties the design relies on at scale."""

import re

from martline.plans.catalog import QUERIES
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_schema(plan: str, table: str) -> str:
    m = re.search(rf"{table}\.parquet\].*?ReadSchema: (struct<[^>]*>)", plan)
    assert m, f"no scan of {table}"
    return m.group(1)


def test_sales_mart_aggregates_before_any_window(spark):
    from martline.operators import marts
    from martline.plans.catalog import sales_detail_df
    plan = _plan(marts._sales_totals(sales_detail_df(spark, SMALL)))   # what the mart writes once
    # every Window sits above the grouped aggregation, never over raw rows
    assert "partial_sum(total_cost" in plan
    for window_at in [m.start() for m in re.finditer(r"Window \[", plan)]:
        assert "HashAggregate(keys=[store_id" in plan[window_at:]
    # the line items are read with only the columns the mart needs
    assert _scan_schema(plan, "lineitem") == \
        "struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>"


def test_row_windows_use_grouped_totals_not_window(spark):
    for q in ("customer_month_window", "sales_month_window"):
        plan = _plan(QUERIES[q](spark, SMALL))
        assert "Window [" not in plan, q
        assert "partial_sum" in plan, q


def test_small_dimensions_are_broadcast_by_spark_alone(spark):
    df = QUERIES["dimension_enrichment"](spark, SMALL)
    assert "hint" not in df._jdf.queryExecution().logical().toString().lower()
    df.collect()
    plan = _plan(df)
    assert plan[:plan.index("Initial Plan")].count("BroadcastHashJoin") >= 5
    # the store filter is inferred onto the supplier scan
    assert re.search(r"NOT \(\(s_nationkey#\d+ % 4\) = 3\)", plan)


def test_one_scan_reads_all_header_layouts(spark, scratch):
    from martline.plans.ingest import ingest_run
    from martline.sources import sales_scan
    from martline.sources.csv_ingest import bind_lines
    run = ingest_run(spark, SMALL, "mixed")
    run.manifest.write.parquet(scratch)
    plan = _plan(bind_lines(sales_scan.scan(spark, scratch), 9))
    # lines bring their header along: one scan, no join, no union
    assert plan.count("BatchScan sales_csv") == 1 and "Union" not in plan and "Join" not in plan
    assert run.observation.get["rows"] == run.landed.count()


def test_manager_lookup_pruned_when_unused(spark):
    # the manager join is a left join onto unique keys: Catalyst removes it
    # (with its aggregation) from plans that do not use manager columns
    assert "m_nationkey" not in _plan(QUERIES["sales_mart"](spark, SMALL))
    assert "m_nationkey" in _plan(QUERIES["sales_detail"](spark, SMALL))


def test_marts_use_hash_aggregation_only(spark):
    for name in ("customer_mart", "sales_mart", "store_month_rank"):
        plan = _plan(QUERIES[name](spark, SMALL))
        # totals that a plan reads twice are written before: the sales are joined and summed once
        assert ("partial_sum(total_cost" in plan) == (name == "customer_mart"), name
        assert ("lineitem" in plan) == (name == "customer_mart"), name
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan, name
        assert "SinglePartition" not in plan, name


def test_not_null_check_counts_sales_of_rejected_files(spark, tmp_path):
    """Sales from 1999 on land nowhere (their files are rejected), but their NULLs count."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from martline.plans.compare import compare
    from martline.sources.tables import BASE_TABLES
    for t in BASE_TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{SMALL}/{t}.parquet")
    orders, lines = (pq.read_table(f"{SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    late = {k for k, d in zip(orders["o_orderkey"].to_pylist(), orders["o_orderdate"].to_pylist()) if str(d) >= "1999"}
    gone = [k in late for k in lines["l_orderkey"].to_pylist()]
    at = lines.column_names.index("l_quantity")
    quantity = pa.array([None if g else q for g, q in zip(gone, lines["l_quantity"].to_pylist())], lines.schema.field(at).type)
    (tmp_path / "lineitem.parquet").unlink()
    pq.write_table(lines.set_column(at, lines.schema.field(at).name, quantity), tmp_path / "lineitem.parquet")
    got = {(r["table_name"], r["column_name"]): r["n_nulls"] for r in QUERIES["check_not_null"](spark, str(tmp_path)).collect()}
    assert got["landed", "quantity"] == 0 and got["fact_sales", "quantity"] == sum(gone) > 0
    assert compare(spark, "check_not_null", str(tmp_path))["values_match"]
