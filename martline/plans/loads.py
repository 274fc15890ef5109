"""Catalogue: Parquet sinks and repeatable loads."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from martline.contracts import SALES_DETAIL_COLUMNS
from martline.operators import marts
from martline.plans import oracle as O
from martline.plans.catalog import _is_recent, register, sales_detail_df
from martline.session import scratch_path
from martline.sinks import parquet as P

_MART_COLUMNS = ["store_id", "sales_person_id", "full_name", "sales_month",
                 "total_sales", "incentive"]


@register("mart_parquet_roundtrip", O.with_views("SELECT * FROM sales_mart", "sales_mart"))
def q_mart_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sales_mart")
    mart = marts.sales_mart(sales_detail_df(spark, sf_dir))
    P.write_parquet(mart, path)
    return spark.read.schema(mart.schema).parquet(path)


@register("sales_partitioned_roundtrip", O.with_views("SELECT * FROM sales_detail", "sales_detail"))
def q_sales_partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sales_partitioned")
    detail = sales_detail_df(spark, sf_dir)
    P.write_partitioned(detail, path, ["sales_month", "store_id"])
    return P.read_partitioned(spark, path, detail.schema, SALES_DETAIL_COLUMNS)


@register("mart_versioned_publish", O.with_views("SELECT * FROM sales_mart", "sales_mart"))
def q_mart_versioned_publish(spark, sf_dir):
    """Two publishes (older data, then all data); readers of the newest
    load see the complete mart, the older load stays intact."""
    root = scratch_path(spark, "sales_mart_versions")
    detail = sales_detail_df(spark, sf_dir)
    first = int(time.time() * 1000)
    P.publish_versioned(marts.sales_mart(detail.where(~_is_recent())), root, first,
                        ["sales_month"])
    P.publish_versioned(marts.sales_mart(detail), root, first + 1, ["sales_month"])
    schema = marts.sales_mart(detail).schema.add("load_id", "long")
    latest = P.read_partitioned(spark, root, schema, [*_MART_COLUMNS, "load_id"])
    return latest.where(F.col("load_id") == first + 1).select(*_MART_COLUMNS)


@register("mart_incremental_refresh", O.with_views("SELECT * FROM sales_mart", "sales_mart"))
def q_mart_incremental_refresh(spark, sf_dir):
    """Load the mart from the older rows, then a recent batch arrives: only
    the months it touches are recomputed (from all their rows) and replaced;
    running the refresh twice changes nothing."""
    path = scratch_path(spark, "sales_mart_months")
    detail = sales_detail_df(spark, sf_dir)
    P.refresh_months(marts.sales_mart(detail.where(~_is_recent())), path, "sales_month")
    touched = detail.where(_is_recent()).select("sales_month").distinct()
    refreshed = marts.sales_mart(detail.join(touched, "sales_month", "left_semi"))
    P.refresh_months(refreshed, path, "sales_month")
    P.refresh_months(refreshed, path, "sales_month")
    return P.read_partitioned(spark, path, refreshed.schema, _MART_COLUMNS)
