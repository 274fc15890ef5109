"""Parquet base tables (S7).  Reading by name keeps pruning and pushdown free."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martline.session import app_id

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# Resolved readers are reused within a session: a DataFrame is an immutable
# plan, and re-reading the same read-only table would only repeat the file
# listing and footer reads on the driver.
_readers: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), app_id(spark), path)
    if key not in _readers:
        _readers[key] = spark.read.parquet(path)
    return _readers[key]


def per_session(fn):
    """Memoise a (spark, sf_dir, ...) -> DataFrame builder per session.

    DataFrames are immutable lazy plans, so queries of one session can share
    the star's frames instead of re-analysing the same joins each time.  Only
    for builders over the read-only base tables.
    """
    memo: dict[tuple, DataFrame] = {}

    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (id(spark), app_id(spark), sf_dir.rstrip("/"), args)
        if key not in memo:
            memo[key] = fn(spark, sf_dir, *args)
        return memo[key]

    wrapper.__doc__ = fn.__doc__
    wrapper.__name__ = fn.__name__
    return wrapper
