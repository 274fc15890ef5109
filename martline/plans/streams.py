"""Catalogue: incremental stream ingest (T1, K5), marts kept by a stream (A4, A5) and synthetic sales."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from martline.contracts import SALES_COLUMNS
from martline.operators import enrich, marts
from martline.plans.catalog import register
from martline.plans.ingest import _files_views, sales_rows, written_customer_mart, written_sales_mart
from martline.session import app_id, scratch_path
from martline.sources import sales_files as SF
from martline.sources import star as S
from martline.sources.synthetic import MAX_QUANTITY, MIX, synthetic_sales
from martline.streaming import file_ingest as T
from martline.streaming import mart_stream as M


@register("stream_ingest", _files_views(f"""
SELECT {', '.join(SALES_COLUMNS)}, is_malformed FROM landed"""))
def q_stream_ingest(spark, sf_dir):
    """Files of all header layouts arrive in two drops; two scheduled
    availableNow runs of the same checkpointed stream ingest each accepted file
    exactly once, by name.  Consumed files are moved to an archive directory."""
    base = scratch_path(spark, "stream")
    sales = sales_rows(spark, sf_dir)
    odd = F.col("sales_person_id") % 2 == 1
    stream = None
    for number, rows in enumerate((sales.where(~odd), sales.where(odd))):
        SF.write_drop(rows, f"{base}/inbox/drop={number}")
        stream = stream if stream is not None else T.sales_file_stream(
            spark, f"{base}/inbox/*/*/*/*.csv", archive_dir=f"{base}/archive")
        T.run_available(stream, f"{base}/landed", f"{base}/checkpoint")
    return T.read_landed(spark, f"{base}/landed").select(*SALES_COLUMNS, "is_malformed")


# The three drops of a mart's stream are taken in once per application and data set.
_streamed: dict[tuple, str] = {}


def _three_drops(spark: SparkSession, sf_dir: str, mart: marts.Mart) -> str:
    """The mart after three drops, each followed by a scheduled run: earlier months, later months, then
    sales of one salesperson in five, which come late for all months."""
    key = (app_id(spark), sf_dir, mart.name)
    if key not in _streamed:
        base, sales = scratch_path(spark, "mart_stream"), sales_rows(spark, sf_dir)
        dims = enrich.written_dims(S.star(spark, sf_dir))
        late = F.col("sales_person_id") % 5 == 0
        early = F.col("sales_date") < F.lit("1996-07-01").cast("date")
        for number, rows in enumerate((sales.where(~late & early), sales.where(~late & ~early), sales.where(late))):
            SF.write_drop(rows, f"{base}/inbox/drop={number}")
            T.run_available(T.sales_file_stream(spark, f"{base}/inbox/*/*/*/*.csv"), f"{base}/landed",
                            f"{base}/checkpoint")
            M.run_available(M.landed_stream(spark, f"{base}/landed"), dims, mart, f"{base}/marts",
                            f"{base}/checkpoint_mart")
        _streamed[key] = f"{base}/marts/{mart.name}"
    return _streamed[key]


@register("stream_sales_mart", _files_views("SELECT * FROM sales_mart", "dim_customer", "dim_store", "dim_sales_team"))
def q_stream_sales_mart(spark, sf_dir):
    """The sales mart as a stateful stream keeps it, after three drops, the last one late."""
    return written_sales_mart(spark, _three_drops(spark, sf_dir, marts.SALES))


@register("stream_customer_mart", _files_views("SELECT * FROM customer_mart",
                                               "dim_customer", "dim_store", "dim_sales_team"))
def q_stream_customer_mart(spark, sf_dir):
    """The customer mart as a stateful stream keeps it, after three drops, the last one late."""
    return written_customer_mart(spark, _three_drops(spark, sf_dir, marts.CUSTOMER))


@register("synthetic_sales", f"""
WITH q AS (
  SELECT o_custkey AS customer_id, s_nationkey AS store_id, p_name AS product_name,
         CAST(o_orderdate AS DATE) AS sales_date, l_suppkey AS sales_person_id,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST((((l_orderkey * {MIX[0]} + l_linenumber * {MIX[1]} + l_partkey * {MIX[2]} + 42)
                % {MAX_QUANTITY}) + {MAX_QUANTITY}) % {MAX_QUANTITY} + 1 AS INTEGER) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
SELECT *, CAST(price * quantity AS DECIMAL(18,2)) AS total_cost FROM q""")
def q_synthetic_sales(spark, sf_dir):
    """One synthetic sale per order line, with total = price * quantity."""
    return synthetic_sales(spark, sf_dir)
