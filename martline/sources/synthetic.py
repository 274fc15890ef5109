"""Synthetic sales rows (S8), driven by the base tables.

The source job's generators draw random customers, stores, products,
salespeople, dates and quantities on one machine.  Here every order line
becomes one synthetic sale: customer, date, salesperson (and so store) and
product come from the tables, the quantity is a deterministic pseudo-random
1..10 mixed from the line's keys and a seed, and `total_cost = price *
quantity` holds exactly.  Draws are reproducible under task retries (no
random state), and the integer mix stays far from overflow for keys up to
10^13, so any SQL engine computes the same quantities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.contracts import MONEY, PRICE
from martline.sources.tables import read_table

MAX_QUANTITY = 10
# Multipliers of the quantity mix (primes).
MIX = (7919, 104729, 31)


def synthetic_sales(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    mixed = (F.col("l_orderkey") * MIX[0] + F.col("l_linenumber") * MIX[1]
             + F.col("l_partkey") * MIX[2] + F.lit(seed))
    qty = (F.pmod(mixed, F.lit(MAX_QUANTITY)) + 1).cast("int")
    price = F.col("p_retailprice").cast(PRICE)
    # Dimensions first (broadcast when they pass the size check), orders
    # last: the line items meet each big table once.
    return (lineitem
            .join(supplier,
                  F.col("l_suppkey") == F.col("s_suppkey"))
            .join(part,
                  F.col("l_partkey") == F.col("p_partkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("customer_id"),
                    F.col("s_nationkey").alias("store_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("o_orderdate").cast("date").alias("sales_date"),
                    F.col("l_suppkey").alias("sales_person_id"),
                    price.alias("price"),
                    qty.alias("quantity"),
                    (price * qty).cast(MONEY).alias("total_cost")))
