"""The sales star over the TPC-H-style test tables.

Store = nation, salesperson = supplier, product = part, customer = customer,
sale = line item.  The same definitions, as SQL text, are in
:mod:`martline.plans.oracle` so that DuckDB can check every query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.contracts import MONEY, PRICE
from martline.functions import padded
from martline.sources.tables import per_session, read_table

# Characters 1-8 of a TPC-H name are the prefix ("Customer", "Supplier"),
# characters 10.. the number; they stand in for first and last names.
_LAST = 1 << 30


def _first(c: str):
    return F.substring(c, 1, 8)


def _last(c: str):
    return F.substring(c, 10, _LAST)


@per_session
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, typed like an ingested sales file."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # No hints: Spark broadcasts a side whose size it knows to be small (table statistics
    # when planning, shuffle sizes at runtime) and sort-merge joins the others.
    rows = (lineitem
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(supplier,
                  F.col("l_suppkey") == F.col("s_suppkey"))
            .join(part,
                  F.col("l_partkey") == F.col("p_partkey")))
    return rows.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").alias("store_id"),
        F.col("p_name").alias("product_name"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
    )


@per_session
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer
            .join(nation,
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"),
                    _first("c_name").alias("first_name"),
                    _last("c_name").alias("last_name"),
                    F.col("n_name").alias("address"),
                    F.col("c_nationkey").cast("string").alias("pincode"),
                    F.concat(F.lit("91"), padded("c_custkey", 8))
                    .alias("phone_number")))


@per_session
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores; every fourth nation is left out so the inner join loses rows."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.where(F.col("n_nationkey") % 4 != 3)
            .join(region,
                  F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("id"),
                    F.col("r_name").alias("address"),
                    F.concat(F.col("n_name"), F.lit(" manager")).alias("store_manager_name")))


@per_session
def dim_sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salespeople; the lowest id of each store is its manager.

    The manager per store is a grouped min (partial aggregation, one row per
    store) joined back, not a window over all suppliers of a store, so a
    store holding most salespeople does not end up in one task.
    """
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    staffed = supplier.join(nation,
                            F.col("s_nationkey") == F.col("n_nationkey"))
    managers = (staffed.groupBy(F.col("n_nationkey").alias("m_nationkey"))
                .agg(F.min("s_suppkey").alias("manager_id")))
    # Every staffed row's nation is one of `managers`' keys, so a left join
    # keeps exactly the inner-join rows; being a left join onto unique keys,
    # Catalyst drops it (and the aggregation) when no manager column is used.
    return (staffed
            .join(managers,
                  F.col("s_nationkey") == F.col("m_nationkey"), "left")
            .select(F.col("s_suppkey").alias("id"),
                    _first("s_name").alias("first_name"),
                    _last("s_name").alias("last_name"),
                    F.col("manager_id"),
                    F.when(F.col("s_suppkey") == F.col("manager_id"), F.lit("Y"))
                    .otherwise(F.lit("N")).alias("is_manager"),
                    F.col("n_name").alias("address"),
                    F.col("s_nationkey").cast("string").alias("pincode")))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"fact_sales": fact_sales(spark, sf_dir),
            "dim_customer": dim_customer(spark, sf_dir),
            "dim_store": dim_store(spark, sf_dir),
            "dim_sales_team": dim_sales_team(spark, sf_dir)}


@per_session
def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fact_sales` inner-joined to customer, store and sales team, with the
    join tree arranged for the base tables.

    Same rows as `enrich_sales(fact_sales, dims...)` (inner joins commute),
    but every dimension is attached at the level that owns its key: the
    customer to orders (a quarter of the line items), the store and the
    sales team to supplier (both keyed by the supplier or its nation).  Each
    big table then meets the line items once, so when no side is small
    enough to broadcast the line items are shuffled once per key (order, supplier,
    part) instead of once per join.
    """
    t = lambda name: read_table(spark, sf_dir, name)
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    part = t("part").select("p_partkey")
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = t("supplier").select("s_suppkey", "s_nationkey")

    customer = (dim_customer(spark, sf_dir).withColumnRenamed("customer_id", "c_id"))
    store = (dim_store(spark, sf_dir)
             .select(F.col("id").alias("st_id"), F.col("address").alias("store_address"),
                     "store_manager_name"))
    team = (dim_sales_team(spark, sf_dir)
            .select(F.col("id").alias("sp_id"), "manager_id", "is_manager",
                    F.col("first_name").alias("sales_person_first_name"),
                    F.col("last_name").alias("sales_person_last_name"),
                    F.col("address").alias("sales_person_address"),
                    F.col("pincode").alias("sales_person_pincode")))

    sellers = (supplier
               .join(store,
                     F.col("s_nationkey") == F.col("st_id"))
               .join(team,
                     F.col("s_suppkey") == F.col("sp_id")))
    buyers = orders.join(customer,
                         F.col("o_custkey") == F.col("c_id"))
    lines = (lineitem
             .join(part,
                   F.col("l_partkey") == F.col("p_partkey"))
             .join(sellers,
                   F.col("l_suppkey") == F.col("s_suppkey")))
    rows = lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("o_custkey").alias("customer_id"), F.col("s_nationkey").alias("store_id"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
        "first_name", "last_name", "address", "pincode", "phone_number",
        "store_address", "store_manager_name", "manager_id", "is_manager",
        "sales_person_first_name", "sales_person_last_name",
        "sales_person_address", "sales_person_pincode")
