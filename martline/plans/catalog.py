"""Query catalogue: every operator of the sales job as a (spark, sf_dir) ->
DataFrame callable, paired with its DuckDB oracle SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.contracts import MANDATORY_COLUMNS
from martline.operators import enrich, marts
from martline.plans import oracle as O
from martline.sources import star as S

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared building blocks
# --------------------------------------------------------------------------
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched sales of the star: the generic `enrich_sales` operator is
    what ingested files go through; over the base tables the same rows come
    from a join tree that meets each big table once (see star.enriched_sales)."""
    return S.enriched_sales(spark, sf_dir)


def sales_detail_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_detail(enriched(spark, sf_dir))


def customer_detail_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_detail(enriched(spark, sf_dir))


# Natural split of the sales history into an older and a recent load.
RECENT_FROM = "1998-01-01"


def _is_recent():
    return F.coalesce(F.col("sales_date") >= F.lit(RECENT_FROM).cast("date"), F.lit(False))


# --------------------------------------------------------------------------
# Marts and their pieces
# --------------------------------------------------------------------------
@register("sales_mart", O.with_views("SELECT * FROM sales_mart", "sales_mart"))
def q_sales_mart(spark, sf_dir):
    return marts.sales_mart(sales_detail_df(spark, sf_dir))


@register("customer_mart", O.with_views("SELECT * FROM customer_mart", "customer_mart"))
def q_customer_mart(spark, sf_dir):
    return marts.customer_mart(customer_detail_df(spark, sf_dir))


@register("dimension_enrichment", O.with_views("SELECT * FROM enriched", "enriched"))
def q_dimension_enrichment(spark, sf_dir):
    return enriched(spark, sf_dir)


@register("customer_detail", O.with_views("SELECT * FROM customer_detail", "customer_detail"))
def q_customer_detail(spark, sf_dir):
    return customer_detail_df(spark, sf_dir)


@register("sales_detail", O.with_views("SELECT * FROM sales_detail", "sales_detail"))
def q_sales_detail(spark, sf_dir):
    return sales_detail_df(spark, sf_dir)


@register("customer_month_window", O.with_views("""
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost,
       CAST(date_trunc('month', sales_date) AS DATE) AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, date_trunc('month', sales_date))
            AS DECIMAL(18,2)) AS total_sales
FROM customer_detail""", "customer_detail"))
def q_customer_month_window(spark, sf_dir):
    return marts.customer_month_window(customer_detail_df(spark, sf_dir))


@register("sales_month_window", O.with_views("""
SELECT *, CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
               AS DECIMAL(18,2)) AS total_sales_every_month
FROM sales_detail""", "sales_detail"))
def q_sales_month_window(spark, sf_dir):
    return marts.sales_month_window(sales_detail_df(spark, sf_dir))


@register("store_month_rank", O.with_views("""
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC) AS INTEGER)
         AS rnk
FROM (SELECT DISTINCT store_id, sales_person_id,
             sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_month,
             CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
                  AS DECIMAL(18,2)) AS total_sales
      FROM sales_detail) w""", "sales_detail"))
def q_store_month_rank(spark, sf_dir):
    return marts.store_month_rank(sales_detail_df(spark, sf_dir))


@register("distinct_store_people", O.with_views("""
SELECT DISTINCT store_id, sales_person_id,
       sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_month
FROM sales_detail""", "sales_detail"))
def q_distinct_store_people(spark, sf_dir):
    return marts.distinct_store_people(sales_detail_df(spark, sf_dir))


@register("unmatched_dimension_rows", O.with_views("""
SELECT f.*, concat_ws(',',
         CASE WHEN NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)
              THEN 'customer' END,
         CASE WHEN NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.id = f.store_id)
              THEN 'store' END,
         CASE WHEN NOT EXISTS (SELECT 1 FROM dim_sales_team t WHERE t.id = f.sales_person_id)
              THEN 'sales_team' END) AS missing_dimensions
FROM fact_sales f
WHERE NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)
   OR NOT EXISTS (SELECT 1 FROM dim_store s WHERE s.id = f.store_id)
   OR NOT EXISTS (SELECT 1 FROM dim_sales_team t WHERE t.id = f.sales_person_id)""",
    "fact_sales", "dim_customer", "dim_store", "dim_sales_team"))
def q_unmatched_dimension_rows(spark, sf_dir):
    v = S.star(spark, sf_dir)
    return enrich.unmatched_dimension_rows(v["fact_sales"], v["dim_customer"], v["dim_store"],
                                           v["dim_sales_team"])


@register("union_by_name", O.with_views(f"""
SELECT *, CASE WHEN sales_date >= DATE '{RECENT_FROM}' THEN 'payment_mode' END AS additional_column
FROM fact_sales""", "fact_sales"))
def q_union_by_name(spark, sf_dir):
    """Two loads with different column orders (the recent one carries an
    extra-column note) combined by name, not by position."""
    fact = S.fact_sales(spark, sf_dir)
    older = fact.where(~_is_recent()).select(*MANDATORY_COLUMNS)
    recent = (fact.where(_is_recent()).select(*reversed(MANDATORY_COLUMNS))
              .withColumn("additional_column", F.lit("payment_mode")))
    return older.unionByName(recent, allowMissingColumns=True)


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Publish the star, the enriched rows, the detail marts and the two
    aggregate marts as temporary views, for `spark.sql(...)` users."""
    v = S.star(spark, sf_dir)
    rich = enriched(spark, sf_dir)
    views = {**v, "enriched_sales": rich,
             "customer_detail": marts.customer_detail(rich),
             "sales_detail": marts.sales_detail(rich),
             "customer_mart": marts.customer_mart(marts.customer_detail(rich)),
             "sales_mart": marts.sales_mart(marts.sales_detail(rich))}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


# Further catalogue sections register themselves on import.
from martline.plans import loads  # noqa: E402,F401
from martline.plans import ingest  # noqa: E402,F401
from martline.plans import governance  # noqa: E402,F401
from martline.plans import streams  # noqa: E402,F401
