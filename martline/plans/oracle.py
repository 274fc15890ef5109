"""ANSI SQL (DuckDB dialect) twins of the catalogue queries.

The star views are written once as CTE text; each oracle inlines the views
it needs, since the checker registers only the base tables.
"""

from __future__ import annotations

STAR_SQL = {
    "fact_sales": """
SELECT o_custkey AS customer_id, s_nationkey AS store_id, p_name AS product_name,
       CAST(o_orderdate AS DATE) AS sales_date, l_suppkey AS sales_person_id,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "dim_customer": """
SELECT c_custkey AS customer_id, substring(c_name, 1, 8) AS first_name,
       substring(c_name, 10) AS last_name, n_name AS address,
       CAST(c_nationkey AS VARCHAR) AS pincode,
       '91' || repeat('0', greatest(8 - length(CAST(c_custkey AS VARCHAR)), 0))
         || CAST(c_custkey AS VARCHAR) AS phone_number
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_store": """
SELECT n_nationkey AS id, r_name AS address, n_name || ' manager' AS store_manager_name
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 3""",
    "dim_sales_team": """
SELECT s_suppkey AS id, substring(s_name, 1, 8) AS first_name, substring(s_name, 10) AS last_name,
       min(s_suppkey) OVER (PARTITION BY s_nationkey) AS manager_id,
       CASE WHEN s_suppkey = min(s_suppkey) OVER (PARTITION BY s_nationkey) THEN 'Y' ELSE 'N' END
         AS is_manager,
       n_name AS address, CAST(s_nationkey AS VARCHAR) AS pincode
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}

# Enriched rows, with the same column names as the Spark side.
ENRICHED_SQL = """
SELECT f.customer_id, f.store_id, f.sales_date, f.sales_person_id, f.total_cost,
       c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
       st.address AS store_address, st.store_manager_name,
       s.manager_id, s.is_manager,
       s.first_name AS sales_person_first_name, s.last_name AS sales_person_last_name,
       s.address AS sales_person_address, s.pincode AS sales_person_pincode
FROM fact_sales f JOIN dim_customer c ON f.customer_id = c.customer_id
     JOIN dim_store st ON f.store_id = st.id JOIN dim_sales_team s ON f.sales_person_id = s.id"""

CUSTOMER_DETAIL_SQL = """
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost
FROM enriched"""

SALES_DETAIL_SQL = """
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
       store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
       sales_date, total_cost, strftime(sales_date, '%Y-%m') AS sales_month
FROM enriched"""

# The source job's own shapes: window sum over raw rows, then DISTINCT.
SALES_MART_SQL = """
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(round(CASE WHEN r = 1 THEN total_sales * 0.01 ELSE 0 END, 2) AS DECIMAL(18,2))
         AS incentive
FROM (SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC) AS r
      FROM (SELECT DISTINCT store_id, sales_person_id,
                   sales_person_first_name || ' ' || sales_person_last_name AS full_name,
                   sales_month,
                   CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
                        AS DECIMAL(18,2)) AS total_sales
            FROM sales_detail) w) k"""

CUSTOMER_MART_SQL = """
SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       CAST(date_trunc('month', sales_date) AS DATE) AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, date_trunc('month', sales_date))
            AS DECIMAL(18,2)) AS total_sales
FROM customer_detail"""

_DERIVED = {
    "enriched": (ENRICHED_SQL, ("fact_sales", "dim_customer", "dim_store", "dim_sales_team")),
    "customer_detail": (CUSTOMER_DETAIL_SQL, ("enriched",)),
    "sales_detail": (SALES_DETAIL_SQL, ("enriched",)),
    "sales_mart": (SALES_MART_SQL, ("sales_detail",)),
    "customer_mart": (CUSTOMER_MART_SQL, ("customer_detail",)),
}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        if n in _DERIVED:
            for dep in _DERIVED[n][1]:
                visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """`WITH <needed views> <body>`; `extra` adds query-specific CTEs last."""
    ctes = []
    for n in _closure(names):
        text = STAR_SQL[n] if n in STAR_SQL else _DERIVED[n][0]
        ctes.append(f"{n} AS ({text}\n)")
    for n, text in (extra or {}).items():
        ctes.append(f"{n} AS ({text}\n)")
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
