"""Data contracts of the sales star: fixed names, types and domains."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source system's for identical results.
# ---------------------------------------------------------------------------
# Columns a sales file must carry (a file lacking any of them is rejected).
MANDATORY_COLUMNS = ["customer_id", "store_id", "product_name", "sales_date",
                     "sales_person_id", "price", "quantity", "total_cost"]
# Date text format of `sales_date` in files, and the month label of the sales mart.
DATE_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"
# Incentive paid to the top salesperson of a store and month.
INCENTIVE_RATE = Decimal("0.01")
# Longest error text kept in an audit record.
ERROR_TEXT_LIMIT = 65000
# Domains of the audit and registry status columns.
JOB_STATUSES = ["RUNNING", "SUCCESS", "FAILED"]
ENVIRONMENTS = ["DEV", "TEST", "PROD"]
TRIGGER_TYPES = ["MANUAL", "AIRFLOW", "CRON", "API", "TEST"]
REGISTRY_ACTIVE = "A"
REGISTRY_INACTIVE = "I"
# Columns of the two detail marts.
CUSTOMER_DETAIL_COLUMNS = ["customer_id", "first_name", "last_name", "address",
                           "pincode", "phone_number", "sales_date", "total_cost"]

SALES_DETAIL_COLUMNS = ["store_id", "sales_person_id", "sales_person_first_name",
                        "sales_person_last_name", "store_manager_name", "manager_id",
                        "is_manager", "sales_person_address", "sales_person_pincode",
                        "sales_date", "total_cost", "sales_month"]
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(10, 2)
SECONDS = T.DecimalType(12, 3)
# A partial sum of money (what Spark makes of the sum of MONEY).
PART = T.DecimalType(28, 2)

# Typed sales row after ingest (money as decimals, never binary floats).
SALES_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales_date", T.DateType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("price", PRICE),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_cost", MONEY),
    T.StructField("additional_column", T.StringType()),
])

SALES_COLUMNS = [f.name for f in SALES_SCHEMA.fields]

# Enriched sales row: fact + customer + store + sales team, no duplicate names.
ENRICHED_COLUMNS = [
    "customer_id", "store_id", "sales_date", "sales_person_id", "total_cost",
    "first_name", "last_name", "address", "pincode", "phone_number",
    "store_address", "store_manager_name",
    "manager_id", "is_manager",
    "sales_person_first_name", "sales_person_last_name",
    "sales_person_address", "sales_person_pincode",
]

# A sale without one of these cannot be in the marts; any other column may be NULL.
MART_COLUMNS_NEEDED = ["customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"]
