"""Sales CSV files derived from the fact table, in the header layouts the
ingest must handle.

Layout (by sales date):
  * before 1997        - standard header (the mandatory names, in order); rows of
                         quantity 48 lack their product name, rows of quantity 47
                         are written twice
  * 1997 and 1998      - reordered header plus an extra `payment_mode`;
                         rows of quantity 50 carry their date in a wrong format
                         (yyyy/MM/dd), rows of quantity 49 a price `n/a`
  * 1999 onwards       - header without `store_id` (file must be rejected)

One logical source file per variant and month: `variant=<v>/batch=<yyyy-MM>/`
(Spark may split a batch over several part files; audit metrics are kept
per batch directory, the file a user would see).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.contracts import MANDATORY_COLUMNS
from martline.functions import month_text
from martline.session import together, written

# Fixed layout boundaries (sales dates).
EXTRA_FROM = "1997-01-01"
MISSING_FROM = "1999-01-01"
# Quantities that mark the rows with a flaw.
BAD_DATE, BAD_PRICE, NO_PRODUCT, TWICE = 50, 49, 48, 47

STANDARD = list(MANDATORY_COLUMNS)
EXTRA = ["sales_date", "customer_id", "payment_mode", "product_name", "store_id",
         "sales_person_id", "quantity", "price", "total_cost"]
MISSING = ["customer_id", "product_name", "sales_date", "sales_person_id", "price",
           "quantity", "total_cost", "payment_mode"]


def variant_of(date_col="sales_date"):
    d = F.col(date_col)
    return (F.when(d >= F.lit(MISSING_FROM).cast("date"), F.lit("missing"))
            .when(d >= F.lit(EXTRA_FROM).cast("date"), F.lit("extra"))
            .otherwise(F.lit("standard")))


def _rows(fact: DataFrame) -> DataFrame:
    """Typed rows of the files; the CSV writer formats them, so what is shuffled and sorted stays narrow."""
    return fact.select(
        *MANDATORY_COLUMNS,
        F.when(F.col("quantity") % 2 == 0, F.lit("UPI")).otherwise(F.lit("cash")).alias("payment_mode"),
        month_text("sales_date").alias("batch"))


def _with_flaws(rows: DataFrame, variant: str) -> DataFrame:
    """Rows of one variant with its flaws."""
    def flaw(quantity: int):
        return F.coalesce(F.col("quantity") == quantity, F.lit(False))

    if variant == "standard":
        copies = F.when(flaw(TWICE), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return (rows.withColumn("product_name", F.when(~flaw(NO_PRODUCT), F.col("product_name")))
                .select("*", F.explode(copies).alias("copy")).drop("copy"))
    if variant == "extra":
        plain_date, plain_price = F.col("sales_date").cast("string"), F.col("price").cast("string")
        return (rows
                .withColumn("price", F.when(flaw(BAD_PRICE), F.lit("n/a")).otherwise(plain_price))
                .withColumn("sales_date", F.when(flaw(BAD_DATE), F.date_format("sales_date", "yyyy/MM/dd"))
                            .otherwise(plain_date)))
    return rows


def _write(rows: DataFrame, columns: list[str], path: str) -> None:
    (rows.select(*columns, "batch").hint("rebalance", "batch")
     .write.option("header", "true").partitionBy("batch").csv(path))


def sales_rows(fact: DataFrame) -> DataFrame:
    """The rows behind sales files, written once, as they are and compressed: several writes and drops
    read them, and the star is joined once.  A cache of them would not fit the executors' memory."""
    return written(fact.select(*MANDATORY_COLUMNS), "sales_rows")


def write_drop(rows: DataFrame, root: str) -> str:
    """Write some `sales_rows` as CSV under `root`, in three header layouts."""
    def layout(variant: str, columns: list[str]):
        own = _rows(rows.where(variant_of() == F.lit(variant)))
        return lambda: _write(_with_flaws(own, variant), columns, f"{root}/variant={variant}")

    together(rows.sparkSession, layout("standard", STANDARD), layout("extra", EXTRA), layout("missing", MISSING))
    return root


def write_sales_files(fact: DataFrame, root: str) -> str:
    """Write all fact rows as CSV under `root`, in three header layouts."""
    return write_drop(sales_rows(fact), root)


def write_standard_files(fact: DataFrame, root: str) -> str:
    """All fact rows, standard header only (single-layout ingest, streams)."""
    _write(_rows(fact), STANDARD, root)
    return root
