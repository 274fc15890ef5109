"""Detail projections and monthly aggregate marts.

The source job computes each mart as "window sum over raw rows, then
DISTINCT".  Here the sales are first summed per output tuple (map-side
partial aggregation: the shuffle carries one row per tuple and task, not
every sale); what follows only ever sees mart-sized data.  Results are
identical, including when one window key maps to several distinct output
tuples.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.contracts import (CUSTOMER_DETAIL_COLUMNS, MONEY, PART,
                                SALES_DETAIL_COLUMNS)
from martline.functions import full_name, incentive, month_start, month_text
from martline.operators.joins import join_back
from martline.operators.prefix import sum_before
from martline.session import written


# --------------------------------------------------------------------------
# Detail marts
# --------------------------------------------------------------------------
def customer_detail(enriched: DataFrame) -> DataFrame:
    return enriched.select(*CUSTOMER_DETAIL_COLUMNS)


def sales_detail(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("sales_month", month_text("sales_date")).select(*SALES_DETAIL_COLUMNS)


# --------------------------------------------------------------------------
# Grouped totals with "window key" semantics
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Mart:
    """A monthly mart made of mergeable parts.

    A part is the sum of some sales of one output tuple (`keys` and `variants`).  Parts of
    disjoint sets of sales (loads, micro-batches) add up to the part of all of them, so a
    mart can be kept up to date from parts alone, without the sales that it has seen.
    """
    name: str
    month_column: str                               # of the finished mart
    keys: tuple[str, ...]                           # what a total is of
    variants: tuple[str, ...]                       # attributes that may vary within a key
    label: Callable[[str], str]                     # its value for a month's first day
    prepare: Callable[..., DataFrame]               # enriched or detail rows -> keys, variants, total_cost
    finish: Callable[[DataFrame], DataFrame]        # keys, variants, total_sales -> mart

    def parts(self, rows: DataFrame) -> DataFrame:
        """One row per output tuple: a hash aggregation that is partial per task."""
        return self.prepare(rows).groupBy(*self.keys, *self.variants).agg(F.sum("total_cost").alias("part"))

    def merged(self, parts: DataFrame) -> DataFrame:
        """Parts of several sets of sales as those of their union."""
        return parts.groupBy(*self.keys, *self.variants).agg(F.sum("part").cast(PART).alias("part"))

    def totals(self, parts: DataFrame) -> DataFrame:
        """One row per tuple with the total of its keys (the semantics of "sum() OVER (keys)"
        followed by DISTINCT): a window adds up the few attribute variants (e.g. two
        addresses) of each key.  Its partitions hold variants, never sales."""
        total = F.sum("part").over(Window.partitionBy(*self.keys)).cast(MONEY)
        return parts.withColumn("total_sales", total).drop("part")

    def of(self, rows: DataFrame) -> DataFrame:
        return self.finish(self.totals(self.parts(rows)))

    def of_parts(self, parts: DataFrame) -> DataFrame:
        """The finished mart.  Parts are sums already, so there is little to add up before a shuffle: they
        are dealt out by the keys once, which serves their sums and the window of `totals`."""
        return self.finish(self.totals(self.merged(parts.repartition(*self.keys))))


def _customer_rows(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return rows.select("customer_id", month_start("sales_date").alias("month"), "address", "phone_number",
                       "total_cost", full_name("first_name", "last_name").alias("full_name"), *extra)


def _customer_finish(totals: DataFrame) -> DataFrame:
    return totals.select("customer_id", "full_name", "address", "phone_number",
                         F.col("month").alias("sales_date_month"), "total_sales")


def _sales_rows(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    # Group on the month's first day (a date) and format the label after the
    # aggregation: the shuffle then hashes a 4-byte date, not a string.
    return rows.select("store_id", "sales_person_id", month_start("sales_date").alias("month"), "total_cost",
                       full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"), *extra)


def _sales_finish(totals: DataFrame) -> DataFrame:
    """Rank 1 in (store, month) by total DESC, NULLs last, is exactly
    "total <=> max(total) over (store, month)" (an all-NULL group ties at
    rank 1), so no sort is needed: the maximum is a grouped aggregation,
    partial per task, joined back.  A store with a third of all salespeople
    is no single task.  The totals, which have the mart's size, are written once
    and read on both sides, so the sales are joined and summed once.
    """
    totals = written(totals, "sales_totals")
    best = totals.groupBy("store_id", "month").agg(F.max("total_sales").alias("__best"))
    return (join_back(totals, best, ["store_id", "month"])
            .select("store_id", "sales_person_id", "full_name",
                    month_text("month").alias("sales_month"),
                    "total_sales",
                    incentive("total_sales", F.col("total_sales").eqNullSafe(F.col("__best")))
                    .alias("incentive")))


CUSTOMER = Mart("customer_mart", "sales_date_month", ("customer_id", "month"),
                ("full_name", "address", "phone_number"), str, _customer_rows, _customer_finish)
SALES = Mart("sales_mart", "sales_month", ("store_id", "sales_person_id", "month"), ("full_name",),
             lambda day: day[:-3], _sales_rows, _sales_finish)


def _sales_totals(detail: DataFrame) -> DataFrame:
    return SALES.totals(SALES.parts(detail))


def customer_mart(detail: DataFrame) -> DataFrame:
    """Total purchases per customer and month (A4)."""
    return CUSTOMER.of(detail)


def sales_mart(detail: DataFrame) -> DataFrame:
    """Sales per store, salesperson and month, with the top-seller incentive
    (A5 + W3 + F4 + F5)."""
    return SALES.of(detail)


def store_month_rank(detail: DataFrame) -> DataFrame:
    """rank() of each salesperson's monthly total within (store, month).

    The rank of a total is one more than the rows with higher totals.  Equal totals are
    counted first, so ties meet before the shuffle, however many they are; the counts are then
    summed up in the order of the totals by range (`sum_before`), and joined back.  So
    neither a store with a third of all salespeople nor a total that most of them share is
    a single task.  NULL totals rank last and tie with each other.
    """
    keys = ["store_id", "month"]
    totals = written(_sales_totals(detail), "sales_totals")
    counts = totals.groupBy(*keys, "total_sales").agg(F.count(F.lit(1)).alias("__n"))
    ranked = (sum_before(counts, keys, [F.col("total_sales").desc_nulls_last()], "__n", "__above")
              .select(*keys, "total_sales", (F.col("__above") + 1).cast("int").alias("rnk")))
    return (join_back(totals, ranked, [*keys, "total_sales"])
            .select("store_id", "sales_person_id", "full_name",
                    month_text("month").alias("sales_month"), "total_sales", "rnk"))


def distinct_store_people(detail: DataFrame) -> DataFrame:
    """Distinct (store, salesperson, name, month) tuples (A2)."""
    return (detail.select("store_id", "sales_person_id",
                          full_name("sales_person_first_name", "sales_person_last_name")
                          .alias("full_name"), "sales_month")
            .distinct())


# --------------------------------------------------------------------------
# Row-level windowed sums (W1, W2): every detail row with its group total
# --------------------------------------------------------------------------
def _with_group_total(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """`sum(value) OVER (PARTITION BY keys)` on every row.

    Expressed as grouped totals joined back on the keys: the aggregation is
    partial per task, and the join back is either a broadcast (small totals)
    or a sort-merge join whose skewed partitions AQE splits, so a key that
    holds a third of all rows never lands in a single task.
    """
    totals = rows.groupBy(*keys).agg(F.sum(value).cast(MONEY).alias(out))
    return join_back(rows, totals, keys)


def customer_month_window(detail: DataFrame) -> DataFrame:
    rows = detail.withColumn("sales_date_month", month_start("sales_date"))
    out = _with_group_total(rows, ["customer_id", "sales_date_month"], "total_cost", "total_sales")
    return out.select(*CUSTOMER_DETAIL_COLUMNS, "sales_date_month", "total_sales")


def sales_month_window(detail: DataFrame) -> DataFrame:
    out = _with_group_total(detail, ["store_id", "sales_person_id", "sales_month"],
                            "total_cost", "total_sales_every_month")
    return out.select(*SALES_DETAIL_COLUMNS, "total_sales_every_month")
