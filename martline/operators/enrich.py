"""Star enrichment (inner joins to the three dimensions) and its loss report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.contracts import ENRICHED_COLUMNS
from martline.operators.joins import flag_matches
from martline.session import together, written


def _customer_side(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(
        F.col("customer_id").alias("c_id"), "first_name", "last_name", "address",
        "pincode", "phone_number")


def _store_side(dim_store: DataFrame) -> DataFrame:
    return dim_store.select(F.col("id").alias("st_id"),
                            F.col("address").alias("store_address"),
                            "store_manager_name")


def _team_side(dim_sales_team: DataFrame) -> DataFrame:
    return dim_sales_team.select(
        F.col("id").alias("sp_id"), "manager_id", "is_manager",
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"))


def enrich_sales(fact: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
                 dim_sales_team: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Inner-join sales to customer, store and sales team; `extra` names more columns of the sales to keep.

    Each dimension is narrowed and renamed *before* its join, so no duplicate
    column names survive and only needed columns travel.  The largest dimension (customer)
    comes first, while the sales are five columns wide: its join is the one that shuffles them.  Spark
    broadcasts a dimension that its statistics or AQE's measured sizes show to be small.
    """
    narrow = fact.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost", *extra)
    out = (narrow
           .join(_customer_side(dim_customer),
                 F.col("customer_id") == F.col("c_id"))
           .join(_store_side(dim_store),
                 F.col("store_id") == F.col("st_id"))
           .join(_team_side(dim_sales_team),
                 F.col("sales_person_id") == F.col("sp_id")))
    return out.select(*ENRICHED_COLUMNS, *extra)


def written_dims(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dimensions, each written once.

    Spark takes a join's result for as large as the product of its sides, so a dimension that is itself a
    join never looks small when a plan is made: the sales are then shuffled to it, by a
    store key of few values too, before AQE sees that it could be broadcast (and a stream has no AQE).
    A written table has its files' size.
    """
    names = ("dim_customer", "dim_store", "dim_sales_team")
    frames = together(dims["dim_store"].sparkSession, *[partial(written, dims[n], n) for n in names])
    return dict(zip(names, frames))


def unmatched_dimension_rows(fact: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
                             dim_sales_team: DataFrame) -> DataFrame:
    """Sales rows the inner enrichment drops, once each, with the missing dims.

    `missing_dimensions` lists, comma-separated in fixed order, the
    dimensions (customer, store, sales_team) that have no matching key.
    """
    flagged = flag_matches(fact, "customer_id", dim_customer, "customer_id", "has_customer")
    flagged = flag_matches(flagged, "store_id", dim_store, "id", "has_store")
    flagged = flag_matches(flagged, "sales_person_id", dim_sales_team, "id", "has_sales_team")
    missing = F.concat_ws(",",
                          F.when(~F.col("has_customer"), F.lit("customer")),
                          F.when(~F.col("has_store"), F.lit("store")),
                          F.when(~F.col("has_sales_team"), F.lit("sales_team")))
    return (flagged
            .where(~(F.col("has_customer") & F.col("has_store") & F.col("has_sales_team")))
            .select(*fact.columns, missing.alias("missing_dimensions")))
