"""Data-quality operators: cleansing (X9) and table checks.

Every check is one aggregation pass; nothing is collected per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.contracts import MART_COLUMNS_NEEDED
from martline.operators.joins import flag_matches


def reject_reason(required: list[str]):
    """NULL for a clean row, else why it goes to quarantine."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return (F.when(F.col("is_malformed"), F.lit("malformed"))
            .when(any_null, F.lit("missing_required")))


def usable_sale():
    """All columns that the marts need are there."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in MART_COLUMNS_NEEDED])


def cleanse(rows: DataFrame, columns: list[str], required: list[str]) -> DataFrame:
    """Distinct rows with their copy count and reject reason.

    Clean rows (reason NULL) are the de-duplicated output; a grouped count
    instead of a window keeps a hot duplicate group out of a single task.
    """
    return (rows.groupBy(*columns, reject_reason(required).alias("reject_reason"))
            .agg(F.count(F.lit(1)).alias("copies")))


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (X5): table, key, rows."""
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    key_text.alias("key_value"), "n_rows"))


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                 constraint: str) -> DataFrame:
    """One row: how many child rows have a key absent from the parent.
    A NULL key refers to nothing and is no violation."""
    orphans = child.where(F.col(child_key).isNotNull()).join(
        parent.select(F.col(parent_key).alias("__pk")), F.col(child_key) == F.col("__pk"), "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n_violations")).select(
        F.lit(constraint).alias("check_name"), "n_violations")


def orphan_counts(child: DataFrame, refs: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """`orphan_count` for several (child key, parent, parent key, name) in one pass over the child."""
    flagged = child
    for i, (key, parent, parent_key, _) in enumerate(refs):
        flagged = flag_matches(flagged, key, parent, parent_key, f"__has{i}")
    wide = flagged.agg(*[F.count_if(F.col(key).isNotNull() & ~F.col(f"__has{i}")).alias(name)
                         for i, (key, _, _, name) in enumerate(refs)])
    return wide.unpivot([], [f"`{name}`" for *_, name in refs], "check_name", "n_violations")


def cascade(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that survive the deletion of rows from their parent (X6): the
    key is still there, or NULL."""
    kept = flag_matches(child, child_key, parent, parent_key, "__kept")
    return kept.where(F.col("__kept") | F.col(child_key).isNull()).drop("__kept")


def domain_violations(df: DataFrame, column: str, allowed: list[str], check: str) -> DataFrame:
    """One row: values outside the allowed domain, NULL included."""
    bad = ~F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.agg(F.count_if(bad).alias("n_violations")).select(
        F.lit(check).alias("check_name"), "n_violations")


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per required column, all columns in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (wide.unpivot([], columns, "column_name", "n_nulls")
            .select(F.lit(table).alias("table_name"), "column_name", "n_nulls"))


def cast_to_contract(raw: DataFrame, schema) -> DataFrame:
    """Cast text columns to the contract types.

    A value that does not parse becomes NULL (never an ANSI error) and flags
    its row: `is_malformed` = some value was present but did not cast.
    Columns of `schema` missing from `raw` are not produced.
    """
    from martline.functions import typed_or_null

    fields = [f for f in schema.fields if f.name in raw.columns]
    typed = {f.name: typed_or_null(F.col(f.name), f.dataType) for f in fields}
    failed = [F.col(n).isNotNull() & c.isNull() for n, c in typed.items()]
    return raw.select(*[c.alias(n) for n, c in typed.items()],
                      reduce(lambda a, b: a | b, failed).alias("is_malformed"))
