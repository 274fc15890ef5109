"""Join helpers: key-existence flags and NULL-safe join-back.

No join carries a broadcast hint and none is sized by a job of its own: Spark
broadcasts what its statistics, or AQE's measured shuffle sizes, show to be
below `spark.sql.autoBroadcastJoinThreshold`, and sort-merge joins the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def flag_matches(facts: DataFrame, fact_key: str, keys: DataFrame, dim_key: str,
                 flag: str) -> DataFrame:
    """Left-join a boolean `flag` = "fact_key exists among keys.dim_key".

    Keys are de-duplicated first, so the fact side never multiplies.  The join is
    NULL-safe, though a NULL key matches nothing: its keys then differ from those that
    the de-duplication shuffled by, so both sides are dealt out for the join alone, and AQE
    can split the partition of a key that holds a third of all facts.
    """
    marked = keys.select(F.col(dim_key).alias(f"__{flag}_k")).distinct().withColumn(f"__{flag}_m", F.lit(True))
    joined = facts.join(marked, F.col(fact_key).eqNullSafe(F.col(f"__{flag}_k")), "left")
    found = F.coalesce(F.col(f"__{flag}_m"), F.lit(False)) & F.col(fact_key).isNotNull()
    return joined.withColumn(flag, found).drop(f"__{flag}_k", f"__{flag}_m")


def join_back(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on `keys` with NULL-safe equality (NULL keys match NULL),
    as a window partition would group them; the key columns appear once."""
    renamed = totals.select(*[F.col(k).alias(f"__jb_{k}") for k in keys],
                            *[c for c in totals.columns if c not in keys])
    cond = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"__jb_{k}"))
        cond = term if cond is None else cond & term
    return rows.join(renamed, cond, "inner").drop(*[f"__jb_{k}" for k in keys])
