"""Running sums within keys that may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.session import written


def sum_before(rows: DataFrame, keys: list[str], order: list[Column], size: str, out: str) -> DataFrame:
    """`sum(size)` of the rows of the same keys that come before a row in `order` (0 for the first).

    A window would sort a key's rows in one task.  Here rows are range-partitioned by
    (keys, order), so a large key is a run of stretches, one per task; the stretches' sums, a
    row per key and task, tell where each begins.  NULL keys are a key; `order`
    must tell the rows of a key apart.
    """
    parted = written(rows.repartitionByRange(*keys, *order).withColumn("__stretch", F.spark_partition_id()), "stretches")
    earlier = Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parted.groupBy(*keys, "__stretch").agg(F.sum(size).alias("__sum"))
              .select(*[F.col(k).alias(f"__start_{k}") for k in keys], F.col("__stretch").alias("__start_stretch"),
                      F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start")))
    within = (Window.partitionBy(*keys, "__stretch").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = parted.withColumn("__local", F.coalesce(F.sum(size).over(within), F.lit(0)))
    same = F.col("__stretch") == F.col("__start_stretch")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__start_{k}"))
    return (local.join(starts, same).withColumn(out, F.col("__start") + F.col("__local"))
            .select(*rows.columns, out))
