"""JDBC dimension scan (S5) and mart append (K3).

The source job reads each dimension through one JDBC connection (a single
partition) and appends marts row by row through one connection per task.
Here a numeric key splits the read into parallel range queries, and the
write sets batch size and writer parallelism.  Not exercised by the tests:
they may not start a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int = 8,
               fetch_size: int = 10_000) -> DataFrame:
    props = {**properties, "fetchsize": str(fetch_size)}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=props)


def append_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                 num_partitions: int = 8, batch_size: int = 10_000) -> None:
    """Append `df`; the writer itself caps concurrent connections at
    `num_partitions` (coalescing only the final write stage)."""
    (df.write
     .option("batchsize", str(batch_size))
     .option("numPartitions", str(num_partitions))
     .jdbc(url, table, mode="append", properties=properties))
