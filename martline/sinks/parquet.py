"""Parquet sinks: plain overwrite (K1), Hive-partitioned with dynamic
partition overwrite (K2), versioned publish (K6), idempotent refresh of
the touched months of a mart, and the mergeable parts behind it (X10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      dynamic: bool = True) -> None:
    """`partitionBy` write that replaces only the partitions present in `df`.

    The REBALANCE hint lets AQE size the write tasks from the measured
    shuffle: small directories are packed into one task (few files), and a
    hot directory is split over several tasks instead of one.
    """
    (df.hint("rebalance", *partition_cols)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(*partition_cols)
     .parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema, columns: list[str]) -> DataFrame:
    """Read back with the writer's schema (no type guessing of partition
    values) and the original column order; filters on partition columns
    prune directories."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*columns)


def publish_versioned(df: DataFrame, root: str, load_id: int,
                      partition_cols: list[str]) -> str:
    """Write one load under `root/load_id=<id>/<partitions>`; earlier loads
    stay readable and a reader picks a load by partition filter.  A load
    without partitions of its own is one folder: its tasks write where they are, unshuffled."""
    folder = f"{root}/load_id={load_id}"
    if partition_cols:
        write_partitioned(df.withColumn("load_id", F.lit(load_id).cast("long")), root, ["load_id", *partition_cols])
    else:
        write_parquet(df, folder)
    return folder


def refresh_months(mart: DataFrame, path: str, month_col: str) -> None:
    """Idempotent mart load: (re)write exactly the month partitions present
    in `mart`; other months are untouched, and a rerun changes nothing."""
    write_partitioned(mart, path, [month_col], dynamic=True)


def publish_parts(parts: DataFrame, root: str, load_id: int) -> None:
    """The mergeable parts of one load, under `root`/month=<m>/load_id=<id>: a repeated
    write replaces them, and a reader of some months lists no other folder."""
    write_partitioned(parts.withColumn("load_id", F.lit(load_id).cast("long")), root, ["month", "load_id"])


def parts_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("load_id", T.LongType())])


def months_of(parts: DataFrame) -> list[str]:
    """Their months; as text, since a bad year may be none of Python's."""
    return sorted(r["m"] for r in parts.select(F.col("month").cast("string").alias("m")).distinct().collect())


def read_parts(spark: SparkSession, root: str, schema: T.StructType, months: list[str]) -> DataFrame:
    """The parts of all loads in `months`; only the folders of these months are listed."""
    if not months:
        return spark.createDataFrame([], parts_schema(schema))
    return (spark.read.schema(parts_schema(schema)).option("basePath", root)
            .parquet(*[f"{root}/month={m}" for m in months]))


def drop_months(spark: SparkSession, path: str, month_col: str, months: list[str]) -> None:
    """Remove the folders of months that have no rows left (a dynamic overwrite keeps them)."""
    for month in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{month_col}={month}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
