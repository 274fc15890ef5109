"""Load metrics (A6, A7) and append-only state folds.

State that the source job keeps by UPDATE-ing rows in place (file registry,
job and file audit) is kept here as append-only event rows; the current
state of a key is the event with the latest timestamp (`max_by`), an
ordinary partial aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions import elapsed_seconds

JOB_METRICS = ["files_processed", "files_rejected", "rows_read", "rows_rejected",
               "customer_mart_rows_written", "sales_mart_rows_written"]


def file_metrics(files: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Per source file: status, failure stage and row counts."""
    per_file = files.groupBy(*keys).agg(F.bool_and("accepted").alias("accepted"))
    rows = landed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__read"),
        F.count_if(F.col("is_malformed")).alias("__rejected"))
    out = per_file.join(rows, keys, "left")
    zero = F.lit(0).cast("long")
    ok = F.col("accepted")
    return out.select(
        *keys,
        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.when(~ok, F.lit("SCHEMA_VALIDATION")).alias("failure_stage"),
        F.when(ok, F.coalesce("__read", zero)).otherwise(zero).alias("rows_read"),
        F.when(ok, F.coalesce("__rejected", zero)).otherwise(zero).alias("rows_rejected"),
        F.when(ok, F.coalesce(F.col("__read") - F.col("__rejected"), zero))
        .otherwise(zero).alias("rows_written"))


FILE_AUDIT_SCHEMA = (
    "job_id long, file_id long, file_path string, file_name string, file_size long, source_system string, "
    "start_time timestamp_ntz, end_time timestamp_ntz, processing_time_seconds decimal(12,3), status string, "
    "failure_stage string, error_message string, rows_read long, rows_rejected long, rows_written long, "
    "event_time timestamp_ntz")


def file_events(files: DataFrame, status: str | None, at) -> DataFrame:
    """File audit events: RUNNING rows when a load begins with its files, then
    rows with the files' own `status` and counts and the time they took."""
    none = F.lit(None)
    done = status is None
    values = {"status": F.col("status") if done else F.lit(status),
              "end_time": at if done else none, "event_time": at,
              "processing_time_seconds": elapsed_seconds("start_time", at) if done else none}
    names = [c.split()[0] for c in FILE_AUDIT_SCHEMA.split(", ")]
    types = dict(c.split(maxsplit=1) for c in FILE_AUDIT_SCHEMA.split(", "))
    return files.select(*[values.get(n, F.col(n) if n in files.columns else none).cast(types[n]).alias(n)
                          for n in names])


def job_metrics(files: DataFrame, landed: DataFrame, customer_mart: DataFrame,
                sales_mart: DataFrame) -> DataFrame:
    """One row per job run (A7): every input contributes its counters in one
    pass; the rows are stacked and added up (no cross join)."""
    zero = F.lit(0).cast("long")

    def counted(df: DataFrame, **own) -> DataFrame:
        return df.agg(*[own.get(m, F.max(zero)).alias(m) for m in JOB_METRICS])

    n = F.count(F.lit(1))
    parts = [
        counted(files, files_processed=F.count_if(F.col("accepted")),
                files_rejected=F.count_if(~F.col("accepted"))),
        counted(landed, rows_read=n, rows_rejected=F.count_if(F.col("is_malformed"))),
        counted(customer_mart, customer_mart_rows_written=n),
        counted(sales_mart, sales_mart_rows_written=n),
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.agg(*[F.sum(F.coalesce(m, zero)).alias(m) for m in JOB_METRICS])


def latest_state(events: DataFrame, key: str, time_col: str, columns: list[str]) -> DataFrame:
    """Fold status events to one row per `key` (X3): every column from the
    latest event, plus the first event time as `start_time`."""
    # at equal times a final record follows the one that started the run
    began = F.col("status") != "RUNNING" if "status" in columns else F.lit(True)
    order = F.struct(F.col(time_col), began, *[F.col(c) for c in columns])
    latest = F.max_by(F.struct(*[F.col(c) for c in columns]), order)
    return (events.groupBy(key)
            .agg(F.min(time_col).alias("start_time"), latest.alias("__s"))
            .select(key, "start_time", *[F.col(f"__s.{c}").alias(c) for c in columns]))
