"""The daily sales load, end to end.

1. list the CSV files and take those that no load has completed (new files and
   files of a load that failed); validate and land them (rejected files are
   reported in the manifest, flagged rows go to quarantine with their raw text);
2. register the accepted files as active;
3. enrich the usable rows (all columns that the marts need are there) and append
   both detail marts and their parts (sums per output tuple) under the load's id;
   earlier loads stay as they are;
4. make the months this load touched from the parts of all completed loads and
   this one, and replace just these months; no earlier sale is read;
5. mark the files completed and append file and job audit rows; a failed run
   appends a FAILED job record with its stage and error, then re-raises;
6. on request, move completed and rejected files out of the inbox (`sinks/archive.py`).

A load counts from the moment its files are marked completed: detail rows of a
failed load are never read again, and its files are taken by the next one.  A load may
replace an earlier one (`replaces`): the parts of that one are left out from then on.
Every step is a Spark job over whole tables; the driver sees a handful of counters.
"""

from __future__ import annotations

import datetime
import logging
import traceback
import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martline import __version__
from martline.contracts import (ENVIRONMENTS, MANDATORY_COLUMNS, REGISTRY_INACTIVE,
                                SALES_COLUMNS, TRIGGER_TYPES)
from martline.functions import elapsed_seconds, truncate_text
from martline.session import app_id, together, written
from martline.operators import audit, enrich, marts, quality, registry
from martline.sinks import archive as A
from martline.sinks import parquet as P
from martline.sinks.events import EventTable
from martline.sources import csv_ingest as C

SOURCE_SYSTEM = "csv"
MARTS = (marts.CUSTOMER, marts.SALES)
RETRACTION_SCHEMA = "load_id long, replaced_by long, event_time timestamp_ntz"
JOB_SCHEMA = ("job_id long, job_name string, pipeline_version string, environment string, "
              "trigger_type string, spark_application_id string, start_time timestamp_ntz, "
              "end_time timestamp_ntz, status string, failure_stage string, error_message string, "
              + ", ".join(f"{m} long" for m in audit.JOB_METRICS))
JOB_AUDIT_SCHEMA = JOB_SCHEMA + ", execution_time_seconds decimal(12,3), event_time timestamp_ntz"


@dataclass
class LoadResult:
    ingest: C.Ingest
    load_id: int
    customer_mart_path: str
    sales_mart_path: str
    registry_path: str
    job_audit_path: str
    file_audit_path: str


def _job_row(spark: SparkSession, job: dict) -> DataFrame:
    """One audit record of literal job attributes (what the run knows about
    itself), typed like the job audit table."""
    row = spark.createDataFrame([{f: job.get(f) for f in
                                  [c.split()[0] for c in JOB_SCHEMA.split(", ")]}], JOB_SCHEMA)
    return (row.withColumn("error_message", truncate_text("error_message"))
            .withColumn("execution_time_seconds", elapsed_seconds("start_time", "end_time"))
            .withColumn("event_time", F.coalesce("end_time", "start_time")))


def _now() -> datetime.datetime:
    return datetime.datetime.now()


def event_tables(spark: SparkSession, target_root: str) -> dict[str, EventTable]:
    """The state of a target: registry, retractions and both audits.  Audit rows are all kept (two per
    job or file); of the registry, those that decide a file's status or name a completed load."""
    return {"registry": EventTable(spark, f"{target_root}/registry", registry.EVENT_SCHEMA, registry.deciding_events),
            "retractions": EventTable(spark, f"{target_root}/retractions", RETRACTION_SCHEMA),
            "file_audit": EventTable(spark, f"{target_root}/file_audit", audit.FILE_AUDIT_SCHEMA),
            "job_audit": EventTable(spark, f"{target_root}/job_audit", JOB_AUDIT_SCHEMA),
            "moves": A.move_table(spark, target_root)}


def _compact(tables: dict[str, EventTable]) -> None:
    """Upkeep after a load: a table that cannot be compacted now is compacted after a later one."""
    for name, table in tables.items():
        try:
            table.compact()
        except Exception:  # the load is done; its tables are right with or without a snapshot
            logging.getLogger(__name__).exception("%s could not be compacted", name)


def run_daily_load(spark: SparkSession, source_root: str, target_root: str,
                   dims: dict[str, DataFrame], environment: str = "DEV",
                   trigger_type: str = "MANUAL", replaces: int | None = None,
                   archive_root: str | None = None) -> LoadResult:
    """Run the load.  With `replaces`, the id of an earlier load, the files on hand stand for
    those of that load, whose sales leave the marts (its files count as taken).  With `archive_root`,
    completed files leave the inbox for `archive_root`/processed, and files rejected by their
    header for `archive_root`/rejected; without it no file is moved.

    A RUNNING job audit record is appended at the start, a
    SUCCESS or FAILED one at the end (FAILED with the stage reached and the
    error text); any error is re-raised so the scheduler sees the failure."""
    if environment not in ENVIRONMENTS or trigger_type not in TRIGGER_TYPES:
        raise ValueError(f"environment must be in {ENVIRONMENTS}, trigger in {TRIGGER_TYPES}")
    job = {"job_id": uuid.uuid4().int >> 65, "job_name": "daily_sales_load",
           "pipeline_version": __version__, "environment": environment,
           "trigger_type": trigger_type, "spark_application_id": app_id(spark),
           "start_time": _now()}
    tables = event_tables(spark, target_root)
    record = lambda **x: tables["job_audit"].append(_job_row(spark, {**job, **x}))
    record(status="RUNNING")
    state = {"stage": "SPARK_INGESTION"}
    try:
        result, metrics = _load(spark, source_root, target_root, dims, job, state, replaces, tables)
        if archive_root is not None:
            state["stage"] = "FILE_ARCHIVAL"
            archive_files(tables, source_root, archive_root, result)
    except Exception:
        error = traceback.format_exc()
        try:
            record(end_time=_now(), status="FAILED", failure_stage=state["stage"], error_message=error)
        except Exception:  # the audit record must never mask the load's own error
            logging.getLogger(__name__).exception("the FAILED job audit record could not be written")
        raise
    record(end_time=_now(), status="SUCCESS", **metrics)
    _compact(tables)
    return result


def _load(spark, source_root, target_root, dims, job, state, replaces, tables) -> tuple[LoadResult, dict]:
    load_id = job["job_id"]
    paths = {n: f"{target_root}/{n}" for n in
             ("quarantine", "customer_detail", "sales_detail", "sales_partitioned",
              "customer_mart", "sales_mart", "customer_mart_parts", "sales_mart_parts")}
    events = tables["registry"].read()
    run = C.ingest_sales(spark, source_root, f"{target_root}/landing/load_id={load_id}",
                         choose=lambda files: registry.files_to_load(files, events))

    state["stage"] = "STAGING_REGISTRATION"
    files = run.manifest.where("accepted").select("path", "file_name")
    started = F.lit(job["start_time"]).cast("timestamp_ntz")
    tables["registry"].append(registry.register_files(files, started, load_id))
    file_rows = run.manifest.select(
        F.lit(load_id).alias("job_id"), registry.file_key().alias("file_id"), F.col("path").alias("file_path"),
        "file_name", "file_size", F.lit(SOURCE_SYSTEM).alias("source_system"), started.alias("start_time"))
    tables["file_audit"].append(audit.file_events(file_rows, "RUNNING", started))

    landed = run.landed
    written = {mart.name: 0 for mart in MARTS}
    if run.observation is not None or replaces is not None:   # else there are no rows to add or take away
        written = _write_marts(spark, landed, dims, load_id, paths, state, replaces, tables)

    state["stage"] = "STAGING_COMPLETION"
    ended = F.lit(_now()).cast("timestamp_ntz")
    if replaces is not None:
        # Before the files are completed: a crash in between leaves files that the next load takes.
        tables["retractions"].append(
            spark.createDataFrame([(replaces, load_id)], "load_id long, replaced_by long")
            .withColumn("event_time", ended))
    tables["registry"].append(registry.complete_files(files, ended, load_id))

    state["stage"] = "AUDIT"
    manifest = run.manifest.withColumn("file_path", F.col("path"))
    per_file = audit.file_metrics(manifest, landed.withColumn("file_path", F.col("source_file")), ["file_path"])
    done = file_rows.join(per_file.join(manifest.select("file_path", F.col("reason").alias("error_message")),
                                        "file_path"), "file_path")
    tables["file_audit"].append(audit.file_events(done, None, ended))
    found = run.manifest.agg(F.count_if("accepted").alias("ok"), F.count_if(~F.col("accepted")).alias("bad")).first()
    rows = run.observation.get if run.observation is not None else {"rows": 0, "malformed": 0}
    metrics = {"files_processed": found["ok"], "files_rejected": found["bad"],
               "rows_read": rows["rows"], "rows_rejected": rows["malformed"],
               "customer_mart_rows_written": written["customer_mart"],
               "sales_mart_rows_written": written["sales_mart"]}
    return LoadResult(run, load_id, paths["customer_mart"], paths["sales_mart"],
                      *[tables[n].root for n in ("registry", "job_audit", "file_audit")]), metrics


def archive_files(tables: dict[str, EventTable], source_root: str, archive_root: str,
                  load: LoadResult | None = None) -> DataFrame:
    """Move every completed file out of the inbox, and the files that `load` rejected by their header;
    returns one row per file that was tried.  May be called on its own after a run that stopped."""
    moves, at = tables["moves"], F.lit(_now()).cast("timestamp_ntz")
    sizes = tables["file_audit"].read().groupBy("file_path").agg(F.max("file_size").alias("file_size"))
    completed = (A.completed_files(tables["registry"].read())
                 .join(sizes.withColumnRenamed("file_path", "path"), "path", "left"))
    moves.append(A.intents(completed, moves.read(), source_root, f"{archive_root}/processed", at))
    if load is not None:
        # a file that could not be read may be whole tomorrow: it stays
        rejected = (load.ingest.manifest.where(~F.col("accepted") & F.col("probe_error").isNull())
                    .select("path", "file_size", F.lit(load.load_id).alias("load_id")))
        moves.append(A.intents(rejected, moves.read(), source_root, f"{archive_root}/rejected", at))
    return A.carry_out(moves, F.lit(_now()).cast("timestamp_ntz"))


def _write_marts(spark, landed: DataFrame, dims, load_id: int, paths: dict, state: dict,
                 replaces: int | None, tables: dict) -> dict:
    """Quarantine, detail marts and parts of this load, and the touched months of the aggregate marts."""
    state["stage"] = "QUARANTINE"
    reason = quality.reject_reason(MANDATORY_COLUMNS)
    (landed.withColumn("reason", reason).where("reason is not null")
     .select(F.lit(load_id).alias("load_id"), "source_file", "reason", "raw_record", *SALES_COLUMNS)
     .write.mode("append").parquet(paths["quarantine"]))

    state["stage"] = "DETAIL_MART_WRITE"
    # The detail marts and the parts project the same enriched rows: they are written once, compressed,
    # for all these writes (a cache of them would not fit the executors' memory).
    rich = written(enrich.enrich_sales(landed.where(quality.usable_sale()), **enrich.written_dims(dims)),
                   "enriched_sales")
    details = [("sales_partitioned", marts.sales_detail(rich), ["sales_month", "store_id"]),
               ("customer_detail", marts.customer_detail(rich), []), ("sales_detail", marts.sales_detail(rich), [])]
    parts = {mart.name: mart.parts(rich) for mart in MARTS}
    together(spark,
             *[partial(P.publish_versioned, detail, paths[name], load_id, folders) for name, detail, folders in details],
             *[partial(P.publish_parts, own, paths[f"{name}_parts"], load_id) for name, own in parts.items()])

    state["stage"] = "MART_CALCULATION"
    counted = counted_loads(tables, load_id, replaces)
    rows = together(spark, *[partial(_refresh, spark, mart, parts[mart.name].schema, paths, load_id, replaces, counted)
                             for mart in MARTS])
    return {mart.name: n for mart, n in zip(MARTS, rows)}


def counted_loads(tables: dict[str, EventTable], load_id: int | None = None,
                  replaces: int | None = None) -> DataFrame:
    """Loads whose rows are in the marts: completed ones and `load_id`, without replaced ones."""
    spark = tables["registry"].spark
    completed = tables["registry"].read().where(F.col("status") == REGISTRY_INACTIVE).select("load_id")
    gone = tables["retractions"].read().select("load_id")
    if replaces is not None:
        gone = gone.union(spark.createDataFrame([(replaces,)], "load_id long"))
    if load_id is not None:
        completed = completed.union(spark.createDataFrame([(load_id,)], "load_id long"))
    return completed.distinct().join(gone, "load_id", "left_anti")


def published(spark: SparkSession, target_root: str, name: str) -> DataFrame:
    """Rows of a detail table (`customer_detail`, `sales_detail`, `sales_partitioned`) of all loads that count."""
    counted = counted_loads(event_tables(spark, target_root))
    return spark.read.parquet(f"{target_root}/{name}").join(F.broadcast(counted), "load_id", "left_semi")


def _refresh(spark, mart: marts.Mart, schema, paths: dict, load_id: int, replaces: int | None,
             counted: DataFrame) -> int:
    """Make the months of this load, and of the one that it replaces, from the parts of all
    counted loads; no sale of an earlier load is read.  Returns the rows written.

    The driver holds the touched months, of which a calendar has few."""
    root = paths[f"{mart.name}_parts"]
    folders = spark.read.schema(P.parts_schema(schema)).parquet(root)   # of these, only names are read
    own = F.col("load_id").isin([i for i in (load_id, replaces) if i is not None])
    touched = P.months_of(folders.where(own))
    # The ids are few, but their plan does not show it: the parts would be shuffled by load, one task for each.
    parts = P.read_parts(spark, root, schema, touched).join(F.broadcast(counted), "load_id", "left_semi")
    seen = Observation(mart.name)
    P.refresh_months(mart.of_parts(parts).observe(seen, F.count(F.lit(1)).alias("rows")),
                     paths[mart.name], mart.month_column)
    if replaces is not None:
        gone = set(touched) - set(P.months_of(parts))
        P.drop_months(spark, paths[mart.name], mart.month_column, sorted(mart.label(m) for m in gone))
    return seen.get["rows"]
