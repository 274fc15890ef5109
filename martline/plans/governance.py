"""Catalogue: file registry, audit state and table checks
(X1-X8, P10, J6, A3, F10, F12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline import __version__
from martline.contracts import (ENVIRONMENTS, JOB_STATUSES, MANDATORY_COLUMNS,
                                REGISTRY_ACTIVE, REGISTRY_INACTIVE, TRIGGER_TYPES)
from martline.functions import elapsed_seconds, truncate_text
from martline.operators import audit, quality, registry
from martline.plans import oracle as O
from martline.plans.catalog import register
from martline.plans.ingest import FILES_SQL, LANDED_SQL, ingest_run, with_batch
from martline.sources import star as S
from martline.sources.tables import read_table

ERROR_REPEAT = 3000   # failure text long enough to exercise the 65,000-char cap


# --------------------------------------------------------------------------
# Event streams derived from the landing zone of the mixed-header load
# --------------------------------------------------------------------------
def _at(batch_col: str, hour: int, plus_ms=None):
    """Load time of a monthly file: 1st of the following month, `hour`:00."""
    day = F.add_months(F.to_date(F.concat(F.col(batch_col), F.lit("-01"))), 1)
    ts = F.make_timestamp_ntz(F.year(day), F.month(day), F.lit(1), F.lit(hour), F.lit(0), F.lit(0))
    return ts if plus_ms is None else F.timestamp_add("MILLISECOND", plus_ms, ts)


def logical_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly source files; months of different years share a base name."""
    run = ingest_run(spark, sf_dir, "mixed")
    m = with_batch(run.manifest, "path")
    return (m.groupBy("variant", "batch")
            .agg(F.bool_and("accepted").alias("accepted"),
                 F.first("reason", ignorenulls=True).alias("reason"))
            .withColumn("file_name", F.concat(F.lit("sales_"), F.substring("batch", 6, 2), F.lit(".csv")))
            .withColumn("path", F.concat_ws("/", F.lit("/inbox"), "variant", F.substring("batch", 1, 4), "file_name")))


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard files: registered and completed; extra-column files:
    registered by a load that never completed; rejected files: never
    registered."""
    files = logical_files(spark, sf_dir)
    accepted = files.where("accepted")
    done = files.where(F.col("variant") == "standard")
    return (registry.register_files(accepted, _at("batch", 2))
            .unionByName(registry.complete_files(done, _at("batch", 3))))


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monthly load job per source file: a RUNNING event, then SUCCESS
    with the landed row count, or FAILED with stage and error text."""
    run = ingest_run(spark, sf_dir, "mixed")
    rows = (with_batch(run.landed, "source_file").groupBy("batch")
            .agg(F.count(F.lit(1)).alias("rows_read")))
    files = (logical_files(spark, sf_dir).join(rows, "batch", "left")
             .withColumn("rows_read", F.coalesce("rows_read", F.lit(0).cast("long")))
             .withColumn("job_id", F.regexp_replace("batch", "-", "").cast("int")))
    common = [F.col("job_id"), F.lit(__version__).alias("pipeline_version"),
              F.lit("DEV").alias("environment"),
              F.when(F.col("accepted"), F.lit("MANUAL")).otherwise(F.lit("RERUN")).alias("trigger_type")]
    started = files.select(*common, _at("batch", 1).alias("event_time"),
                           F.lit("RUNNING").alias("status"),
                           F.lit(None).cast("string").alias("failure_stage"),
                           F.lit(None).cast("string").alias("error_message"),
                           F.lit(0).cast("long").alias("rows_read"))
    ok = F.col("accepted")
    error = F.repeat(F.concat(F.lit("SCHEMA_VALIDATION: "), F.col("reason"), F.lit("; ")),
                     ERROR_REPEAT)
    finished = files.select(*common,
                            _at("batch", 1, F.col("rows_read") * 7 + 250).alias("event_time"),
                            F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
                            F.when(~ok, F.lit("SCHEMA_VALIDATION")).alias("failure_stage"),
                            F.when(~ok, error).alias("error_message"),
                            "rows_read")
    return started.unionByName(finished)


# Same events in SQL, for the oracles.
def _at_sql(hour: int, plus_ms: str | None = None) -> str:
    ts = (f"(CAST(CAST(strptime(batch || '-01', '%Y-%m-%d') AS DATE) + INTERVAL 1 MONTH "
          f"AS TIMESTAMP) + INTERVAL {hour} HOUR)")
    return ts if plus_ms is None else f"({ts} + ({plus_ms}) * INTERVAL 1 MILLISECOND)"


_GOV_CTES = {
    "sales_files": FILES_SQL,
    "landed": LANDED_SQL,
    "files": """SELECT variant, batch, variant <> 'missing' AS accepted,
       CASE WHEN variant = 'missing' THEN 'missing columns: store_id' END AS reason,
       'sales_' || substring(batch, 6, 2) || '.csv' AS file_name,
       '/inbox/' || variant || '/' || substring(batch, 1, 4) || '/sales_' || substring(batch, 6, 2) || '.csv' AS path
FROM (SELECT DISTINCT variant, batch FROM sales_files) d""",
    "registry_events": f"""
SELECT path, {_at_sql(2)} AS event_time, '{REGISTRY_ACTIVE}' AS status FROM files WHERE accepted
UNION ALL
SELECT path, {_at_sql(3)} AS event_time, '{REGISTRY_INACTIVE}' AS status FROM files
WHERE variant = 'standard'""",
    "job_files": """SELECT f.*, CAST(replace(f.batch, '-', '') AS INTEGER) AS job_id,
       coalesce(r.rows_read, 0) AS rows_read
FROM files f LEFT JOIN (SELECT batch, count(*) AS rows_read FROM landed GROUP BY batch) r
  ON f.batch = r.batch""",
    "job_events": f"""
SELECT job_id, '{__version__}' AS pipeline_version, 'DEV' AS environment,
       CASE WHEN accepted THEN 'MANUAL' ELSE 'RERUN' END AS trigger_type, {_at_sql(1)} AS event_time,
       'RUNNING' AS status, CAST(NULL AS VARCHAR) AS failure_stage,
       CAST(NULL AS VARCHAR) AS error_message, CAST(0 AS BIGINT) AS rows_read
FROM job_files
UNION ALL
SELECT job_id, '{__version__}', 'DEV', CASE WHEN accepted THEN 'MANUAL' ELSE 'RERUN' END, {_at_sql(1, 'rows_read * 7 + 250')},
       CASE WHEN accepted THEN 'SUCCESS' ELSE 'FAILED' END,
       CASE WHEN NOT accepted THEN 'SCHEMA_VALIDATION' END,
       CASE WHEN NOT accepted THEN repeat('SCHEMA_VALIDATION: ' || reason || '; ', {ERROR_REPEAT}) END,
       rows_read
FROM job_files""",
}


def _gov_views(body: str, *views: str) -> str:
    return O.with_views(body, "fact_sales", *views, extra=_GOV_CTES)


# --------------------------------------------------------------------------
# Registry and audit queries
# --------------------------------------------------------------------------
@register("registry_resume", _gov_views(f"""
SELECT e.path, arg_max(e.status, e.event_time) AS status,
       max(e.event_time) AS last_event_time
FROM registry_events e WHERE e.path IN (SELECT path FROM files)
GROUP BY e.path HAVING arg_max(e.status, e.event_time) = '{REGISTRY_ACTIVE}'"""))
def q_registry_resume(spark, sf_dir):
    """Files on hand that a load registered but never completed."""
    return registry.resume_files(logical_files(spark, sf_dir), registry_events(spark, sf_dir))


@register("registry_new_files", _gov_views("""
SELECT path, file_name FROM files WHERE path NOT IN (SELECT path FROM registry_events)"""))
def q_registry_new_files(spark, sf_dir):
    return registry.new_files(logical_files(spark, sf_dir), registry_events(spark, sf_dir)) \
        .select("path", "file_name")


@register("audit_latest_state", _gov_views("""
SELECT job_id, min(event_time) AS start_time,
       arg_max(pipeline_version, event_time) AS pipeline_version,
       arg_max(environment, event_time) AS environment,
       arg_max(trigger_type, event_time) AS trigger_type,
       arg_max(status, event_time) AS status,
       max(event_time) AS end_time,
       arg_max(failure_stage, event_time) AS failure_stage,
       substring(arg_max(error_message, event_time), 1, 65000) AS error_message,
       arg_max(rows_read, event_time) AS rows_read,
       CAST(CAST(date_diff('microsecond', min(event_time), max(event_time)) AS DECIMAL(20,0))
            / 1000000 AS DECIMAL(12,3)) AS execution_time_seconds
FROM job_events GROUP BY job_id"""))
def q_audit_latest_state(spark, sf_dir):
    """Current state of each job from its append-only events (X3), error
    text capped (F10), elapsed seconds with 3 decimals (F12)."""
    cols = ["pipeline_version", "environment", "trigger_type", "status", "event_time",
            "failure_stage", "error_message", "rows_read"]
    state = audit.latest_state(job_events(spark, sf_dir), "job_id", "event_time", cols)
    return (state.withColumnRenamed("event_time", "end_time")
            .withColumn("error_message", truncate_text("error_message"))
            .withColumn("execution_time_seconds", elapsed_seconds("start_time", "end_time")))


# --------------------------------------------------------------------------
# Table checks
# --------------------------------------------------------------------------
def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@register("check_unique", O.with_views("""
SELECT 'dim_customer' AS table_name, 'customer_id' AS key_columns,
       CAST(customer_id AS VARCHAR) AS key_value, count(*) AS n_rows
FROM dim_customer GROUP BY customer_id HAVING count(*) > 1
UNION ALL
SELECT 'dim_store', 'id', CAST(id AS VARCHAR), count(*) FROM dim_store GROUP BY id HAVING count(*) > 1
UNION ALL
SELECT 'dim_sales_team', 'id', CAST(id AS VARCHAR), count(*) FROM dim_sales_team GROUP BY id
HAVING count(*) > 1
UNION ALL
SELECT 'orders', 'o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey
HAVING count(*) > 1
UNION ALL
SELECT 'lineitem', 'l_orderkey,l_linenumber',
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), count(*)
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dim_customer", "dim_store", "dim_sales_team"))
def q_check_unique(spark, sf_dir):
    """Primary-key violations."""
    v = S.star(spark, sf_dir)
    return _union([
        quality.duplicate_keys(v["dim_customer"], "dim_customer", ["customer_id"]),
        quality.duplicate_keys(v["dim_store"], "dim_store", ["id"]),
        quality.duplicate_keys(v["dim_sales_team"], "dim_sales_team", ["id"]),
        quality.duplicate_keys(read_table(spark, sf_dir, "orders"), "orders", ["o_orderkey"]),
        quality.duplicate_keys(read_table(spark, sf_dir, "lineitem"), "lineitem",
                               ["l_orderkey", "l_linenumber"]),
    ])


@register("check_foreign_key", O.with_views("""
SELECT 'lineitem.l_orderkey->orders' AS check_name,
       (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
         AS n_violations
UNION ALL SELECT 'lineitem.l_suppkey->supplier',
       (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT 'lineitem.l_partkey->part',
       (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'orders.o_custkey->customer',
       (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'supplier.s_nationkey->nation',
       (SELECT count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation))
UNION ALL SELECT 'customer.c_nationkey->nation',
       (SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))
UNION ALL SELECT 'fact_sales.store_id->dim_store',
       (SELECT count(*) FROM fact_sales WHERE store_id NOT IN (SELECT id FROM dim_store))""",
    "fact_sales", "dim_store"))
def q_check_foreign_key(spark, sf_dir):
    """Orphan counts per reference (X6); the store reference is lossy by
    construction of the store dimension."""
    t = lambda n: read_table(spark, sf_dir, n)
    return _union([
        quality.orphan_counts(t("lineitem").select("l_orderkey", "l_suppkey", "l_partkey"), [
            ("l_orderkey", t("orders"), "o_orderkey", "lineitem.l_orderkey->orders"),
            ("l_suppkey", t("supplier"), "s_suppkey", "lineitem.l_suppkey->supplier"),
            ("l_partkey", t("part"), "p_partkey", "lineitem.l_partkey->part")]),
        quality.orphan_count(t("orders"), "o_custkey", t("customer"), "c_custkey",
                             "orders.o_custkey->customer"),
        quality.orphan_count(t("supplier"), "s_nationkey", t("nation"), "n_nationkey",
                             "supplier.s_nationkey->nation"),
        quality.orphan_count(t("customer"), "c_nationkey", t("nation"), "n_nationkey",
                             "customer.c_nationkey->nation"),
        quality.orphan_count(S.fact_sales(spark, sf_dir), "store_id", S.dim_store(spark, sf_dir),
                             "id", "fact_sales.store_id->dim_store"),
    ])


@register("file_job_cascade", _gov_views("""
SELECT path, job_id FROM job_files
WHERE job_id IS NULL OR job_id IN (SELECT job_id FROM job_events WHERE status = 'SUCCESS')"""))
def q_file_job_cascade(spark, sf_dir):
    """File records that survive when the records of failed jobs are deleted (X6, cascade)."""
    files = logical_files(spark, sf_dir).withColumn("job_id", F.regexp_replace("batch", "-", "").cast("int"))
    jobs = job_events(spark, sf_dir).where(F.col("status") == "SUCCESS")
    return quality.cascade(files, "job_id", jobs, "job_id").select("path", "job_id")


def _in_sql(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@register("check_domain", _gov_views(f"""
SELECT 'dim_sales_team.is_manager' AS check_name,
       count(*) FILTER (WHERE coalesce(is_manager IN ('Y', 'N'), false) = false) AS n_violations
FROM dim_sales_team
UNION ALL SELECT 'registry.status',
       count(*) FILTER (WHERE coalesce(status IN {_in_sql([REGISTRY_ACTIVE, REGISTRY_INACTIVE])},
                                       false) = false)
FROM registry_events
UNION ALL SELECT 'job_audit.status',
       count(*) FILTER (WHERE coalesce(status IN {_in_sql(JOB_STATUSES)}, false) = false)
FROM job_events
UNION ALL SELECT 'job_audit.environment',
       count(*) FILTER (WHERE coalesce(environment IN {_in_sql(ENVIRONMENTS)}, false) = false)
FROM job_events
UNION ALL SELECT 'job_audit.trigger_type',
       count(*) FILTER (WHERE coalesce(trigger_type IN {_in_sql(TRIGGER_TYPES)}, false) = false)
FROM job_events""", "dim_sales_team"))
def q_check_domain(spark, sf_dir):
    """Values outside the enumerated domains."""
    team = S.dim_sales_team(spark, sf_dir)
    reg = registry_events(spark, sf_dir)
    jobs = job_events(spark, sf_dir)
    return _union([
        quality.domain_violations(team, "is_manager", ["Y", "N"], "dim_sales_team.is_manager"),
        quality.domain_violations(reg, "status", [REGISTRY_ACTIVE, REGISTRY_INACTIVE],
                                  "registry.status"),
        quality.domain_violations(jobs, "status", JOB_STATUSES, "job_audit.status"),
        quality.domain_violations(jobs, "environment", ENVIRONMENTS, "job_audit.environment"),
        quality.domain_violations(jobs, "trigger_type", TRIGGER_TYPES, "job_audit.trigger_type"),
    ])


_NOT_NULL = {
    "fact_sales": MANDATORY_COLUMNS,
    "landed": MANDATORY_COLUMNS,
    "dim_customer": ["customer_id", "first_name", "last_name", "address", "phone_number"],
    "dim_store": ["id", "address", "store_manager_name"],
    "dim_sales_team": ["id", "first_name", "last_name", "manager_id", "is_manager"],
    "job_events": ["job_id", "pipeline_version", "environment", "trigger_type", "status", "event_time",
                   "failure_stage"],
}


@register("check_not_null", _gov_views("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls "
    f"FROM {t}" for t, cols in _NOT_NULL.items() for c in cols), "dim_customer", "dim_store", "dim_sales_team"))
def q_check_not_null(spark, sf_dir):
    """NULL counts of required columns (X7) of all sales, the landed ones, the
    dimensions and the job audit, one pass per table."""
    v = {**S.star(spark, sf_dir), "landed": ingest_run(spark, sf_dir, "mixed").landed,
         "job_events": job_events(spark, sf_dir)}
    return _union([quality.null_counts(v[t], t, cols) for t, cols in _NOT_NULL.items()])
