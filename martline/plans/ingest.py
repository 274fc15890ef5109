"""Catalogue: CSV ingest, header validation, cleansing and load metrics
(S1-S3, S6, U2, K4, P1, P2, P9, F6, F7, F11, P11, X9, A1, A6, A7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from martline.contracts import (MANDATORY_COLUMNS, MART_COLUMNS_NEEDED, SALES_COLUMNS,
                                SALES_SCHEMA)
from martline.operators import audit, enrich, marts, quality
from martline.plans import oracle as O
from martline.plans.catalog import register
from martline.session import app_id, scratch_path, written
from martline.sources import csv_ingest as C
from martline.sources import sales_files as SF
from martline.sources import star as S

# Ingest runs are shared by the queries of one application: the files and
# landing tables are written once per (application, data set, layout) into
# fresh, never-reused folders under the shared root.
_runs: dict[tuple, C.Ingest] = {}
_roots: dict[tuple, str] = {}
_rows: dict[tuple, DataFrame] = {}


def ingest_run(spark: SparkSession, sf_dir: str, layout: str) -> C.Ingest:
    key = (app_id(spark), sf_dir, layout)
    if key not in _runs:
        root = files_root(spark, sf_dir, layout)
        _runs[key] = C.ingest_sales(spark, root, scratch_path(spark, f"landing_{layout}"))
    return _runs[key]


def files_root(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """The files alone: who lands them himself needs no ingest run before."""
    key = (app_id(spark), sf_dir, layout)
    if key not in _roots:
        root = scratch_path(spark, f"sales_files_{layout}")
        if layout == "mixed":
            SF.write_drop(sales_rows(spark, sf_dir), root)
        else:
            SF.write_standard_files(S.fact_sales(spark, sf_dir), root)
        _roots[key] = root
    return _roots[key]


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales as they go into files and drops, written once per application and data set."""
    key = (app_id(spark), sf_dir)
    if key not in _rows:
        _rows[key] = SF.sales_rows(S.fact_sales(spark, sf_dir))
    return _rows[key]


def with_batch(df: DataFrame, path_col: str) -> DataFrame:
    """Logical source file = `variant=<v>/batch=<yyyy-MM>` directory."""
    return (df.withColumn("variant", F.regexp_extract(path_col, r"variant=([^/]+)/", 1))
            .withColumn("batch", F.regexp_extract(path_col, r"batch=([^/]+)/", 1)))


# --------------------------------------------------------------------------
# Oracle pieces: what the files hold, derived from fact_sales in SQL
# --------------------------------------------------------------------------
_VARIANT_SQL = (f"CASE WHEN sales_date >= DATE '{SF.MISSING_FROM}' THEN 'missing' "
                f"WHEN sales_date >= DATE '{SF.EXTRA_FROM}' THEN 'extra' ELSE 'standard' END")
_EXTRA_SQL = f"(sales_date >= DATE '{SF.EXTRA_FROM}' AND sales_date < DATE '{SF.MISSING_FROM}')"
_STANDARD_SQL = f"(sales_date < DATE '{SF.EXTRA_FROM}')"
FILES_SQL = f"""
SELECT customer_id, store_id,
       CASE WHEN NOT ({_STANDARD_SQL} AND quantity = {SF.NO_PRODUCT}) THEN product_name END AS product_name,
       CASE WHEN NOT ({_EXTRA_SQL} AND quantity = {SF.BAD_DATE}) THEN sales_date END AS sales_date,
       sales_person_id,
       CASE WHEN NOT ({_EXTRA_SQL} AND quantity = {SF.BAD_PRICE}) THEN price END AS price,
       quantity, total_cost,
       CASE WHEN sales_date >= DATE '{SF.EXTRA_FROM}' THEN 'payment_mode' END AS additional_column,
       {_EXTRA_SQL} AND quantity IN ({SF.BAD_DATE}, {SF.BAD_PRICE}) AS is_malformed,
       {_VARIANT_SQL} AS variant, strftime(sales_date, '%Y-%m') AS batch, sales_date AS written_date,
       price AS written_price
FROM fact_sales, unnest(CASE WHEN {_STANDARD_SQL} AND quantity = {SF.TWICE} THEN [1, 2] ELSE [1] END) AS c(copy)"""
LANDED_SQL = "SELECT * FROM sales_files WHERE variant <> 'missing'"


def _files_views(body: str, *extra_views: str) -> str:
    extra = {"sales_files": FILES_SQL, "landed": LANDED_SQL}
    if extra_views:
        # Marts over the landed rows (same SQL as the star marts).
        extra.update({
            # flagged rows count as long as the columns that the marts need are there
            "landed_usable": "SELECT * FROM landed WHERE " + " AND ".join(
                f"{c} IS NOT NULL" for c in MART_COLUMNS_NEEDED),
            "l_enriched": O.ENRICHED_SQL.replace("FROM fact_sales f", "FROM landed_usable f"),
            "l_customer_detail": O.CUSTOMER_DETAIL_SQL.replace("FROM enriched", "FROM l_enriched"),
            "l_sales_detail": O.SALES_DETAIL_SQL.replace("FROM enriched", "FROM l_enriched"),
            "customer_mart": O.CUSTOMER_MART_SQL.replace("FROM customer_detail",
                                                         "FROM l_customer_detail"),
            "sales_mart": O.SALES_MART_SQL.replace("FROM sales_detail", "FROM l_sales_detail"),
        })
    return O.with_views(body, "fact_sales", *extra_views, extra=extra)


_LAYOUTS = {"standard": SF.STANDARD, "extra": SF.EXTRA, "missing": SF.MISSING}


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------
@register("csv_typed_ingest", O.with_views(
    "SELECT *, CAST(NULL AS VARCHAR) AS additional_column FROM fact_sales", "fact_sales"))
def q_csv_typed_ingest(spark, sf_dir):
    """All sales written as standard CSV files, read back typed."""
    return ingest_run(spark, sf_dir, "standard").landed.select(*SALES_COLUMNS)


@register("csv_mixed_headers", _files_views(f"""
SELECT {', '.join(SALES_COLUMNS)}, is_malformed FROM landed"""))
def q_csv_mixed_headers(spark, sf_dir):
    """Files in three header layouts: reordered + extra accepted (values
    bound by name), missing `store_id` rejected, bad dates NULL + flagged."""
    return ingest_run(spark, sf_dir, "mixed").landed.select(*SALES_COLUMNS, "is_malformed")


@register("csv_string_cast", _files_views(f"""
SELECT {', '.join("CASE WHEN variant <> 'missing' THEN store_id END AS store_id" if c == 'store_id' else c
                  for c in MANDATORY_COLUMNS)}, is_malformed FROM sales_files"""))
def q_csv_string_cast(spark, sf_dir):
    """The source job's own reading style: every header layout read as text
    (header names bind the columns), then cast to the contract; bad values
    become NULL and flag the row instead of failing the job."""
    root = files_root(spark, sf_dir, "mixed")
    cast = [quality.cast_to_contract(spark.read.option("header", "true").csv(f"{root}/variant={v}"), SALES_SCHEMA)
            for v in _LAYOUTS]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)
    return rows.select(*MANDATORY_COLUMNS, "is_malformed")


def _header_literal(cols: list[str]) -> str:
    return "'" + ",".join(cols) + "'"


def _list_literal(cols) -> str:
    return "'" + ",".join(sorted(cols)) + "'"




def _by_variant(fn) -> str:
    return "CASE variant " + " ".join(
        f"WHEN '{v}' THEN {fn(cols)}" for v, cols in _LAYOUTS.items()) + " END"


_HEADER_SQL = f"""
SELECT DISTINCT variant, batch,
       {_by_variant(_header_literal)} AS header,
       {_by_variant(lambda c: _list_literal(set(MANDATORY_COLUMNS) - set(c)))} AS missing_columns,
       {_by_variant(lambda c: _list_literal(set(c) - set(MANDATORY_COLUMNS)))} AS extra_columns,
       variant <> 'missing' AS accepted,
       CASE WHEN variant = 'missing'
            THEN 'missing columns: ' || {_by_variant(lambda c: _list_literal(set(MANDATORY_COLUMNS) - set(c)))}
       END AS reason
FROM sales_files"""


@register("header_validation", _files_views(_HEADER_SQL))
def q_header_validation(spark, sf_dir):
    """Per source file: header, missing and extra names, accepted or
    quarantined with the reason."""
    m = with_batch(ingest_run(spark, sf_dir, "mixed").manifest, "path")
    return (m.select("variant", "batch", "header",
                     F.array_join("missing_columns", ",").alias("missing_columns"),
                     F.array_join("extra_columns", ",").alias("extra_columns"),
                     "accepted", "reason")
            .distinct())


@register("file_manifest", _files_views("""
SELECT DISTINCT variant, batch, true AS all_csv, true AS all_sized, true AS all_dated FROM sales_files"""))
def q_file_manifest(spark, sf_dir):
    """File discovery: per logical batch, whether all its files are named
    *.csv, hold bytes and have a time (how many part files there are is up to
    the writer)."""
    run = ingest_run(spark, sf_dir, "mixed")
    return (with_batch(run.manifest, "path").groupBy("variant", "batch")
            .agg(F.bool_and(F.col("file_name").endswith(".csv")).alias("all_csv"),
                 F.bool_and(F.col("file_size") > 0).alias("all_sized"),
                 F.bool_and(F.col("modified_at").isNotNull()).alias("all_dated")))


_RAW = {"customer_id": "customer_id", "store_id": "store_id", "product_name": "product_name",
        "sales_date": f"CASE WHEN quantity = {SF.BAD_DATE} THEN strftime(written_date, '%Y/%m/%d') "
                      "ELSE strftime(written_date, '%Y-%m-%d') END",
        "sales_person_id": "sales_person_id",
        "price": f"CASE WHEN quantity = {SF.BAD_PRICE} THEN 'n/a' ELSE CAST(written_price AS VARCHAR) END",
        "quantity": "quantity", "total_cost": "total_cost",
        "payment_mode": "CASE WHEN quantity % 2 = 0 THEN 'UPI' ELSE 'cash' END"}


@register("quarantine_rows", _files_views(f"""
SELECT variant, batch, CASE WHEN is_malformed THEN 'malformed' ELSE 'missing_required' END AS reason,
       CASE WHEN is_malformed THEN concat_ws(',', {', '.join(f'CAST({_RAW[c]} AS VARCHAR)' for c in SF.EXTRA)}) END
         AS raw_record, {', '.join(MANDATORY_COLUMNS)}
FROM landed WHERE is_malformed OR {' OR '.join(f'{c} IS NULL' for c in MANDATORY_COLUMNS)}"""))
def q_quarantine_rows(spark, sf_dir):
    """Flagged rows with the file they came from, the reason and, where a
    value could not be read, the raw line."""
    landed = ingest_run(spark, sf_dir, "mixed").landed
    rows = landed.withColumn("reason", quality.reject_reason(MANDATORY_COLUMNS)).where("reason is not null")
    return with_batch(rows, "source_file").select("variant", "batch", "reason", "raw_record", *MANDATORY_COLUMNS)


@register("cleanse_sales", _files_views(f"""
SELECT {', '.join(SALES_COLUMNS)},
       CASE WHEN is_malformed THEN 'malformed'
            WHEN {' OR '.join(f'{c} IS NULL' for c in MANDATORY_COLUMNS)} THEN 'missing_required'
       END AS reject_reason,
       count(*) AS copies
FROM landed GROUP BY ALL"""))
def q_cleanse_sales(spark, sf_dir):
    """Landed rows classified: clean (deduplicated, with copy count) or
    quarantined with a reason."""
    return quality.cleanse(ingest_run(spark, sf_dir, "mixed").landed, SALES_COLUMNS,
                           MANDATORY_COLUMNS)


@register("file_audit_metrics", _files_views("""
SELECT variant, batch,
       CASE WHEN variant = 'missing' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN variant = 'missing' THEN 'SCHEMA_VALIDATION' END AS failure_stage,
       CASE WHEN variant = 'missing' THEN 0 ELSE count(*) END AS rows_read,
       CASE WHEN variant = 'missing' THEN 0 ELSE count(*) FILTER (WHERE is_malformed) END
         AS rows_rejected,
       CASE WHEN variant = 'missing' THEN 0 ELSE count(*) FILTER (WHERE NOT is_malformed) END
         AS rows_written
FROM sales_files GROUP BY variant, batch"""))
def q_file_audit_metrics(spark, sf_dir):
    run = ingest_run(spark, sf_dir, "mixed")
    return audit.file_metrics(with_batch(run.manifest, "path"),
                              with_batch(run.landed, "source_file"), ["variant", "batch"])


def _landed_marts(spark, sf_dir, landed: DataFrame):
    usable = landed.dropna(subset=MART_COLUMNS_NEEDED)
    dims = enrich.written_dims(S.star(spark, sf_dir))
    # both marts sum up the same enriched rows, which are joined and written once
    rich = written(enrich.enrich_sales(usable, **dims), "enriched_sales")
    return (marts.customer_mart(marts.customer_detail(rich)),
            marts.sales_mart(marts.sales_detail(rich)))


@register("job_audit_metrics", _files_views("""
SELECT (SELECT count(DISTINCT batch) FILTER (WHERE variant <> 'missing') FROM sales_files)
         AS files_processed,
       (SELECT count(DISTINCT batch) FILTER (WHERE variant = 'missing') FROM sales_files)
         AS files_rejected,
       (SELECT count(*) FROM landed) AS rows_read,
       (SELECT count(*) FILTER (WHERE is_malformed) FROM landed) AS rows_rejected,
       (SELECT count(*) FROM customer_mart) AS customer_mart_rows_written,
       (SELECT count(*) FROM sales_mart) AS sales_mart_rows_written""",
    "dim_customer", "dim_store", "dim_sales_team"))
def q_job_audit_metrics(spark, sf_dir):
    run = ingest_run(spark, sf_dir, "mixed")
    customer_mart, sales_mart = _landed_marts(spark, sf_dir, run.landed)
    files = with_batch(run.manifest, "path").select("variant", "batch", "accepted").distinct()
    return audit.job_metrics(files, run.landed, customer_mart, sales_mart)


@register("daily_load", _files_views("SELECT * FROM sales_mart",
                                     "dim_customer", "dim_store", "dim_sales_team"))
def q_daily_load(spark, sf_dir):
    """The whole daily load over the mixed-layout files; returns the sales
    mart as written to its month-partitioned table."""
    from martline.plans.daily_load import run_daily_load
    target = scratch_path(spark, "daily_load")
    result = run_daily_load(spark, files_root(spark, sf_dir, "mixed"), target, S.star(spark, sf_dir))
    return written_sales_mart(spark, result.sales_mart_path)


_SALES_MART_SCHEMA = ("store_id int, sales_person_id long, full_name string, total_sales decimal(18,2), "
                      "incentive decimal(18,2), sales_month string")


_CUSTOMER_MART_SCHEMA = ("customer_id long, full_name string, address string, phone_number string, "
                         "total_sales decimal(18,2), sales_date_month date")


def written_sales_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SALES_MART_SCHEMA).parquet(path)


def written_customer_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CUSTOMER_MART_SCHEMA).parquet(path)


# The two-batch history is written once per application and data set.
_histories: dict[tuple, str] = {}


def _two_batches(spark: SparkSession, sf_dir: str) -> str:
    """Target of two loads over sales in the same months; the load of the
    second batch fails at first and is resumed."""
    from martline.plans.daily_load import run_daily_load
    key = (app_id(spark), sf_dir)
    if key not in _histories:
        root, target = scratch_path(spark, "daily_inbox"), scratch_path(spark, "daily_load")
        rows, dims = sales_rows(spark, sf_dir), S.star(spark, sf_dir)
        odd = F.col("sales_person_id") % 2 == 1
        SF.write_drop(rows.where(~odd), f"{root}/drop=1")
        run_daily_load(spark, root, target, dims)
        SF.write_drop(rows.where(odd), f"{root}/drop=2")
        broken = {**dims, "dim_store": dims["dim_store"].drop("store_manager_name")}
        try:
            run_daily_load(spark, root, target, broken)
        except AnalysisException:   # the dimension lacks a column: this load is to fail
            pass
        run_daily_load(spark, root, target, dims)
        _histories[key] = target
    return _histories[key]


@register("daily_load_two_batches", _files_views("SELECT * FROM sales_mart",
                                                 "dim_customer", "dim_store", "dim_sales_team"))
def q_daily_load_two_batches(spark, sf_dir):
    """The sales mart after two batches and a resumed failure equals one load
    of everything."""
    return written_sales_mart(spark, f"{_two_batches(spark, sf_dir)}/sales_mart")


@register("daily_load_replaced", _files_views("SELECT * FROM customer_mart",
                                              "dim_customer", "dim_store", "dim_sales_team"))
def q_daily_load_replaced(spark, sf_dir):
    """The customer mart after a load with wrong dates (some in months of their own) and one
    that replaces it equals one load of everything."""
    from martline.plans.daily_load import run_daily_load
    root, target = scratch_path(spark, "daily_inbox"), scratch_path(spark, "daily_load")
    rows, dims = sales_rows(spark, sf_dir), S.star(spark, sf_dir)
    odd = F.col("sales_person_id") % 2 == 1
    SF.write_drop(rows.where(~odd), f"{root}/drop=1")
    run_daily_load(spark, root, target, dims)
    SF.write_drop(rows.where(odd).withColumn("sales_date", F.date_sub("sales_date", 400)), f"{root}/drop=2")
    wrong = run_daily_load(spark, root, target, dims)
    SF.write_drop(rows.where(odd), f"{root}/drop=3")
    result = run_daily_load(spark, root, target, dims, replaces=wrong.load_id)
    return written_customer_mart(spark, result.customer_mart_path)


@register("file_archive", _files_views("""
SELECT variant, batch, CASE WHEN variant = 'missing' THEN 'rejected' ELSE 'processed' END AS place,
       count(*) AS rows_archived, CAST(0 AS BIGINT) AS files_left, CAST(0 AS BIGINT) AS moved_again
FROM sales_files GROUP BY variant, batch"""))
def q_file_archive(spark, sf_dir):
    """Two drops; the first is loaded without an archive, the load of the second archives both.  Per batch of
    files: where they lie now with how many sales, what the inbox still has, and what a third run moves."""
    from martline.plans.daily_load import archive_files, event_tables, run_daily_load
    root, target, old = (scratch_path(spark, n) for n in ("daily_inbox", "daily_load", "archive"))
    rows, dims = sales_rows(spark, sf_dir), S.star(spark, sf_dir)
    odd = F.col("sales_person_id") % 2 == 1
    SF.write_drop(rows.where(~odd), f"{root}/drop=1")
    run_daily_load(spark, root, target, dims)
    SF.write_drop(rows.where(odd), f"{root}/drop=2")
    run_daily_load(spark, root, target, dims, archive_root=old)
    moved = archive_files(event_tables(spark, target), root, old)
    # lines are counted per file first: what its path says is read once a file, not once a line
    lines = (spark.read.option("recursiveFileLookup", "true").text(old)
             .where(~F.col("value").isin([",".join(c) for c in _LAYOUTS.values()]))
             .groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("lines")))
    archived = (with_batch(lines, "path").withColumn("place", F.regexp_extract("path", "/(processed|rejected)/load_id=", 1))
                .groupBy("variant", "batch", "place").agg(F.sum("lines").alias("rows_archived")))
    count = lambda files, name: (with_batch(files, "path").groupBy("variant", "batch")
                                 .agg(F.count(F.lit(1)).alias(name)))
    return (archived.join(count(C.list_csv_files(spark, root), "files_left"), ["variant", "batch"], "left")
            .join(count(moved, "moved_again"), ["variant", "batch"], "left")
            .fillna(0, ["files_left", "moved_again"]))


@register("load_audit_state", _files_views("""
SELECT status, failure_stage, batch_rows.rows_read, batch_rows.rows_rejected
FROM (VALUES ('SUCCESS', NULL, 0), ('FAILED', 'DETAIL_MART_WRITE', NULL), ('SUCCESS', NULL, 1))
       AS jobs(status, failure_stage, part)
LEFT JOIN (SELECT sales_person_id % 2 AS part, count(*) AS rows_read,
                  count(*) FILTER (WHERE is_malformed) AS rows_rejected
           FROM landed GROUP BY 1) batch_rows ON jobs.part = batch_rows.part"""))
def q_load_audit_state(spark, sf_dir):
    """The job audit that the loads wrote (RUNNING rows, then final ones), folded to one row per job."""
    events = spark.read.parquet(f"{_two_batches(spark, sf_dir)}/job_audit")
    columns = ["status", "failure_stage", "rows_read", "rows_rejected"]
    return audit.latest_state(events, "job_id", "event_time", columns).select(*columns)
