"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "headline_total_sec", "value": N, "unit": "sec",
   "queries": {...}, "reference_shape": {...}, "sf": ...}

Each query runs to completion through the `noop` sink (full execution, no
collect), once more to warm up, then `BENCH_RUNS` (default 5) times; the median is kept.
`reference_shape` times the oracle SQL of the two marts (window sum over raw
rows + DISTINCT) as Spark runs it on the same data, for comparison.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from martline.plans import oracle as O  # noqa: E402
from martline.plans.catalog import QUERIES, register_views  # noqa: E402
from martline.session import build_session, scratch_path  # noqa: E402
from martline.sources import csv_ingest as C  # noqa: E402
from martline.sources import sales_files as SF  # noqa: E402
from martline.sources import star as S  # noqa: E402

HEADLINE = ["sales_mart", "customer_mart", "dimension_enrichment", "customer_month_window",
            "sales_month_window", "store_month_rank", "distinct_store_people",
            "unmatched_dimension_rows", "union_by_name", "check_unique", "check_foreign_key",
            "check_not_null", "synthetic_sales"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make, runs: int) -> float:
    make_and_run = lambda: run(make())
    make_and_run()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        make_and_run()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session("martline-bench", cores=cpus, shuffle_partitions=int(cpus))
    # JVM warm-up: one pass over every headline query before any timing, so
    # the first timed query does not pay for JIT compilation alone.
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))
    queries = {name: timed(lambda n=name: QUERIES[n](spark, sf_dir), runs) for name in HEADLINE}

    # CSV ingest end to end (list, probe headers, typed scans, landing write)
    # over files written once from the fact table in three header layouts.
    files = scratch_path(spark, "bench_files")
    SF.write_sales_files(S.fact_sales(spark, sf_dir), files)

    def ingest_once():
        C.ingest_sales(spark, files, scratch_path(spark, "bench_landing"))
    ingest_once()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        ingest_once()
        samples.append(time.perf_counter() - t0)
    queries["csv_ingest"] = round(statistics.median(samples), 3)

    # Marts against the source job's shapes, interleaved run by run so that
    # both see the same JVM and cache state.
    # The baseline is the project's own oracle SQL, run by Spark over the same views.
    register_views(spark, sf_dir)
    pairs = {
        "sales_mart": (lambda: QUERIES["sales_mart"](spark, sf_dir),
                       lambda: spark.sql(O.SALES_MART_SQL)),
        "customer_mart": (lambda: QUERIES["customer_mart"](spark, sf_dir),
                          lambda: spark.sql(O.CUSTOMER_MART_SQL)),
    }
    reference = {}
    for name, (ours, theirs) in pairs.items():
        run(theirs())
        a, b = [], []
        for _ in range(runs):
            for make, out in ((ours, a), (theirs, b)):
                t0 = time.perf_counter()
                run(make())
                out.append(time.perf_counter() - t0)
        queries[name] = round(statistics.median(a), 3)
        reference[name] = round(statistics.median(b), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(queries.values()), 3),
                      "unit": "sec", "queries": queries, "reference_shape": reference,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
