"""Write PLANS.md: the final (adaptive) physical plans of the headline
queries after running them at $BENCH_SF_DIR (default sf0.1).

    python explain_plans.py [query ...]
"""

from __future__ import annotations

import os
import re
import sys

from martline.plans.catalog import QUERIES
from martline.session import build_session

DEFAULT = ["sales_mart", "customer_mart", "dimension_enrichment", "customer_month_window",
           "store_month_rank", "unmatched_dimension_rows", "csv_mixed_headers"]


def final_plan(df) -> str:
    # A documentation tool for local runs: executing the frame's own query
    # (rather than a write, which plans separately) finalises its adaptive
    # plan, so the shown plan has the measured stage statistics applied.
    df._jdf.queryExecution().executedPlan().executeCollect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # expression ids (#123) change from run to run; drop them for readability
    return re.sub(r"#\d+L?", "", text)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("martline-plans", cores=8, shuffle_partitions=8)
    out = ["# Physical plans", "",
           f"Final adaptive plans after execution on `{sf_dir}`, local[8], "
           "8 shuffle partitions, AQE on. Generated by `explain_plans.py`.", ""]
    for name in names or DEFAULT:
        out += [f"## {name}", "", "```", final_plan(QUERIES[name](spark, sf_dir)).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
