"""Run catalogue queries against their DuckDB oracles.

    python check_oracle.py [sf_dir] [query ...]

Set CHECK_JSON=<path> to also write the per-query results as JSON.
"""

from __future__ import annotations

import json
import os
import sys
import time

from martline.plans.catalog import QUERIES
from martline.plans.compare import compare
from martline.session import build_session


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("check-oracle", cores=8, shuffle_partitions=8)
    bad = 0
    results = []
    for name in names:
        t0 = time.time()
        try:
            r = compare(spark, name, sf_dir)
        except Exception as exc:  # report and continue with the next query
            r = {"query": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        r["sec"] = round(time.time() - t0, 2)
        ok = "error" not in r and (not r.get("oracle") or r.get("values_match"))
        bad += not ok
        print(("OK  " if ok else "BAD ") + json.dumps(r, default=str), flush=True)
        results.append({**r, "ok": ok})
    spark.stop()
    checked = sum(1 for r in results if r.get("oracle"))
    print(f"SUMMARY {len(results) - bad}/{len(results)} ok, {checked} with an oracle", flush=True)
    if os.environ.get("CHECK_JSON"):
        with open(os.environ["CHECK_JSON"], "w") as f:
            json.dump(results, f, indent=1, default=str)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
