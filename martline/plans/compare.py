"""Compare a catalogue query with its DuckDB oracle (row count, column
names, order-insensitive values).  Used by the tests and `check_oracle.py`."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

from pyspark.sql import SparkSession

from martline.sources.tables import BASE_TABLES


def _canon(v) -> str:
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else format(v.normalize(), "f")
    if isinstance(v, _dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):  # numpy scalar
        return _canon(v.item())
    return str(v)


def canonical_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark: SparkSession, name: str, sf_dir: str) -> dict:
    from martline.plans.catalog import ORACLES, QUERIES
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    result = {"query": name, "spark_rows": len(s_rows)}
    if name not in ORACLES:
        result["oracle"] = False
        return result
    d_cols, d_rows = duckdb_rows(ORACLES[name], sf_dir)
    result.update(oracle=True, duck_rows=len(d_rows),
                  columns_match=sorted(s_cols) == sorted(d_cols))
    result["values_match"] = (result["columns_match"] and
                              canonical_rows(s_cols, s_rows) == canonical_rows(d_cols, d_rows))
    if not result["columns_match"]:
        result["spark_columns"], result["duck_columns"] = s_cols, d_cols
    return result
