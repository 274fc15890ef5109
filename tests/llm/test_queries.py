"""Every corpus query with a DuckDB statement, on the smallest data."""

import pytest

from martline.llm.queries import ORACLES, QUERIES
from martline.plans.compare import canonical_rows, duckdb_rows
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_statement(spark, name):
    df = QUERIES[name](spark, SMALL)
    columns, rows = duckdb_rows(ORACLES[name], SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert canonical_rows(df.columns, [tuple(r) for r in df.collect()]) == canonical_rows(columns, rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op13_packing"}))
def test_query_gives_a_row_for_each_row_of_its_table(spark, name):
    table = "pages" if name.startswith("op7_") else "documents"
    want = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert QUERIES[name](spark, SMALL).count() == want
