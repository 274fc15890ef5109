"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

from martline.plans.catalog import ORACLES, QUERIES
from martline.plans.compare import compare
from tests.conftest import SMALL


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SMALL)
    if name in ORACLES:
        assert r["columns_match"], r
        assert r["spark_rows"] == r["duck_rows"], r
        assert r["values_match"], r
    else:
        assert r["spark_rows"] > 0, r
