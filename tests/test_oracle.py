"""Every registered query with a SQL twin equals DuckDB on the smallest fixture
(the driver runs the same comparison at sf0.01)."""

import pytest

from checks.compare import compare
from checks.oracle import ORACLE
from tastegraph.plans.registry import QUERIES

from .conftest import SF_SMALL

NAMES = sorted(n for n in QUERIES if n in ORACLE)


def test_every_query_is_covered():
    rows_only = sorted(set(QUERIES) - set(ORACLE))
    assert set(rows_only) == {"als_predictions", "als_topk", "als_grid", "forest_predictions", "metrics_report"}


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck_small, name):
    r = compare(spark, duck_small, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["rows_match"], r
