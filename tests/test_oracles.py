"""Every query with a SQL oracle equals DuckDB on the same tables (the driver's gate, locally)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.plans.registry import ORACLES, QUERIES, load_all
from oracle_compare import compare

load_all()


def test_every_query_is_registered_with_a_docstring():
    qs = E.queries()
    assert len(qs) >= 100
    for name, fn in qs.items():
        assert fn.__doc__, name
    assert set(ORACLES) <= set(QUERIES) <= set(qs)
    assert set(E.oracle_sql()) <= set(qs)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert set(df.columns) == {"type", "n", "fraud", "fraud_rate_pct"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), ORACLES[name], duck_small)
    assert ok, msg
