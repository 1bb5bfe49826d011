"""The correctness gate: every registered query against its DuckDB oracle at sf0.01."""

import pytest

from citybeat.plans.catalog import oracle_sql, queries
from citybeat.plans.verify import compare
from tests.conftest import SF001

ORACLES = oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck001, name):
    res = compare(spark, SF001, name, queries()[name], ORACLES[name], duck001)
    assert res["status"] == "ok", res


def test_every_query_has_an_oracle():
    assert set(queries()) == set(ORACLES)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["service", "year", "month", "trips"]
    assert df.count() > 0
