import pytest

from brontide.plans import catalogue

from .conftest import SMALL
from .oracle import rows_of_duckdb, rows_of_spark


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_counterpart(spark, name):
    assert rows_of_spark(catalogue.QUERIES[name](spark, SMALL)) == rows_of_duckdb(catalogue.ORACLE_SQL[name], SMALL)


def test_entry_has_all_market_queries(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries()) and entry.entry(spark).count() > 0
