import pytest

pytest.importorskip("public_tokenizers")

from brontide.llm import queries  # noqa: E402

from ..conftest import SMALL  # noqa: E402
from ..oracle import rows_of_duckdb, rows_of_spark  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_counterpart(spark, name):
    assert rows_of_spark(queries.QUERIES[name](spark, SMALL)) == rows_of_duckdb(queries.ORACLE_SQL[name], SMALL)


def test_ten_queries():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]
