import pytest
from check import compare, connect
from conftest import SF

from seriesforge.plans.catalog import load_all

REGISTRY = load_all()
#: Queries that find nothing in the smallest tables.
EMPTY_ON_SMALL: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_its_sql(spark, duck, name):
    result, _, _ = compare(spark, duck, SF, REGISTRY[name])
    assert result in ("ok", "rows only") or (result == "EMPTY" and name in EMPTY_ON_SMALL), result


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())
