import pytest

from copse.plans import catalog
from tests.conftest import SF001

NAMES = sorted(catalog.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_runs_on_smallest_tables(spark, name):
    df = catalog.queries()[name](spark, SF001)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    assert df.count() >= 1
