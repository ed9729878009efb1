import pytest

import oracle_check
from fleetlake import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert oracle_check.compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert oracle_check.entry.entry(spark).count() > 0
