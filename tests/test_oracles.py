"""Every query with an exact SQL equivalent agrees with it, row for row."""

import pytest

from lakerisk.plans import catalog
from oracles.sql import ORACLES
from tests.compare import assert_same
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert_same(catalog.run(name, spark, SF_SMALL), con, ORACLES[name])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(catalog.QUERIES)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
