"""The mapping of the given tables."""

import pytest

from lakerisk.sources import tables


@pytest.mark.parametrize("props,number", [
    ('{"k": 0}', 0), ('{"k": 99}', 99), ('{"k": 100}', 100), ('{"k":7}', 7), ('{"key": 12, "x": 3}', 12)])
def test_first_number_of_props(spark, props, number):
    df = spark.createDataFrame([(props,)], "props string")
    assert df.selectExpr(f"{tables.SCORE} AS k").first()["k"] == number


def test_copies_come_from_one_scan(lake):
    from tests.plans import plan

    assert plan(lake.raw, "simple").count("events.parquet") == 1
    assert lake.raw.count() == 1004 and lake.raw_customers.count() == 152
