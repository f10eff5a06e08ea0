"""Counts without another pass, pruning by a derived calendar, and the exact split."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import ml, quality
from lakerisk.plans import catalog
from lakerisk.sources import files
from tests.plans import plan


def test_layers_are_counted_by_the_job_that_writes_them(spark, lake):
    seen = quality.Counted()
    rows = seen.through("all", spark.range(1000))
    seen.through("odd", rows.filter("id % 2 = 1")).write.format("noop").mode("overwrite").save()
    assert seen.counts() == {"all": 1000, "odd": 500}
    got = {r["layer"]: r["rows"] for r in catalog.counted_layers(lake).collect()}
    assert got == {"raw": lake.raw.count(), "bronze": lake.bronze.count(), "silver": lake.silver.count()}


def test_only_the_months_of_the_calendar_are_read(spark, lake):
    orders = catalog.stored_orders(lake)
    months = orders.select("year", "month").distinct().count()
    result = catalog.orders_of_quarter(orders, 2)
    text = plan(result)
    assert "dynamicpruning" in text
    result.collect()
    read = result._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in read
    found = re.search(r"number of partitions read.*?(\d+)", str(metrics(result)))
    assert found and int(found.group(1)) <= months // 3 < months


def metrics(df):
    """The scan's metrics after the run, from the executed plan."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            out.append(f"number of partitions read {node.metrics().apply('numPartitions').value()}")
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_days_prune_their_months(spark, lake):
    text = plan(catalog.scan_orders_days(lake))
    assert "PartitionFilters" in text and "year" in text


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.25, 0.5, 1.0])
def test_exact_split_is_exact_to_one_row(spark, fraction):
    random.seed(7)
    rows = [(i, random.random() < 0.03) for i in range(5_001)] + [(i, None) for i in range(9_000, 9_011)]
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud boolean")
    split = ml.stratified_split(df, test_fraction=fraction, exact=True)
    assert split.count() == len(rows)
    for row in split.groupBy("is_fraud").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert row["t"] == round(fraction * row["n"])


def test_exact_split_of_one_hot_id_and_of_nothing(spark):
    hot = spark.createDataFrame([(1, True)] * 300 + [(i, True) for i in range(2, 102)], "transaction_id long, is_fraud boolean")
    split = ml.stratified_split(hot, exact=True)
    assert split.filter("transaction_id = 1").select("is_test").distinct().count() == 1
    assert ml.stratified_split(hot.limit(0), exact=True).count() == 0


def test_month_helper_covers_whole_spans(spark):
    import datetime as dt
    days = spark.sql("SELECT explode(sequence(DATE'1999-01-01', DATE'2002-12-31')) AS d").withColumns({"year": F.year("d"), "month": F.month("d")})
    for first, last in ((dt.date(1999, 12, 31), dt.date(2000, 1, 1)), (dt.date(2000, 2, 3), dt.date(2000, 2, 3)), (dt.date(1999, 5, 5), dt.date(2002, 4, 4))):
        assert days.filter(files.dates_range(first, last, "d")).count() == (last - first).days + 1
