"""Joins as stored, hot customers, and latency of deliveries."""

import datetime as dt

from pyspark.sql import functions as F

from lakerisk.operators import bucketed, layers
from lakerisk.streaming import stream
from tests.plans import conf, plan
from tests.test_incremental import same
from tests.test_layers import tx
from tests.test_streaming import at, deliver


def test_no_exchange_below_the_join(spark, lake):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        stored = bucketed.BucketedFacts(lake.bronze, lake.customers, buckets=8)
        silver = stored.silver()
        text = plan(silver)
        assert "SortMergeJoin" in text and "Exchange" not in text.replace("BroadcastExchange", "") and text.count("Bucketed: true") >= 2
        same(silver, lake.silver)


def test_hot_customers_are_kept_apart(spark, lake):
    busy = lake.bronze.withColumn("customer_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(11)).otherwise(F.col("customer_id")))
    stored = bucketed.BucketedFacts(busy, lake.customers, buckets=8)
    assert 11 in stored.hot and len(stored.hot) < 8
    assert stored.facts.filter("customer_id = 11").isEmpty() and stored.hot_facts.filter("customer_id = 11").count() > 100
    same(stored.silver(), layers.silver_transactions(busy, lake.customers))


def test_no_facts(spark, lake):
    stored = bucketed.BucketedFacts(lake.bronze.limit(0), lake.customers, buckets=4)
    assert stored.hot == [] and stored.silver().count() == 0


def test_latency_per_month(spark, scratch):
    noon = dt.datetime(2024, 1, 2, 12)
    rows = [at(1, 12, transaction_id=i, arrived=noon) for i in range(90)] + [at(2, 11, transaction_id=100 + i, arrived=noon) for i in range(10)]
    df = tx(spark, *[{k: v for k, v in r.items() if k != "arrived"} for r in rows])
    df = df.withColumn("arrived", F.expr("TIMESTAMP'2024-01-02 12:00:00 UTC'"))
    deliver(df, scratch("in"))
    source = spark.readStream.schema(df.schema).parquet(scratch("in"))
    stream.land(source, scratch("out"), scratch("checkpoint"))
    got = stream.partition_latency(spark, scratch("out")).collect()
    assert len(got) == 1 and (got[0]["rows"], got[0]["rejected"]) == (100, 0)
    assert abs(got[0]["latency_p50"] - 86_400) < 900 and abs(got[0]["latency_max"] - 86_400) < 900
    assert stream.partition_latency(spark, scratch("none")).count() == 0
