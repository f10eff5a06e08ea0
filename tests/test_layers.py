"""Rules, Bronze, Silver and the checks between layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import layers, quality, rules
from lakerisk.plans.lake import Lake
from lakerisk.schemas import CUSTOMER_SCHEMA, SILVER_COLUMNS, TX_SCHEMA

GOOD = dict(
    transaction_id=1, customer_id=7, amount=10.0, transaction_type="compra", channel="app",
    merchant_category="varejo", timestamp=dt.datetime(2024, 3, 5, 9), status="approved",
    risk_score=50.0, segment="Premium", credit_score=700, is_fraud=False)
CUSTOMER = dict(
    customer_id=7, name="n", cpf="00000000007", email="e", segment="Standard", credit_score=650,
    created_at=dt.date(2022, 1, 1))


def tx(spark, *changes):
    return spark.createDataFrame([tuple((GOOD | c)[f] for f in TX_SCHEMA.fieldNames()) for c in changes], TX_SCHEMA)


def cust(spark, *changes):
    names = CUSTOMER_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple((CUSTOMER | c)[f] for f in names) for c in changes], CUSTOMER_SCHEMA)


@pytest.mark.parametrize("change,kept", [
    ({}, True), ({"transaction_id": None}, False), ({"customer_id": None}, False),
    ({"amount": 0.0}, False), ({"amount": -1.0}, False), ({"amount": None}, False),
    ({"risk_score": 0.0}, True), ({"risk_score": 100.0}, True), ({"risk_score": 100.01}, False),
    ({"credit_score": 299}, False), ({"credit_score": 300}, True), ({"credit_score": 900}, True),
    ({"credit_score": 901}, False), ({"status": "declined"}, True), ({"status": "pending"}, False),
    ({"status": None}, False), ({"is_fraud": None}, True)])
def test_rules_and_rejects_are_complements(spark, change, kept):
    df = tx(spark, change)
    assert layers.bronze_transactions(df).count() == int(kept)
    assert rules.rejects(df).count() == int(not kept)


def test_a_row_gives_every_reason(spark):
    row = rules.rejects(tx(spark, {"amount": -1.0, "status": "x", "risk_score": None})).first()
    assert sorted(row["reasons"]) == ["positive_amount", "risk_range", "status_in"]


def test_distinct_drops_copies_and_keeps_conflicting_versions(spark):
    raw = tx(spark, {}, {}, {"amount": 11.0})
    bronze = layers.bronze_transactions(raw)
    assert bronze.count() == 2
    assert quality.duplicate_ids(bronze).first()["rows"] == 2


def test_repeated_dimension_key_multiplies_silver_and_is_reported(spark):
    customers = layers.bronze_customers(cust(spark, {}, {}, {"name": "other"}))
    bronze = layers.bronze_transactions(tx(spark, {}))
    assert layers.silver_transactions(bronze, customers).count() == 2
    assert [tuple(r) for r in layers.key_duplicates(customers, "customer_id").collect()] == [(7, 2)]


def test_silver_takes_segment_from_the_chosen_side(spark):
    bronze, customers = layers.bronze_transactions(tx(spark, {})), layers.bronze_customers(cust(spark, {}))
    own = layers.silver_transactions(bronze, customers)
    assert own.columns == SILVER_COLUMNS
    assert (own.first()["segment"], own.first()["credit_score"]) == ("Premium", 700)
    other = layers.silver_transactions(bronze, customers, attrs_from="customer").first()
    assert (other["segment"], other["credit_score"]) == ("Standard", 650)


def test_pinned_counts_at_the_next_scale(spark):
    lake = Lake.from_tables(spark, "/root/testdata/sf0.01")
    counts = {r["layer"]: r["rows"] for r in quality.layer_counts(lake.raw, lake.bronze, lake.silver).collect()}
    assert counts == {"raw": 10040, "bronze": 9914, "silver": 9799}
    assert lake.raw_customers.count() == 1515 and lake.customers.count() == 1484


def test_layers_reconcile(lake):
    bad = rules.rejects(lake.raw).count()
    passing = lake.raw.count() - bad
    copies = passing - lake.bronze.count()
    assert copies >= 0 and passing - copies == lake.bronze.count()
    orphans = layers.orphan_transactions(lake.bronze, lake.customers)
    assert lake.bronze.count() == lake.silver.count() + orphans.count()
    assert quality.duplicate_ids(lake.silver).count() == 0
    assert lake.silver.filter(F.col("amount") <= 0).count() == 0


def test_broadcast_only_within_the_measured_bytes(spark):
    from tests.plans import conf, plan

    bronze, customers = tx(spark, {}), cust(spark, {}, {"customer_id": 8}, {"customer_id": 9})
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "SortMergeJoin" in plan(layers.enrich(bronze, customers))


def hot_lake(spark):
    """A third of the rows belongs to one customer and another third are copies of one row."""
    third = F.col("id") % 3
    varied = {
        "transaction_id": F.col("id"),
        "customer_id": F.when(third == 2, F.col("id") % 1000).otherwise(7),
        "amount": F.rand(1) * 1000 + 1,
        "credit_score": (F.col("id") % 600 + 300).cast("int"),
    }
    fixed = {k: F.lit(v).cast(TX_SCHEMA[k].dataType) for k, v in GOOD.items()}
    raw = spark.range(60000).select(*[
        F.when(third == 1, fixed[k]).otherwise(varied.get(k, fixed[k])).alias(k) for k in GOOD])
    fixed = [F.lit(v).cast(CUSTOMER_SCHEMA[k].dataType).alias(k) for k, v in CUSTOMER.items() if k != "customer_id"]
    customers = spark.range(1000).select(F.col("id").alias("customer_id"), *fixed)
    return Lake(raw.select(*TX_SCHEMA.fieldNames()), customers)


def test_hot_customer_and_hot_copies(spark):
    from lakerisk.operators import risk
    from lakerisk.session import prepare
    from tests.plans import conf, plan

    prepare(spark)
    small = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "50k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
        "spark__sql__shuffle__partitions": "16",
        # A partition splits between the outputs of map tasks, so keep more than one of those.
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
    }
    with conf(spark, **small):
        lake = hot_lake(spark)
        assert lake.bronze.count() == 40001
        for table, column in ((risk.gold_fraud_risk, "total_transacoes"), (risk.analysis_segment, "transacoes")):
            df = table(lake.silver)
            assert [r[column] for r in df.collect()] == [40001]
            assert "SortMergeJoin(skew=true)" in plan(df, "simple")
