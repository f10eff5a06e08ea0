"""Rates, money and the shared group-by."""

import pytest
from pyspark.sql import functions as F

from lakerisk.functions import measures as m

# Fixed values: (transactions, frauds, rate) of the published result tables, and rounding ties.
PUBLISHED = [
    (2913, 281, 9.65), (10634, 311, 2.92), (16428, 156, 0.95),
    (12009, 452, 3.76), (3005, 54, 1.80), (8997, 157, 1.75), (5964, 85, 1.43),
    (3007, 158, 5.25), (2949, 72, 2.44), (5971, 138, 2.31), (9040, 203, 2.25), (4574, 90, 1.97),
    (4434, 87, 1.96), (29975, 748, 2.50),
]
TIES = [(4000, 23, 0.57), (20000, 29, 0.14), (4000, 41, 1.02)]


def rates(spark, pairs):
    df = spark.createDataFrame([(i, t, f) for i, (t, f, _) in enumerate(pairs)], "i int, t long, f long")
    rated = df.select("i", m.fraud_rate_pct(F.col("f"), F.col("t")).alias("r")).orderBy("i")
    return [r["r"] for r in rated.collect()]


def test_published_rates(spark):
    assert rates(spark, PUBLISHED) == [r for _, _, r in PUBLISHED]


def test_rounding_ties(spark):
    assert rates(spark, TIES) == [r for _, _, r in TIES]


def test_rate_agrees_with_duckdb_on_many_pairs(spark, con):
    df = (
        spark.range(1, 400).select(F.col("id").alias("t"), F.explode(F.sequence(F.lit(0), F.col("id"))).alias("f"))
        .select("t", "f", m.fraud_rate_pct(F.col("f"), F.col("t")).alias("r"))
    )
    arrow = df.toArrow()
    con.register("pairs", arrow)
    bad = con.execute("SELECT COUNT(*) FROM pairs WHERE r <> ROUND(100.0 * f / t, 2)").fetchone()[0]
    assert arrow.num_rows == 80199 and bad == 0


def test_rate_over_nothing_is_null(spark):
    assert rates(spark, [(0, 0, None)]) == [None]


def test_money_sum_is_exact_in_any_order(spark):
    df = spark.range(0, 100000, 1, 16).select(F.lit(0.1).alias("amount"))
    assert df.agg(m.money_sum(F.col("amount")).alias("v")).first()["v"] == 10000.0


@pytest.mark.parametrize("amount", [0.01, 1.15, 4.35, 99.99, 1.005e9, 123456789.01])
def test_cents_of_awkward_doubles(spark, amount):
    df = spark.createDataFrame([(amount,)], "amount double")
    assert df.select(m.cents(F.col("amount")).alias("c")).first()["c"] == round(amount * 100)


def test_null_flag_counts_as_no_fraud(spark):
    df = spark.createDataFrame(
        [("a", 10.0, None), ("a", 5.0, True), ("a", None, False)],
        "segment string, amount double, is_fraud boolean")
    row = m.risk_by(df, ["segment"], n="rows", f="fraud_rows", v="value_at_risk", t="amount_avg").first()
    assert (row["n"], row["f"], row["v"], row["t"]) == (3, 1, 5.0, 7.5)


def test_sums_over_any_dimension_equal_the_total(lake):
    from lakerisk.operators import risk

    total = risk.kpi_global(lake.silver).first()
    for dim in ["segment", "channel", "merchant_category", "time_period", "amount_band", "day"]:
        parts = m.risk_by(
            lake.silver, [dim], n="rows", f="fraud_rows", v="amount_sum", r="value_at_risk"
        ).agg(F.sum("n"), F.sum("f"), F.round(F.sum("v"), 2), F.round(F.sum("r"), 2)).first()
        assert tuple(parts) == (total["n"], total["fraud"], total["volume"], total["risk"])


def test_amounts_below_a_cent_count(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("amount"))
    assert df.agg(m.money_sum(F.col("amount")).alias("v")).first()["v"] == 4.0
