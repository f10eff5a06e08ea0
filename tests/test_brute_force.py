"""Random dirty rows against a plain Python reading of the definitions."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from lakerisk.operators import layers, quality, risk, rules
from lakerisk.plans.lake import Lake
from lakerisk.schemas import CUSTOMER_SCHEMA, SEGMENTS, TX_SCHEMA

TX = TX_SCHEMA.fieldNames()


def dirty_rows(rng):
    def maybe(value, bad, share=0.06):
        return bad if rng.random() < share else value

    rows = []
    for number in range(700):
        rows.append((
            maybe(number, None, 0.02), maybe(rng.randrange(40), None),
            maybe(rng.randrange(1, 200000) / 100, rng.choice([None, 0.0, -5.0])),
            rng.choice(["compra", "saque", None]), rng.choice(["app", "web", "pos"]),
            rng.choice(["viagem", "saude", None]),
            dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 70)),
            maybe(rng.choice(["approved", "declined"]), rng.choice(["pending", None])),
            maybe(float(rng.randrange(101)), rng.choice([None, -0.01, 100.5])),
            maybe(rng.choice(SEGMENTS), None, 0.03),
            maybe(rng.randrange(300, 901), rng.choice([None, 299, 901])),
            rng.choice([True, False, False, False, None])))
    rows += rng.choices(rows, k=150)
    customers = [
        (maybe(c, None), f"n{v}", "0", "e", rng.choice(SEGMENTS), maybe(rng.randrange(300, 901), 950),
         dt.date(2022, 6, 1) + dt.timedelta(days=rng.randrange(600)))
        for c in range(35) for v in range(1 + (c % 9 == 0))]
    return rows, customers + customers[:5]


def keeps(r):
    return (
        r["transaction_id"] is not None and r["customer_id"] is not None
        and r["amount"] is not None and r["amount"] > 0
        and r["risk_score"] is not None and 0 <= r["risk_score"] <= 100
        and r["credit_score"] is not None and 300 <= r["credit_score"] <= 900
        and r["status"] in ("approved", "declined"))


def pct(fraud, total):
    """The rate as a double, by the same half-up rule on the binary product."""
    return int(100.0 * fraud / total * 100.0 + 0.5) / 100.0


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows, customers = dirty_rows(random.Random(request.param))
    lake = Lake(spark.createDataFrame(rows, TX_SCHEMA), spark.createDataFrame(customers, CUSTOMER_SCHEMA))
    named = [dict(zip(TX, r)) for r in rows]
    bronze = [dict(zip(TX, r)) for r in {tuple(x.values()) for x in named if keeps(x)}]
    dims = defaultdict(list)
    for c in set(customers):
        if c[0] is not None and 300 <= c[5] <= 900:
            dims[c[0]].append(c)
    silver = [dict(r, created_at=c[6]) for r in bronze for c in dims[r["customer_id"]]]
    return lake, named, bronze, dims, silver


def test_layer_sizes(case):
    lake, named, bronze, dims, silver = case
    counts = {r["layer"]: r["rows"] for r in quality.layer_counts(lake.raw, lake.bronze, lake.silver).collect()}
    assert counts == {"raw": len(named), "bronze": len(bronze), "silver": len(silver)}


def test_rejects(case):
    lake, named, *_ = case
    assert rules.rejects(lake.raw).count() == sum(not keeps(r) for r in named)


def test_orphans_and_repeated_keys(case):
    lake, _, bronze, dims, _ = case
    got = sorted(r["transaction_id"] for r in layers.orphan_transactions(lake.bronze, lake.customers).collect())
    assert got == sorted(r["transaction_id"] for r in bronze if not dims[r["customer_id"]])
    twice = {r["customer_id"]: r["rows"] for r in layers.key_duplicates(lake.customers, "customer_id").collect()}
    assert twice == {c: len(v) for c, v in dims.items() if len(v) > 1}


@pytest.mark.parametrize("key", ["segment", "channel", "merchant_category", "transaction_type"])
def test_rates_and_money(case, key):
    lake, _, _, _, silver = case
    groups = defaultdict(list)
    for r in silver:
        groups[r[key]].append(r)
    table = risk.risk_by(
        lake.silver, [key], n="rows", f="fraud_rows", rate="fraud_rate", total="amount_sum", lost="value_at_risk")
    got = {r[key]: (r["n"], r["f"], r["rate"], r["total"], r["lost"]) for r in table.collect()}
    assert got == {
        k: (len(g), sum(r["is_fraud"] is True for r in g), pct(sum(r["is_fraud"] is True for r in g), len(g)),
            sum(round(r["amount"] * 100) for r in g) / 100.0,
            sum(round(r["amount"] * 100) for r in g if r["is_fraud"]) / 100.0)
        for k, g in groups.items()}


def test_cube_holds_every_table(case):
    lake, _, _, _, silver = case
    cube = risk.risk_cube(lake.silver).collect()
    by_channel = Counter(r["channel"] for r in silver)
    assert {r["channel"]: r["total"] for r in cube if r["grouping_set"] == "channel"} == by_channel
    assert [r["total"] for r in cube if r["grouping_set"] == ""] == [len(silver)]
    days = Counter(r["timestamp"].date() for r in silver)
    assert {r["data"]: r["total"] for r in cube if r["grouping_set"] == "data"} == days
    # A NULL value of a key is a group of its own, apart from the rows that do not use the key.
    assert sum(r["total"] for r in cube if r["grouping_set"] == "segment") == len(silver)


def test_cross_sell(case):
    lake, _, _, _, silver = case
    counts = Counter(
        r["customer_id"] for r in silver if r["segment"] == "Premium" and r["transaction_type"] == "compra")
    expected = sorted(((c, n) for c, n in counts.items() if n > 2), key=lambda x: (-x[1], x[0]))[:10]
    got = risk.eda_cross_sell(lake.silver, min_purchases=2).collect()
    assert [(r["customer_id"], r["compras"]) for r in got] == expected


def test_quality_indicators(case):
    lake, named, *_ = case
    row = quality.quality_indicators(lake.raw).first()
    ids = Counter(r["transaction_id"] for r in named if r["transaction_id"] is not None)
    assert row["rows"] == len(named) and row["columns"] == 12
    assert row["null_cells"] == sum(v is None for r in named for v in r.values())
    assert row["duplicate_ids"] == sum(n > 1 for n in ids.values())
    assert row["max_risk_score"] == max(r["risk_score"] for r in named if r["risk_score"] is not None)


def test_approximate_customers_are_close(case):
    lake, *_ = case
    exact = {r["segment"]: r["clientes"] for r in risk.analysis_segment(lake.silver).collect()}
    rough = {r["segment"]: r["clientes"] for r in risk.analysis_segment(lake.silver, approx_customers=True).collect()}
    assert all(abs(rough[k] - n) <= 0.2 * n + 1 for k, n in exact.items())
