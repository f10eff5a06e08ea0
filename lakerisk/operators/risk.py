"""Risk aggregates: Gold tables, analysis tables and business questions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.functions.derive import cohort
from lakerisk.functions.measures import (
    cents,
    fraud_count,
    fraud_rate_pct,
    money,
    money_avg,
    money_sum,
    rate_pct,
    ratio,
    risk_by,
    round_half_up,
    row_count,
    units,
    value_at_risk,
)
from lakerisk.operators.ordering import order_by, order_listed, top_k
from lakerisk.schemas import AMOUNT_BANDS, CHANNEL_ORDER, PERIOD_ORDER, SEGMENTS

_COUNTS = {"total": "rows", "fraudes": "fraud_rows"}
_RATED = _COUNTS | {"taxa_fraude_pct": "fraud_rate"}
_GOLD_COUNTS = {
    "total_transacoes": "rows", "qtd_fraudes": "fraud_rows", "taxa_fraude_pct": "fraud_rate",
}


def _date(name: str) -> Column:
    return F.to_date("ts").alias(name)


# Gold tables

def gold_fraud_risk(silver: DataFrame) -> DataFrame:
    return risk_by(
        silver, ["segment"], total_transacoes="rows", valor_total="amount_sum",
        ticket_medio="amount_avg", qtd_fraudes="fraud_rows", taxa_fraude_pct="fraud_rate",
        valor_em_risco="value_at_risk")


def gold_channel_risk(silver: DataFrame) -> DataFrame:
    return risk_by(silver, ["channel", "merchant_category"], **_GOLD_COUNTS, valor_total="amount_sum")


def gold_category_risk(silver: DataFrame) -> DataFrame:
    return risk_by(silver, ["merchant_category"], **_GOLD_COUNTS, valor_em_risco="value_at_risk")


def gold_daily_metrics(silver: DataFrame) -> DataFrame:
    daily = risk_by(
        silver, [_date("data")], transacoes="rows", fraudes="fraud_rows",
        taxa_fraude_pct="fraud_rate")
    return order_by(daily, ["data"])


def gold_daily_ymd(silver: DataFrame) -> DataFrame:
    return risk_by(silver, ["year", "month", "day"], transacoes="rows", fraudes="fraud_rows")


def gold_daily_top_fraud(gold_daily: DataFrame, k: int = 5) -> DataFrame:
    top = top_k(gold_daily, ["-fraudes", "year", "month", "day"], k)
    return top.select("year", "month", "day", "fraudes")


# Analysis tables

def analysis_segment(silver: DataFrame, approx_customers: bool = False) -> DataFrame:
    """Risk per segment; ``approx_customers`` estimates the distinct customers without a shuffle."""
    customers = "customers_approx" if approx_customers else "customers"
    table = risk_by(
        silver, ["segment"], score_medio="credit_avg", clientes=customers, transacoes="rows",
        fraudes="fraud_rows", taxa_fraude_pct="fraud_rate")
    return order_by(table, ["-taxa_fraude_pct", "segment"])


def analysis_channel(silver: DataFrame, by_rate: bool = False) -> DataFrame:
    table = risk_by(silver, ["channel"], **_RATED)
    if by_rate:
        return order_by(table, ["-taxa_fraude_pct", "channel"])
    return order_listed(table, "channel", CHANNEL_ORDER)


def analysis_category(silver: DataFrame) -> DataFrame:
    table = risk_by(silver, ["merchant_category"], **_RATED, valor_em_risco="value_at_risk")
    return order_by(table, ["-taxa_fraude_pct", "merchant_category"])


def analysis_daily(silver: DataFrame) -> DataFrame:
    return order_by(risk_by(silver, [_date("dia")], **_RATED), ["dia"])


def analysis_period(silver: DataFrame) -> DataFrame:
    table = risk_by(silver, [F.col("time_period").alias("periodo")], **_RATED)
    return order_listed(table, "periodo", PERIOD_ORDER)


def analysis_period_band(silver: DataFrame) -> DataFrame:
    table = risk_by(silver, ["time_period", "amount_band"], **_RATED)
    return order_by(table, ["-taxa_fraude_pct", "time_period", "amount_band"])


def analysis_segment_band(silver: DataFrame) -> DataFrame:
    return order_by(risk_by(silver, ["segment", "amount_band"], **_RATED), ["segment", "amount_band"])


def pivot_band_segment(silver: DataFrame) -> DataFrame:
    """Fraud rate with one row per amount band and one column per segment.

    Every band has a row, also one without transactions, as in the listed order. The listed segments
    always have a column; any other that occurs follows, in order (a missing one as ``null``).
    """
    present = {row["segment"] for row in silver.select("segment").distinct().collect()}
    segments = [*SEGMENTS, *sorted(present - {*SEGMENTS, None}), *([None] if None in present else [])]
    listed = F.array(*[F.lit(b) for b in AMOUNT_BANDS])
    bands = silver.sparkSession.range(1).select(F.explode(listed).alias("amount_band"))
    rates = (
        silver.groupBy("amount_band").pivot("segment", segments)
        .agg(fraud_rate_pct(fraud_count(), row_count()))
    )
    return order_listed(bands.join(rates, "amount_band", "left"), "amount_band", AMOUNT_BANDS)


# Global figures

def kpi_global(silver: DataFrame) -> DataFrame:
    return risk_by(
        silver, [], n="rows", fraud="fraud_rows", volume="amount_sum", risk="value_at_risk")


def kpi_long(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Five indicators as (kpi, valor); the received count is counted from Raw."""
    received = raw.agg(F.count(F.lit(1)).alias("received"))
    totals = silver.agg(
        row_count().alias("n"), fraud_count().alias("fraud"), value_at_risk().alias("risk"))
    # The indicator names of the exported table.
    rows = {
        "recebidas": received.scalar().cast("double"),
        "válidas analisadas": F.col("n").cast("double"),
        "fraudes": F.col("fraud").cast("double"),
        "taxa_fraude_pct": fraud_rate_pct(F.col("fraud"), F.col("n")),
        "valor_em_risco": F.col("risk"),
    }
    pairs = [F.struct(F.lit(k).alias("kpi"), v.alias("valor")) for k, v in rows.items()]
    return totals.select(F.inline(F.array(*pairs)))


# Business questions

def eda_score_by_segment(silver: DataFrame) -> DataFrame:
    table = risk_by(silver, ["segment"], score_medio="credit_avg", clientes="customers")
    return order_by(table, ["score_medio", "segment"])


def eda_risk_by_type(silver: DataFrame) -> DataFrame:
    table = risk_by(
        silver, ["transaction_type"], fraudes="fraud_rows", total="rows", taxa_pct="fraud_rate")
    return order_by(table, ["-taxa_pct", "transaction_type"])


def eda_day_of_month(silver: DataFrame, k: int = 10) -> DataFrame:
    table = risk_by(silver, ["day"], total_transacoes="rows", fraudes="fraud_rows")
    return top_k(table, ["-fraudes", "day"], k)


def eda_cohort(silver: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """Average ticket of long-standing and new customers on the date ``as_of``."""
    return risk_by(
        silver, [cohort(F.col("customer_created_at"), as_of, days).alias("cohort")],
        ticket_medio="amount_avg", transacoes="rows")


def purchases_of(silver: DataFrame, segment: str, tx_type: str) -> DataFrame:
    return silver.filter((F.col("segment") == segment) & (F.col("transaction_type") == tx_type))


def eda_cross_sell(
    silver: DataFrame, segment: str = "Premium", tx_type: str = "compra",
    min_purchases: int = 10, k: int = 10,
) -> DataFrame:
    """The ``k`` customers of a segment with the most purchases above ``min_purchases``."""
    table = risk_by(purchases_of(silver, segment, tx_type), ["customer_id"], compras="rows")
    frequent = table.filter(F.col("compras") > min_purchases)
    return top_k(frequent, ["-compras", "customer_id"], k)


def segment_preview(silver: DataFrame) -> DataFrame:
    table = risk_by(silver, ["segment"], transacoes="rows", taxa_fraude_pct="fraud_rate")
    return order_by(table, ["-taxa_fraude_pct", "segment"])


def fraud_for_month(raw_partitioned: DataFrame, months: Column) -> DataFrame:
    """Fraud per month over the partitions that ``months`` selects."""
    return risk_by(raw_partitioned.filter(months), ["year", "month"], **_RATED)


# Tables derived from Gold

def gold_rollup_kpis(gold: DataFrame) -> DataFrame:
    """Totals over the segment table; the rate is weighted, not an average of rates."""
    total, fraud = F.sum("total_transacoes"), F.sum("qtd_fraudes")
    return gold.agg(
        total.alias("total_transacoes"), fraud.alias("qtd_fraudes"),
        fraud_rate_pct(fraud, total).alias("taxa_geral"))


# One scan for every table

CUBE_DIMS = ["data", "segment", "channel", "merchant_category", "time_period", "amount_band",
             "transaction_type"]


def additive_base(silver: DataFrame) -> DataFrame:
    """Counts and money units at the finest grain the risk tables use; everything else sums these."""
    return silver.groupBy(_date("data"), *CUBE_DIMS[1:]).agg(
        row_count().alias("n"),
        fraud_count().alias("fraud"),
        F.sum(units(F.col("amount"))).alias("amount_units"),
        F.sum(F.when(F.col("is_fraud"), units(F.col("amount"))).otherwise(0)).alias("risk_units"),
    )


def additive_measures() -> list[Column]:
    """Measures over rows of ``additive_base``."""
    n, fraud = F.sum("n"), F.sum("fraud")
    return [
        n.alias("total"),
        fraud.alias("fraudes"),
        fraud_rate_pct(fraud, n).alias("taxa_fraude_pct"),
        money(F.sum("amount_units")).alias("valor_total"),
        money(F.sum("risk_units")).alias("valor_em_risco"),
    ]


BASE_SCHEMA = (
    "data date, segment string, channel string, merchant_category string, time_period string, amount_band string, "
    "transaction_type string, n long, fraud long, amount_units long, risk_units long")
CUSTOMER_BASE_SCHEMA = (
    "data date, segment string, bucket long, customers binary, n long, fraud long, score_sum long, score_n long")


def customer_base(silver: DataFrame) -> DataFrame:
    """Mergeable customers per day, segment and range of ids: one bit a customer, so unions count exactly.

    A range has 32,768 ids; whatever the number of a customer's transactions, it is one bit of one row a day.
    """
    return silver.groupBy(_date("data"), "segment", F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers"),
        row_count().alias("n"), fraud_count().alias("fraud"),
        F.sum("credit_score").alias("score_sum"), F.count("credit_score").alias("score_n"))


def customer_sketches(silver: DataFrame, lg_size: int = 12) -> DataFrame:
    """The estimated counterpart of ``customer_base``: one sketch of fixed size per day and segment."""
    return silver.groupBy(_date("data"), "segment").agg(F.hll_sketch_agg("customer_id", lg_size).alias("sketch"))


def customers_from_sketches(sketches: DataFrame, dims: list[str]) -> DataFrame:
    return sketches.groupBy(*dims).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("clientes"))


def segment_from_base(customers: DataFrame) -> DataFrame:
    """``analysis_segment`` from the stored customer base: days are merged per range, then ranges are summed."""
    merged = customers.groupBy("segment", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("customers")).alias("clientes"),
        *[F.sum(c).alias(c) for c in ("n", "fraud", "score_sum", "score_n")])
    total, fraud = F.sum("n"), F.sum("fraud")
    table = merged.groupBy("segment").agg(
        round_half_up(ratio(F.sum("score_sum"), F.sum("score_n")), 1).alias("score_medio"),
        F.sum("clientes").alias("clientes"), total.alias("transacoes"), fraud.alias("fraudes"),
        fraud_rate_pct(fraud, total).alias("taxa_fraude_pct"))
    return order_by(table, ["-taxa_fraude_pct", "segment"])


def _gold_from_base(base: DataFrame, dims: list[str], **names: str) -> DataFrame:
    total, fraud, amount = F.sum("n"), F.sum("fraud"), money(F.sum("amount_units"))
    measures = {
        "rows": total, "fraud_rows": fraud, "fraud_rate": fraud_rate_pct(fraud, total), "amount_sum": amount,
        "amount_avg": round_half_up(ratio(amount, total), 2), "value_at_risk": money(F.sum("risk_units")),
    }
    return base.groupBy(*dims).agg(*[measures[m].alias(name) for name, m in names.items()])


# The four Gold tables from the stored base, in the shapes that they have from Silver.
GOLD_FROM_BASE = {
    "gold_fraud_risk": lambda base: _gold_from_base(
        base, ["segment"], total_transacoes="rows", valor_total="amount_sum", ticket_medio="amount_avg",
        qtd_fraudes="fraud_rows", taxa_fraude_pct="fraud_rate", valor_em_risco="value_at_risk"),
    "gold_channel_risk": lambda base: _gold_from_base(
        base, ["channel", "merchant_category"], **_GOLD_COUNTS, valor_total="amount_sum"),
    "gold_category_risk": lambda base: _gold_from_base(
        base, ["merchant_category"], **_GOLD_COUNTS, valor_em_risco="value_at_risk"),
    "gold_daily_metrics": lambda base: order_by(_gold_from_base(
        base, ["data"], transacoes="rows", fraudes="fraud_rows", taxa_fraude_pct="fraud_rate"), ["data"]),
}


# The groupings of the Gold and analysis tables.
CUBE_SETS = [
    ["segment"], ["channel"], ["merchant_category"], ["channel", "merchant_category"], ["data"],
    ["time_period"], ["time_period", "amount_band"], ["segment", "amount_band"],
    ["transaction_type"], [],
]


def risk_cube(silver: DataFrame) -> DataFrame:
    """Every count, rate and money table in one pass.

    Silver is first reduced to its additive base, so the grouping sets expand that small table and
    not the transactions. ``grouping_set`` names the columns each row is grouped by.
    """
    dims = [F.col(c) for c in CUBE_DIMS]
    sets = [[F.col(c) for c in names] for names in CUBE_SETS]
    grouped = additive_base(silver).groupingSets(sets, *dims)
    # grouping(c) is 0 where c is one of the row's keys.
    keys = [F.when(F.grouping(c) == 0, F.lit(c)) for c in CUBE_DIMS]
    return grouped.agg(F.concat_ws(",", *keys).alias("grouping_set"), *additive_measures())


# Risk insights

def _rated(df: DataFrame, dim: str) -> DataFrame:
    return risk_by(df, [dim], **_RATED, valor_em_risco="value_at_risk")


def relative_risk(silver: DataFrame, dim: str = "segment", baseline: str = "Premium") -> DataFrame:
    """Fraud rate of each value divided by the rate of ``baseline``."""
    table = risk_by(silver, [dim], **_COUNTS)
    share = F.col("fraudes") / F.col("total")
    # Not a filter: that would be pushed down to the scan and Silver would be derived twice.
    base = table.agg(F.max(F.when(F.col(dim) == baseline, share)).alias("share"))
    relative = share / F.nullif(base.scalar(), F.lit(0.0))
    return table.select(
        dim, "total", "fraudes",
        fraud_rate_pct(F.col("fraudes"), F.col("total")).alias("taxa_fraude_pct"),
        round_half_up(relative, 4).alias("risco_relativo"))


def min_volume_guard(silver: DataFrame, dims: list[str], min_total: int) -> DataFrame:
    """Rates of the groups with at least ``min_total`` transactions."""
    return risk_by(silver, dims, **_RATED).filter(F.col("total") >= min_total)


def value_at_risk_rank(silver: DataFrame, dim: str = "merchant_category") -> DataFrame:
    return order_by(_rated(silver, dim), ["-valor_em_risco", dim])


def risk_mix(silver: DataFrame, dim: str = "channel") -> DataFrame:
    """Rate of each value with its share of all transactions, frauds and money at risk."""
    table = _rated(silver, dim)
    totals = table.agg(F.struct(
        F.sum("total").alias("n"), F.sum("fraudes").alias("f"),
        F.sum(cents(F.col("valor_em_risco"))).alias("v")).alias("t")).scalar()
    return table.withColumns({
        "participacao_transacoes_pct": rate_pct(F.col("total"), totals["n"], 4),
        "participacao_fraudes_pct": rate_pct(F.col("fraudes"), totals["f"], 4),
        "participacao_valor_pct": rate_pct(cents(F.col("valor_em_risco")), totals["v"], 4),
    })


def daily_rate_alert(silver: DataFrame, history: int = 28, width: float = 3.0) -> DataFrame:
    """Days whose fraud rate leaves the band of the days before, with their volume beside it.

    The window runs over one row per day, so its single task holds a calendar, not transactions.
    """
    daily = risk_by(silver, [_date("data")], **_COUNTS)
    before = Window.orderBy("data").rowsBetween(-history, -1)
    rate = F.lit(100.0) * F.col("fraudes") / F.col("total")
    usual, spread = F.avg(rate).over(before), F.stddev_samp(rate).over(before)
    usual_volume = F.avg(F.col("total").cast("double")).over(before)
    return daily.select(
        "data", "total", "fraudes",
        fraud_rate_pct(F.col("fraudes"), F.col("total")).alias("taxa_fraude_pct"),
        round_half_up(usual, 4).alias("taxa_media"),
        round_half_up(usual + F.lit(width) * spread, 4).alias("limite"),
        round_half_up(F.col("total") / usual_volume, 4).alias("volume_relativo"),
        F.coalesce(rate > usual + F.lit(width) * spread, F.lit(False)).alias("alerta"),
    )
