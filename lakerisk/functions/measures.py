"""Aggregate measures shared by every risk table.

Money is summed in a long as ten-thousandths of the currency: exact, independent of row order, cheaper
in the hash aggregate than a wide decimal, and amounts below a cent count. Ratios come from the summed parts, never from averaged rates.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a non-negative double in binary arithmetic.

    Spark's ``round`` works on the decimal text of the double and differs on ties such as 0.575.
    """
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5)) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL over an empty whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage as a rounded double."""
    percent = F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return round_half_up(percent, digits)


def fraud_rate_pct(fraud_count: Column, total: Column) -> Column:
    return rate_pct(fraud_count, total, 2)


def row_count() -> Column:
    return F.count(F.lit(1))


def fraud_count(flag: str = "is_fraud") -> Column:
    return F.sum(F.when(F.col(flag), 1).otherwise(0))


def cents(amount: Column) -> Column:
    return F.floor(amount * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def units(amount: Column) -> Column:
    """Ten-thousandths, the scale at which money is summed."""
    return F.floor(amount * F.lit(10_000.0) + F.lit(0.5)).cast("bigint")


def money(total_units: Column) -> Column:
    return total_units / F.lit(10_000.0)


def money_sum(amount: Column) -> Column:
    return money(F.sum(units(amount)))


def money_avg(amount: Column, digits: int = 2) -> Column:
    return round_half_up(ratio(money_sum(amount), F.count(amount)), digits)


def value_at_risk(amount: str = "amount", flag: str = "is_fraud") -> Column:
    return money_sum(F.when(F.col(flag), F.col(amount)).otherwise(0.0))


MEASURES: dict[str, Callable[[], Column]] = {
    "rows": row_count,
    "fraud_rows": fraud_count,
    "fraud_rate": lambda: fraud_rate_pct(fraud_count(), row_count()),
    "amount_sum": lambda: money_sum(F.col("amount")),
    "amount_avg": lambda: money_avg(F.col("amount")),
    "value_at_risk": value_at_risk,
    "customers": lambda: F.count_distinct("customer_id"),
    "customers_approx": lambda: F.approx_count_distinct("customer_id"),
    "credit_avg": lambda: round_half_up(
        ratio(F.sum("credit_score"), F.count("credit_score")), 1),
    "amount_max": lambda: F.max("amount"),
}


def risk_by(df: DataFrame, dims: list[str | Column], **measures: str) -> DataFrame:
    """Group ``df`` by ``dims`` and compute ``output_name="measure"`` columns."""
    return df.groupBy(*dims).agg(*[MEASURES[m]().alias(name) for name, m in measures.items()])
