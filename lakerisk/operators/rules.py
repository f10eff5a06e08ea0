"""Quality rules as named predicates, applied together or explained one by one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.schemas import CREDIT_RANGE, RISK_RANGE, STATUSES

Rules = dict[str, str]

NOT_NULL_IDS = "transaction_id IS NOT NULL AND customer_id IS NOT NULL"
KNOWN_CUSTOMER = "customer_id IS NOT NULL"
POSITIVE_AMOUNT = "amount > 0"
RISK_IN_RANGE = "risk_score BETWEEN {} AND {}".format(*RISK_RANGE)
CREDIT_IN_RANGE = "credit_score BETWEEN {} AND {}".format(*CREDIT_RANGE)
KNOWN_STATUS = "status IN ({})".format(", ".join(f"'{s}'" for s in STATUSES))

STRICT: Rules = {
    "not_null_ids": NOT_NULL_IDS,
    "positive_amount": POSITIVE_AMOUNT,
    "risk_range": RISK_IN_RANGE,
    "credit_range": CREDIT_IN_RANGE,
    "status_in": KNOWN_STATUS,
}
LAB: Rules = {"positive_amount": POSITIVE_AMOUNT, "known_customer": KNOWN_CUSTOMER}
CUSTOMER: Rules = {"known_customer": KNOWN_CUSTOMER, "credit_range": CREDIT_IN_RANGE}


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that meet every rule; a NULL in a ruled column fails its rule."""
    return df.filter(" AND ".join(f"({rule})" for rule in rules.values()))


def broken_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks, as an array."""
    names = ", ".join(
        f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in rules.items())
    return F.expr(f"array_compact(array({names}))")


def rejects(df: DataFrame, rules: Rules = STRICT) -> DataFrame:
    """The rows Bronze leaves out, with the list of reasons for each."""
    return df.withColumn("reasons", broken_rules(rules)).filter(F.size("reasons") > 0)


def reject_counts(df: DataFrame, rules: Rules = STRICT) -> DataFrame:
    """Rows rejected per rule. A row that breaks several rules counts under each."""
    return (
        rejects(df, rules)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    )
