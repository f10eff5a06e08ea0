"""Bronze and Silver: typing, rules, whole-row distinct, enrichment with the customer."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.derive import amount_band, date_parts, time_period
from lakerisk.operators.rules import CUSTOMER, STRICT, Rules, apply_rules
from lakerisk.schemas import (
    BRONZE_COLUMNS,
    CUSTOMER_COLUMNS,
    LAB_BRONZE_COLUMNS,
    LAB_DERIVED_COLUMNS,
)

_CASTS = {
    "amount": "double", "risk_score": "double", "credit_score": "int",
    "is_fraud": "boolean", "ts": "timestamp_ntz", "created_at": "date",
}


def _typed(names: list[str], renamed: dict[str, str] | None = None) -> list[str]:
    """Select list with the layer's types; ``renamed`` gives the source name of a column."""
    source = {n: (renamed or {}).get(n, n) for n in names}
    return [f"CAST({source[n]} AS {_CASTS[n]}) AS {n}" if n in _CASTS else n for n in names]


def project_transactions(raw: DataFrame, columns: list[str] = BRONZE_COLUMNS) -> DataFrame:
    """Cast to the Bronze types and rename ``timestamp`` to ``ts``."""
    return raw.selectExpr(*_typed(columns, {"ts": "timestamp"}))


def project_customers(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_typed(CUSTOMER_COLUMNS))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact copies. Copies collapse inside each task before the shuffle, so a row repeated
    a billion times does not load one reducer. Conflicting versions of an id are all kept."""
    return df.distinct()


def bronze_transactions(
    raw: DataFrame, rules: Rules = STRICT, columns: list[str] = BRONZE_COLUMNS
) -> DataFrame:
    return distinct_rows(project_transactions(apply_rules(raw, rules), columns))


def bronze_tx_lab(raw: DataFrame, rules: Rules) -> DataFrame:
    return bronze_transactions(raw, rules, LAB_BRONZE_COLUMNS)


def bronze_customers(raw: DataFrame) -> DataFrame:
    return distinct_rows(project_customers(apply_rules(raw, CUSTOMER)))


def enrich(tx: DataFrame, customers: DataFrame, how: str = "inner") -> DataFrame:
    """Join transactions with their customer on ``customer_id``.

    The join carries no hint: the optimizer broadcasts a dimension whose measured bytes allow it and
    otherwise sorts and merges, splitting a hot customer over tasks.
    """
    return tx.join(customers, "customer_id", how)


def add_silver_columns(df: DataFrame, lab: bool = False) -> DataFrame:
    parts = date_parts(F.col("ts"))
    derived = parts | {
        "time_period": time_period(parts["hour"]),
        "amount_band": amount_band(F.col("amount")),
    }
    wanted = LAB_DERIVED_COLUMNS if lab else list(derived)
    return df.withColumns({name: derived[name] for name in wanted})


def silver_star(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """The transaction's own columns plus the customer's creation date."""
    dim = customers.select("customer_id", F.col("created_at").alias("customer_created_at"))
    return enrich(tx, dim).select(*tx.columns, "customer_created_at")


def silver_transactions(
    tx: DataFrame, customers: DataFrame, attrs_from: str = "transaction"
) -> DataFrame:
    """Silver rows. ``attrs_from="customer"`` takes segment and score from the customer instead."""
    if attrs_from == "transaction":
        return add_silver_columns(silver_star(tx, customers))
    own = [c for c in tx.columns if c not in ("segment", "credit_score")]
    dim = customers.select("customer_id", "segment", "credit_score")
    joined = enrich(tx.select(*own), dim).select(*own, "segment", "credit_score")
    return add_silver_columns(joined, lab=True)


def join_cohort_back(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Silver rows with the customer's creation date read again from the dimension."""
    return enrich(silver, customers.select("customer_id", "created_at"))


def left_diagnose(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Every transaction with the customer it found, if any."""
    dim = customers.select(
        "customer_id",
        F.col("segment").alias("customer_segment"),
        F.lit(True).alias("matched"),
    )
    joined = enrich(tx, dim, "left")
    return joined.withColumn("matched", F.coalesce("matched", F.lit(False)))


def orphan_transactions(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions whose customer is not in the dimension."""
    return tx.join(customers.select("customer_id"), "customer_id", "left_anti")


def key_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
