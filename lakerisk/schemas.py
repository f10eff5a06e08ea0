"""Declared schemas, layer column lists and closed vocabularies."""

from pyspark.sql import types as T

# Column names, types and vocabularies of the data model.
TX_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("segment", T.StringType()),
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("is_fraud", T.BooleanType()),
])

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("cpf", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("created_at", T.DateType()),
])

GOLD_FRAUD_RISK_SCHEMA = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("total_transacoes", T.LongType()),
    T.StructField("valor_total", T.DoubleType()),
    T.StructField("ticket_medio", T.DoubleType()),
    T.StructField("qtd_fraudes", T.LongType()),
    T.StructField("taxa_fraude_pct", T.DoubleType()),
    T.StructField("valor_em_risco", T.DoubleType()),
])

# Bronze holds the raw columns, with the timestamp under its short name.
BRONZE_SCHEMA = T.StructType([T.StructField("ts" if f.name == "timestamp" else f.name, f.dataType) for f in TX_SCHEMA.fields])

RAW_COLUMNS = TX_SCHEMA.fieldNames()
BRONZE_COLUMNS = ["ts" if c == "timestamp" else c for c in RAW_COLUMNS]
CUSTOMER_COLUMNS = CUSTOMER_SCHEMA.fieldNames()
DERIVED_COLUMNS = ["year", "month", "day", "day_of_week", "hour", "time_period", "amount_band"]
SILVER_COLUMNS = BRONZE_COLUMNS + ["customer_created_at"] + DERIVED_COLUMNS

LAB_BRONZE_COLUMNS = [
    "transaction_id", "customer_id", "amount", "transaction_type",
    "status", "risk_score", "is_fraud", "ts",
]
LAB_DERIVED_COLUMNS = ["year", "month", "day", "day_of_week", "amount_band"]

STATUSES = ["approved", "declined"]
SEGMENTS = ["High-Risk", "Premium", "Standard"]
AMOUNT_BANDS = ["baixo", "medio", "alto"]
CHANNEL_ORDER = ["app", "atm", "web", "pos"]
PERIOD_ORDER = ["madrugada", "manha", "tarde", "noite"]
COHORT_OLD, COHORT_NEW = "cliente antigo", "cliente novo"

RISK_RANGE = (0, 100)
CREDIT_RANGE = (300, 900)
